"""DataFrame → DataFrame operators. None reads or writes, so batch and streaming jobs share them."""
