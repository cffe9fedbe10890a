"""Readers. They only describe the input; nothing is pulled to the driver."""
