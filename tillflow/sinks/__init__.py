"""Writers. Output is always distributed: one file per task, never one file per table."""
