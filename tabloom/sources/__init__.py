"""Where tables are read from and written to."""
