"""Reading operational tables and writing marts."""
