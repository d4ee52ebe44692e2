"""Reading from and writing to tables, files and databases."""
