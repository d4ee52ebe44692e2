"""Job definitions, staging of intermediate tables and the archive job itself."""
