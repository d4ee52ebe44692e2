"""Column and text jobs: DDL catalogs, settings, versions, alignment, lists, names."""
