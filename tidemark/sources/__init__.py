"""Reading sources and reading or writing the layers' tables."""
