"""Column expressions; every one compiles to built-in Spark functions."""
