"""Column expressions and their vectorised UDF twins."""
