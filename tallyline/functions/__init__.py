"""Column expressions: no DataFrame in, no DataFrame out, no Python UDF."""
