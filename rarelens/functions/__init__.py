"""Column expressions: no Spark job is started by anything in this package."""
