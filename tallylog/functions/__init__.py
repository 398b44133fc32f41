"""Column expressions for one log line; built-in Spark functions only."""
