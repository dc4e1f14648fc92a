"""Bronze, silver and gold order tables as composable Spark DataFrame operators."""
