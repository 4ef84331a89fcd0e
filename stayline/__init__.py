"""User-retention analytics on event logs, as Spark DataFrame operators."""
