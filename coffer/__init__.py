"""Multi-client ledger and budget analytics as Spark DataFrame functions."""
