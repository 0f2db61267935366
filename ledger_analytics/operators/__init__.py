"""DataFrame -> DataFrame operators of the accounting pipeline."""
