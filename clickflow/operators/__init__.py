"""DataFrame -> DataFrame operators for the batch analyses."""
