"""DataFrame -> DataFrame operators of the price pipeline."""
