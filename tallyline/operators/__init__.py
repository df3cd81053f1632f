"""DataFrame -> DataFrame operators of the billing pipeline."""
