"""Readers: landed entity JSON, terms sheet CSV, parameterised queries,
and the domain views over the driver's tables."""
