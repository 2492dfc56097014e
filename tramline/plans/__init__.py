"""Dataset graphs and the named queries over the driver's tables."""
