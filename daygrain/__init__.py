"""Day-grain analytics on Spark: land, reconcile, aggregate, relate."""
