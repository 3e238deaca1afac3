"""Analytics over question banks on Spark."""
