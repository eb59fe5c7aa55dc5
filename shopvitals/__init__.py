"""Analytics for e-commerce operations, expressed as Spark plans."""
