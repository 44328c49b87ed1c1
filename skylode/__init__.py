"""Analytics over media catalogues and training data, written for PySpark."""
