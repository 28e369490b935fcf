"""Market price estimation from purchase transactions, as Spark DataFrame operators."""
