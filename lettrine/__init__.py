"""Field-reading reconciliation on Spark: clean, merge, validate, score and report."""
