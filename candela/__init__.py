"""Market feature and signal jobs on Spark: clean, align, derive, label, learn, recommend."""
