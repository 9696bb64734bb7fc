"""Customer-retention tables on Spark: map, clean, validate, featurise, train, score, watch for drift."""
