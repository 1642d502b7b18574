"""Flight-delay analytics on Spark: feeds, enrichment, features, delay model, streams."""
