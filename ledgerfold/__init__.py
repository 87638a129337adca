"""Entity-history analytics on Spark: feature tables, preparation, scoring, evaluation."""
