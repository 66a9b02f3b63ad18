"""Space-time event risk on Spark: DataFrame in, DataFrame out."""
