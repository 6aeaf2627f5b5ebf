"""Filing-risk analytics on Spark: DataFrame in, DataFrame out."""
