"""Zone scoring on Spark, and operators for training-data pipelines."""
