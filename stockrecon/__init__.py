"""Stock reconciliation on Spark: DataFrames in, DataFrames out."""
