"""Monthly demand planning jobs on Spark: DataFrames in, DataFrames out."""
