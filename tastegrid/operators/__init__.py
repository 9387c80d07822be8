"""Rating analytics: DataFrames in, DataFrames out."""
