"""Page snapshots in, validated and scored entity profiles out, on Spark DataFrames."""
