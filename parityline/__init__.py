"""Table reconciliation and migration inventory on Spark DataFrames."""
