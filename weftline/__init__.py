"""weftline: entity resolution and record analytics, declared as Spark DataFrames."""
