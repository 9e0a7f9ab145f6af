"""DNS resolution and broadband flow analytics, expressed as Spark DataFrames."""
