"""strandlake: genome-production analytics as Spark DataFrames."""
