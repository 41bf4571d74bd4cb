"""tableops: warehouse data jobs on Spark."""
