"""linkspan: record linkage as declarative Spark plans."""
