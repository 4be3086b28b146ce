"""Order-feed loading, merging and summarising on Spark."""
