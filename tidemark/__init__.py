"""tidemark: a Spark-native lakehouse for public code-hosting event data."""
