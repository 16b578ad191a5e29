"""A Spark-native loader and query engine for delimited company-registry dumps."""
