"""A Spark-native engine for scored genomic intervals and training-data corpora."""
