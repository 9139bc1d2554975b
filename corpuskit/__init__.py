"""corpuskit: a PySpark-native engine for curating and auditing text corpora."""
