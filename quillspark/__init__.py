"""PySpark-native engine for document corpora and knowledge vaults."""
