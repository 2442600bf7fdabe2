"""tidemark: a PySpark-native engine for market, news and corpus tables."""
