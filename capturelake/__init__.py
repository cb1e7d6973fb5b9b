"""Spark-native web-archive analytics: parse, index, maintain, search and analyse captures."""
