"""Spark-native analytics over landed JSON feeds: sources, operators, plans, streaming."""
