"""Outletry: a Spark-native engine for directories of outlets drawn from web pages and documents."""
