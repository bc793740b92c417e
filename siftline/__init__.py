"""Spark-native curation engine for tables of web-video metadata."""
