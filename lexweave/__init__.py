"""Spark-first record cleansing, linkage and verification engine."""
