"""Spark-first corpus assembly, search and auditing."""
