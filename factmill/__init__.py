"""Spark-native event-ledger analytics."""
