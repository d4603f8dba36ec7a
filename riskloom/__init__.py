"""Riskloom: fraud analytics for transaction tables, written as Spark jobs."""
