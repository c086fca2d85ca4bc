"""Checks, alerts and summaries of financial transactions as PySpark DataFrame operators."""
