"""Outcome prediction and audit as Spark DataFrame operators."""
