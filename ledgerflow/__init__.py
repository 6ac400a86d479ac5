"""Transactions pipeline as Spark DataFrame operators."""
