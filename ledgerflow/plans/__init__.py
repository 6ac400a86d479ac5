"""Runs made of operators: settings, table store, ingestion, transformation, whole runs."""
