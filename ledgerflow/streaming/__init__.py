"""The batch ingestion driven by a file stream."""
