"""File-driven streaming ingestion."""
