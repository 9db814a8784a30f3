"""Filings, event-study and retrieval analytics expressed as Spark DataFrame plans."""
