"""Readers and writers: XML documents, the table store, the star-schema adapters."""
