"""Composed flows: ingestion log, document landing, medallion layers, gold questions."""
