"""Layered retail analytics on Spark: bronze ingestion, silver repair, gold marts."""
