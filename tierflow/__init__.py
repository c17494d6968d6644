"""Layered (bronze, silver, gold) lakehouse analytics expressed as Spark jobs."""
