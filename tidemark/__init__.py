"""Spark jobs over dated footprints and an administrative hierarchy."""
