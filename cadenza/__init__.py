"""Catalogue and listening analytics as Spark DataFrame functions."""
