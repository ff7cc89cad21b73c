"""Landed inputs: explicit schemas, readers and flattening."""
