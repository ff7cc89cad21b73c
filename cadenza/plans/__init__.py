"""Whole jobs, records of a queue, and the registered queries."""
