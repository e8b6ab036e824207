"""Curating semi-structured records and asking the usual questions, on Spark."""
