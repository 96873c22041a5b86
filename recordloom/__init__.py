"""Metadata documents and records as analytical tables on Spark."""
