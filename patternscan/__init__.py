"""Scan large text and payload tables with rule sets, as Spark jobs."""
