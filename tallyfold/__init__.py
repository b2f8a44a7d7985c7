"""Retail transaction analytics and model monitoring as Spark DataFrame jobs."""
