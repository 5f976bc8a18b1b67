"""Larder: recipe-corpus processing and search as Spark DataFrame jobs."""
