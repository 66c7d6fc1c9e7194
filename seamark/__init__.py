"""Seamark: maritime AIS analytics as Spark DataFrame and Structured Streaming plans."""
