"""Gleaner: a Spark-native engine that gleans the few relevant pages out of a large web-text crawl."""

__version__ = "0.1.0"
