"""Spark-native analytics for quakes and other geo-located events."""

__version__ = "0.1.0"
