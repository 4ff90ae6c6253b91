"""Spark-native factory operations analytics: landing, metrics, checks, indicators."""

from millwright.params import Params

__all__ = ["Params"]
