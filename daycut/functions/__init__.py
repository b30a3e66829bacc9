"""Scalar helpers: time zones, rounding casts, week numbers, labels."""

from daycut.functions import labels, timez

__all__ = ["labels", "timez"]
