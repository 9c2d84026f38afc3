"""Spark-native data-quality and record-refinement engine."""

from siftworks.config import JobConfig

__all__ = ["JobConfig"]
__version__ = "1.0.0"
