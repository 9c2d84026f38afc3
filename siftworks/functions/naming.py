"""Source columns by their literal names.

Source names may hold dots, spaces or backticks. Names the engine adds start with
``_``, which no source column does; those of helper tables start with ``_sw_``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """The column of exactly this name."""
    return F.col(quoted_name(name))
