"""Several names held in one separated string."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_multi(col: Column | str, sep: str = ";") -> Column:
    """True when the text names more than one member."""
    return (F.col(col) if isinstance(col, str) else col).contains(sep)


def member_list(col: Column | str, sep: str = ";") -> Column:
    """The trimmed, non-empty member names in order."""
    names = F.split(col, re.escape(sep))
    trimmed = F.transform(names, lambda name: F.trim(name, F.lit(" \t\r\n")))
    return F.filter(trimmed, lambda name: name != "")
