"""Parts of qualified names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def repo_owner(name: Column) -> Column:
    """Owner in ``owner/repo``; the whole name if there is no slash."""
    return F.split(name, "/").getItem(0)
