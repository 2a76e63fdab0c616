"""Written intermediates in the folder that driver and executors share."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from rollwise.sources.sinks import session_folder
from rollwise.sources.sinks import stage as staged

__all__ = ["named", "new_path", "staged"]


def named(column: str) -> Column:
    """A column by its name, whatever characters it has."""
    return F.col("`" + column.replace("`", "``") + "`")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the session's shared folder."""
    return f"{session_folder(spark)}/{name}-{uuid4().hex}"
