"""Dated CSV exports, to any file system Hadoop knows (``file:``, ``hdfs:``, ``s3a:`` …)."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame

log = logging.getLogger(__name__)


def dated_name(name: str, day: datetime) -> str:
    return f"{name}_{day:%Y_%m_%d}.csv"


def export_csv(df: DataFrame, root: str, name: str, day: datetime, *, required: bool = True) -> str | None:
    """Write ``<root>/<name>_YYYY_MM_DD.csv``: a folder of CSV parts with a header each.

    Parts are written where they are computed; nothing is gathered into one file. With
    ``required=False`` a failing destination is logged and the job goes on, returning None.
    """
    target = f"{root.rstrip('/')}/{dated_name(name, day)}"
    try:
        df.write.mode("overwrite").option("header", True).csv(target)
    except Exception:
        if required:
            raise
        log.exception("export to %s failed", target)
        return None
    return target
