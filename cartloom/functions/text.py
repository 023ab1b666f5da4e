"""Path text and run identity."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_prefix(path: Column | str, prefix: str) -> Column:
    """``path`` without every occurrence of ``prefix``."""
    path = F.col(path) if isinstance(path, str) else path
    return F.replace(path, F.lit(prefix), F.lit(""))


def new_run_id() -> str:
    """One random id per run, made on the driver and passed in as a literal."""
    return str(uuid.uuid4())
