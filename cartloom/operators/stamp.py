"""Run metadata on landed records."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(df: DataFrame, entity: str, source: str, run_id: str, now: datetime) -> DataFrame:
    """Add the five stamp columns, replacing same-named ones.

    ``now`` is one instant for the whole batch and is a literal in the plan, so a task that
    is run again after a lost executor stamps the same value.
    """
    if now.tzinfo is None:
        raise ValueError("now must carry a time zone")
    utc = now.astimezone(timezone.utc)
    return df.withColumns(
        {
            "_loaded_at": F.lit(f"{utc:%Y-%m-%d %H:%M:%S.%f}+00:00").cast("timestamp"),
            "_source": F.lit(source),
            "_entity": F.lit(entity),
            "_load_date": F.lit(f"{utc:%Y-%m-%d}").cast("date"),
            "_run_id": F.lit(run_id),
        }
    )
