"""Columns that say where and when a row came from."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.model import DEFAULT_DATA_SOURCE, SOURCE_COLUMN, TIMESTAMP_COLUMN


def audit_columns(
    df: DataFrame,
    ingestion_timestamp: datetime | Column,
    data_source: str = DEFAULT_DATA_SOURCE,
    metadata: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Stamp every row; ``metadata`` adds constant columns and may overwrite any column.

    The time is passed in, not read from the clock, so a retried task or a
    repeated run stamps the same value.
    """
    moment = ingestion_timestamp if isinstance(ingestion_timestamp, Column) else F.lit(ingestion_timestamp)
    stamped = df.withColumns({TIMESTAMP_COLUMN: moment.cast("timestamp"), SOURCE_COLUMN: F.lit(data_source)})
    if metadata:
        stamped = stamped.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in metadata.items()})
    return stamped
