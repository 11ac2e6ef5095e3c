"""The cleaning routine: drop copies, then fill what is missing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ratelake.functions.parsing import is_floating, nan_to_null
from ratelake.model import quoted
from ratelake.operators.dedupe import drop_duplicate_rows
from ratelake.operators.impute import impute_median_mode
from ratelake.session import materialize


def clean(df: DataFrame, stage: Callable[[DataFrame], DataFrame] = materialize) -> DataFrame:
    """Whole-row dedupe, median fill, mode fill.

    Copies go first and so do not weight the statistics. The deduplicated rows
    are staged: the statistics take several passes, each over a few columns.
    """
    floating = [f.name for f in df.schema if is_floating(f.dataType)]
    one_missing = df.withColumns({c: nan_to_null(quoted(c)) for c in floating}) if floating else df
    return impute_median_mode(stage(drop_duplicate_rows(one_missing)))
