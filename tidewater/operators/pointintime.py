"""Point-in-time operators.

``events_relative_to`` attaches per-key anchor dates to (pre-aggregated) events
so a single conditional aggregate can count both sides of every anchor:
strictly-before (``ts < anchor``) and on-or-after (``ts >= anchor``). NULL
anchors or NULL event dates fall on neither side, as in the reference.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def events_relative_to(events: DataFrame, anchors: DataFrame, key: str, anchor_cols: Sequence[str]) -> DataFrame:
    """Events ⟕ anchors on ``key`` (anchors hold one row per key)."""
    return events.join(anchors.select(key, *anchor_cols), on=key, how="left")


def before(ts: str, anchor: str) -> Column:
    """P10: event strictly before the row's own anchor."""
    return F.col(ts) < F.col(anchor)


def on_or_after(ts: str, anchor: str) -> Column:
    return F.col(ts) >= F.col(anchor)


def within(ts: str, start: str, end: str) -> Column:
    """Half-open window ``start <= ts < end`` on literal dates (pushes down to Parquet)."""
    return (F.col(ts) >= F.lit(start).cast("date")) & (F.col(ts) < F.lit(end).cast("date"))


def switch_source(df: DataFrame, condition: Column, mapping: Mapping[str, tuple[str, str]],
                  neither: Column | None = None) -> DataFrame:
    """``out = when(condition, a).otherwise(b)`` for each ``out -> (a, b)``; NULL where ``neither`` holds."""
    pick = {out: F.when(condition, F.col(a)).otherwise(F.col(b)) for out, (a, b) in mapping.items()}
    if neither is not None:
        pick = {out: F.when(~F.coalesce(neither, F.lit(False)), c) for out, c in pick.items()}
    return df.withColumns(pick)
