"""Index of the rows that an ingest has already taken (K9).

The index holds one 128-bit hash per row, in folders by the row's cell and the step that took it:
``_celda=<cell>/_paso=<step>``. The cell is the row's month (``grain``), followed by the hash's first ``digits`` hexadecimal
digits where a month's rows are too many to be read at once. Equal rows have equal cells, so a batch opens only the cells that its
own rows fall in. A month's cells stop growing when its rows have arrived: what a batch reads follows the batch
and the volume of its months, not the history. (Rows without a readable day share the cells of ``UNDATED``.)

A step looks only at the steps before it and replaces its own folders, so a replayed step finds the same rows new. Many small
folders of a cell are merged by ``compact``: first the merged folder is written, then the merged ones are
deleted; a hash that is found twice in between changes nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources.io import delete_folder, list_folder, read_small, write_small

ROW = "_fila"  # 128-bit hash of the raw row
CELL, STEP = "_celda", "_paso"
UNDATED = "sin_fecha"
MERGED = "~"  # a merged folder is named after its last step, and sorts between that and the next


class SeenRows:
    """The index in ``path``; its ``grain`` (a date pattern, months by default) and ``digits`` are fixed by its first step."""

    def __init__(self, spark: SparkSession, path: str, grain: str | None = None, digits: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        told = read_small(spark, f"{self.path}/_layout")
        known = json.loads(told) if told else {}
        self.grain = grain or known.get("grain", "yyyy-MM")
        self.digits = digits if digits is not None else known.get("digits", 0)
        self.empty = told is None
        if known and known != self._layout():
            raise ValueError(f"{path} is laid out by {told}, not by {self._layout()}")

    def _layout(self) -> dict:
        return {"grain": self.grain, "digits": self.digits}

    def keyed(self, raw: DataFrame, day: Column) -> DataFrame:
        """``raw`` with each row's hash and cell; ``day`` is a date made from its columns."""
        cells = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in raw.columns]
        digest = F.md5(F.to_json(F.array(*cells)))
        cell = F.concat_ws("-", F.coalesce(F.date_format(day, self.grain), F.lit(UNDATED)),
                           *([F.substring(digest, 1, self.digits)] if self.digits else []))
        return raw.withColumns({ROW: F.unhex(digest), CELL: cell})

    def folders(self, rows: DataFrame, step: str) -> list[str]:
        """What a batch has to read: the folders of its cells (as many as occur in it) from steps before ``step``."""
        if self.empty:
            return []
        cells = [f"{self.path}/{CELL}={r[0]}" for r in rows.select(CELL).distinct().collect()]
        return [f"{c}/{STEP}={s}" for c in sorted(cells) for s in self._steps(c) if s < step]

    def _steps(self, cell: str) -> list[str]:
        return [n.removeprefix(f"{STEP}=") for n, _, _ in list_folder(self.spark, cell) if n.startswith(f"{STEP}=")]

    def unseen(self, rows: DataFrame, step: str) -> DataFrame:
        """The ``rows`` (see ``keyed``) that no step before ``step`` has taken, each of them once."""
        folders = self.folders(rows, step)
        rows = rows.dropDuplicates([ROW])
        if not folders:
            return rows
        return rows.join(self.spark.read.schema(f"{ROW} binary").parquet(*folders), ROW, "left_anti")

    def add(self, rows: DataFrame, step: str) -> None:
        """Take the ``rows`` in the name of ``step``; a hot cell's rows spread over several files."""
        if self.empty:
            write_small(self.spark, f"{self.path}/_layout", json.dumps(self._layout()))
            self.empty = False
        (rows.select(ROW, CELL, F.lit(step).alias(STEP)).hint("rebalance", CELL)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(CELL, STEP).parquet(self.path))

    def read(self) -> DataFrame:
        """All hashes with their cell and step."""
        return self.spark.read.schema(f"{ROW} binary, {CELL} string, {STEP} string").parquet(self.path)

    def compact(self, cells: list[str], most: int = 16) -> int:
        """Merge the folders of each of ``cells`` that has more than ``most``; the number of cells merged.

        Call it between runs: it takes every folder that is there for committed.
        """
        n = 0
        for folder in (f"{self.path}/{CELL}={c}" for c in cells):
            names = sorted(self._steps(folder))
            if len(names) <= most:
                continue
            rows = self.spark.read.schema(f"{ROW} binary").parquet(*[f"{folder}/{STEP}={s}" for s in names])
            merged = names[-1].rstrip(MERGED) + MERGED
            # A merged folder that is merged again is read while its successor is written: the name must be new.
            merged += MERGED if merged in names else ""
            rows.distinct().write.mode("overwrite").parquet(f"{folder}/{STEP}={merged}")
            for s in names:
                delete_folder(self.spark, f"{folder}/{STEP}={s}")
            n += 1
        return n
