"""Work on councils one by one, each of which may fail without the others.

A function gets a council's key and its rows, in batches as they come, and yields its results. What it raises becomes the
council's error, and a council with an error has no results, as nothing of a failed run is kept. ``at_once`` says how many
councils are worked on at the same time, whatever the cluster's size, for work that asks others' servers.

Rows come to a task ordered by council, so a council is never held whole by Spark; a function that reads its batches one by
one doesn't hold it either. Results are put into the shared checkpoint folder before they are sorted into kept and failed, so no
council is worked on twice for that.
"""

from __future__ import annotations

import traceback
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from moothall.sources.shared import put_aside

#: A council's work: its key and its rows to its results.
Work = Callable[[str, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


class _Groups:
    """Batches in order of a key, as one iterator of batches for each key."""

    def __init__(self, batches: Iterator[pd.DataFrame], key: str):
        self.batches, self.key, self.rest = batches, key, None

    def __iter__(self) -> Iterator[tuple[str, Iterator[pd.DataFrame]]]:
        while self._more():
            at = self.rest[self.key].iloc[0]
            yield at, self._of(at)
            for _ in self._of(at):  # what the work left unread
                pass

    def _more(self) -> bool:
        while self.rest is None or not len(self.rest):
            self.rest = next(self.batches, None)
            if self.rest is None:
                return False
        return True

    def _of(self, at) -> Iterator[pd.DataFrame]:
        while self._more():
            same = self.rest[self.key] == at
            n = len(same) if same.all() else int((~same).to_numpy().argmax())
            if not n:
                return
            batch, self.rest = self.rest.iloc[:n], self.rest.iloc[n:]
            yield batch.reset_index(drop=True)


def _result_columns(result: str | StructType, df: DataFrame) -> StructType:
    return result if isinstance(result, StructType) else df.sparkSession.createDataFrame([], result).schema


def isolated(rows: DataFrame, work: Work, result: str | StructType, key: str = "council_id", at_once: int = 8, details: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(results, failures) of ``work`` over ``rows``, by ``key`` (a text that isn't null): results have ``key`` and the columns of
    ``result``, failures ``key``, ``error`` and ``trace`` (its last ``details`` characters)."""
    fields = _result_columns(result, rows)
    names = fields.fieldNames()
    own = StructType([StructField(key, StringType()), *[f for f in fields.fields if f.name != key], StructField("__error", StringType()), StructField("__trace", StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for at, group in _Groups(batches, key):
            try:
                for made in work(at, group):
                    made = made[[n for n in names if n != key]]
                    yield made.assign(**{key: at, "__error": None, "__trace": None})[own.fieldNames()]
            except Exception as e:  # the council's failure, and its alone
                empty = {n: [None] for n in own.fieldNames()}
                yield pd.DataFrame(empty | {key: [at], "__error": [f"{type(e).__name__}: {e}"], "__trace": [traceback.format_exc()[-details:]]}).astype(object)

    dealt = rows.where(F.col(key).isNotNull()).repartition(at_once, key).sortWithinPartitions(key)
    done = put_aside(dealt.mapInPandas(run, own))
    failures = done.where("__error IS NOT NULL").select(key, F.col("__error").alias("error"), F.col("__trace").alias("trace"))
    kept = done.where("__error IS NULL").drop("__error", "__trace").join(failures.select(key), key, "left_anti")
    return kept, failures
