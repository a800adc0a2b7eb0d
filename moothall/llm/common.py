"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import os
import tempfile
import threading
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import moothall

#: A word: a run of digits, small ASCII letters and characters beyond ASCII, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Share of the driver's heap that may be taken before a step lets go of what is used up; more is only garbage of many plans.
CROWDED = 0.55
#: Seconds between two looks at the driver's heap while steps run.
EVERY = 2.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bounded_batches(spark: SparkSession) -> None:
    """Hand rows to Python workers in batches of a few MB, however long the texts are; and keep only the start of each
    plan's text, of which iterative operators make hundreds that would fill the driver."""
    spark.conf.set("spark.sql.maxPlanStringLength", "8192")
    spark.conf.set("spark.sql.ui.explainMode", "simple")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session's cluster, once."""
    sc = spark.sparkContext
    if getattr(sc, "_moothall_shipped", False):
        return
    root = Path(moothall.__file__).parent
    file = Path(tempfile.mkdtemp()) / "moothall.zip"
    with zipfile.ZipFile(file, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"moothall/{p.relative_to(root)}")
    sc.addPyFile(str(file))
    sc._moothall_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the cluster names; set one only where none is named, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if named and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(tempfile.gettempdir(), "moothall-checkpoints"))


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut: they are in the shared checkpoint folder. Where plans and tasks of the steps so
    far have filled the driver's heap beyond ``CROWDED``, it is collected, so that it doesn't grow with an operator's steps."""
    ensure_checkpoint_dir(df.sparkSession)
    made = df.checkpoint(eager=True)
    if _taken(df.sparkSession) > CROWDED:
        release(df.sparkSession)
    return made


def _taken(spark: SparkSession) -> float:
    """The share of what it may be that the driver's heap is."""
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    return heap.totalMemory() / heap.maxMemory()


@contextmanager
def uncrowded(spark: SparkSession) -> Iterator[None]:
    """Collects the driver's heap while a step runs, too, where what its tasks leave has filled it beyond ``CROWDED``: a step of a
    large input has many tasks. It isn't collected again before it has grown, as what is left may be in use."""
    over, least = threading.Event(), CROWDED

    def look() -> None:
        nonlocal least
        while not over.wait(EVERY):
            if _taken(spark) > least:
                release(spark)
                least = max(CROWDED, 1.1 * _taken(spark))

    watch = threading.Thread(target=look, daemon=True)
    watch.start()
    try:
        yield
    finally:
        over.set()
        watch.join()


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that deals out both sides: a small side that is broadcast goes through the driver, in each join anew."""
    return df.hint("merge")


def release(spark: SparkSession) -> None:
    """Let the driver find out which checkpoints and shuffle files nothing refers to any more, so that they are removed while
    an operator of many steps goes on; Spark removes them when the driver collects its garbage, which a small plan rarely causes."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def settled(df: DataFrame) -> DataFrame:
    """``df``, put aside first unless it is read from files, with columns and rows chosen at most.

    Operators number rows by partition and place, in several branches of a plan. Files give the same numbers each time;
    rows from an exchange or a limit may not, as columns that a branch doesn't need are left out before it."""
    return df if set(_kinds(df._jdf.queryExecution().optimizedPlan())) <= {"Project", "Filter", "LogicalRelation"} else cut(df)


def _kinds(plan) -> list[str]:
    below = plan.children()
    return [plan.nodeName(), *(k for i in range(below.size()) for k in _kinds(below.apply(i)))]


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns that are computed once a row, however often later expressions refer to them.

    A generator stands between this projection and the next one, so that the optimizer doesn't copy an expensive
    expression into each place that uses it.
    """
    made = F.struct(*[c.alias(k) for k, c in cols.items()])
    df = df.withColumn("__once", F.explode(F.array(made)))
    for k in cols:
        df = df.withColumn(k, F.col(f"__once.{k}"))
    return df.drop("__once")


def lower_az(text: Column) -> Column:
    """A-Z to a-z and nothing else. Texts of one byte a character take the fast path."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.regexp_extract_all(lower_az(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))
