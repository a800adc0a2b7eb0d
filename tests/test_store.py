"""Transactions of the file store."""

import json

import pytest
from pyspark.sql import functions as F

from moothall.sources import store


def files(spark, *rows):
    return spark.createDataFrame(list(rows), store.FILES).repartition(3)


def councils(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "council_id string")


def there(spark, root):
    return sorted(tuple(r) for r in store.stored(spark, root).collect())


def test_sessions(spark, tmp_path):
    root = str(tmp_path / "data")
    assert there(spark, root) == []
    first = store.commit(files(spark, ("A", "1.json", "a1"), ("A", "2.json", "a2"), ("B", "x/é?.json", "b"), ("C", "1.json", "not of the session")), councils(spark, "A", "B"), root, "first run", "s1")
    assert first == {"number": 1, "session": "s1", "message": "first run", "applied": 3, "changed": ["A", "B"]}
    assert there(spark, root) == [("A", "1.json", "a1"), ("A", "2.json", "a2"), ("B", "x/é?.json", "b")]
    # what a council no longer has is gone, and so is a council whose rows all went; others stay
    store.commit(files(spark, ("A", "3.json", "a3"), ("A", "3.json", "a2"), ("D", "1", None)), councils(spark, "A", "B", "D"), root, "second run", "s2")
    assert there(spark, root) == [("A", "3.json", "a3"), ("D", "1", "")]
    assert store.stored(spark, root, "D").collect() == [("D", "1", "")]
    nothing = store.commit(files(spark, ("A", "9.json", "x")), councils(spark, "A").where("false"), root, "none", "s3")
    assert nothing == {"skipped": True, "reason": "no changes"} and len(store.Root(root).manifests()) == 2
    assert store.vacuum(root, keep=1) == ["s1"] and there(spark, root) == [("A", "3.json", "a3"), ("D", "1", "")]


def test_a_session_that_fails_changes_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/data"
    store.commit(files(spark, ("A", "1", "old")), councils(spark, "A"), root, "run", "s1")
    rows = files(spark, *[("A", str(i), "new") for i in range(50)])
    broken = rows.withColumn("content", F.when(F.col("file_name") == "7", F.raise_error(F.lit("lost"))).otherwise(F.col("content")))
    spark.dataSource.register(store.Store)
    with pytest.raises(Exception, match="lost"):
        broken.write.format("council_store").mode("append").options(root=root, message="run", session="s2").save()
    assert there(spark, root) == [("A", "1", "old")] and len(store.Root(root).manifests()) == 1
    # the same session can be tried again, since it wasn't committed
    store.commit(rows, councils(spark, "A"), root, "run", "s2")
    assert len(there(spark, root)) == 50


def test_what_is_refused(spark, tmp_path):
    root = str(tmp_path / "data")
    rows, own = files(spark, ("A", "1", "x")), councils(spark, "A")
    with pytest.raises(Exception, match="needs a message"):
        store.commit(rows, own, root, "  ", "s1")
    store.commit(rows, own, root, "run", "s1")
    with pytest.raises(Exception, match="session s1 is closed"):
        store.commit(rows, own, root, "again", "s1")
    late = store.StoreWriter({"root": root, "session": "s2", "message": "late"}, ["council_id", "file_name", "content"])
    message = late.write(iter(rows.collect()))
    store.commit(files(spark, ("A", "1", "y")), own, root, "between", "s3")
    with pytest.raises(RuntimeError, match="another session"):
        late.commit([message])
    late.abort([message])
    assert there(spark, root) == [("A", "1", "y")] and "s2" not in store.Root(root).names("files")


def test_repeated_attempts_are_not_seen(spark, tmp_path):
    root = str(tmp_path / "data")
    writer = store.StoreWriter({"root": root, "session": "s1", "message": "run"}, ["council_id", "file_name", "content"])
    rows = files(spark, ("A", "1", "x"), ("A", "2", "y")).collect()
    writer.write(iter(rows))
    writer.commit([writer.write(iter(rows)), None])
    assert there(spark, root) == [("A", "1", "x"), ("A", "2", "y")]
    manifest = json.loads((tmp_path / "data" / "manifests" / "000000001-s1.json").read_text())
    assert manifest["councils"]["A"]["files"] == 2 and len(manifest["councils"]["A"]["folders"]) == 1
