"""Work on pages is dealt over the cluster, and what leaves a task is bounded."""

import pandas as pd
from pyspark.sql import functions as F

from moothall.operators import nodes, tree
from moothall.plans import extract, sites


def test_person_blocks_parse_in_many_tasks(spark):
    block = '<div class="PE_People_PersonBlock"><a href="https://x.org/id/1/0"><div class="NameLink">A</div></a><p><b>Ward:</b> W</p><img title="P (logo)"></div>'
    pages = spark.range(2000, numPartitions=1).select(F.col("id").cast("string").alias("council_id"), F.lit(block).alias("content"))
    details = spark.range(2000, numPartitions=1).select(F.concat(F.lit("https://x.org/id/"), "id").alias("url"), F.lit("<p class=Email>a@x.org").alias("content"))
    rows = extract.person_blocks(pages, details)
    tasks = rows.select("council_id", F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["count"] for r in tasks) < 1000
    plan = rows._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("ArrowEvalPython") :]
    assert plan.count("ArrowEvalPython") == 2 and below.count("REPARTITION_BY_NUM") == 2


def test_rows_of_a_batch_leave_in_pieces():
    page = "<nav><ul><li><a href=x>y</a></li></ul></nav><p><b>c</b>" * 50
    pages = pd.Series([page, None] * 200)
    most = 2 * (tree.PIECE // len(page) + 1)
    sizes = [[len(x) for x in run(iter([pages]))] for run in (nodes._every, nodes._parsed, lambda p: nodes._found(p, {"a": "a"}), lambda p: nodes._listed(p, "ul", "li", {}))]
    assert all(sum(s) == len(pages) and max(s) <= most for s in sizes)
    program = sites.programs_of({"s": {"row": [("select", "li")]}})["s"]
    listed = [len(x) for x in sites._list(iter([(pages, pages, pd.Series([program] * len(pages)))]))]
    assert sum(listed) == len(pages) and max(listed) <= most
    assert [len(p) for p in tree.bounded(iter([pages[:0], pages[:1]]))] == [0, 1]
