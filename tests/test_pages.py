"""The paged source of labelling tasks."""

import json
import re

import pytest
from pyspark.sql import functions as F

from wearlake.sources import pages


def put(folder, page, ids, session=lambda k: f"s{k % 3}", key="tasks"):
    tasks = [{"id": k, "data": {"session_id": session(k), "start_frame": k}, "annotations": [{"result": "[]", "completed_by": "x"}] * (k % 2)} for k in ids]
    folder.mkdir(exist_ok=True)
    (folder / f"page-{page}.json").write_text(json.dumps({key: tasks}))


def test_where_pages_end():
    for total in (0, 1, 4, 5, 6, 49, 50, 51, 333):
        asked = []

        def get(page, total=total, asked=asked):
            asked.append(page)
            return range(min(5, max(0, total - 5 * (page - 1))))

        assert pages.count_tasks(5, get) == total and len(asked) <= 16
        assert pages.count_tasks(5, get, total // 5 + 1) == total


def test_batch(spark, tmp_path):
    assert pages.read_tasks(spark, f"{tmp_path}/none").count() == 0
    put(tmp_path / "t", 1, range(0, 5))
    put(tmp_path / "t", 2, range(5, 10), key="results")
    put(tmp_path / "t", 3, range(10, 12))
    put(tmp_path / "t", 4, range(90, 95))  # behind the short page: not there
    df = pages.read_tasks(spark, f"{tmp_path}/t", 5)
    assert sorted(r.id for r in df.collect()) == list(range(12)) and df.rdd.getNumPartitions() == 3
    assert sorted((r.id, r.start, r.n) for r in df.select("id", "data.start_frame", F.size("annotations").alias("n")).withColumnRenamed("start_frame", "start").collect())[7] == (7, 7, 1)
    one = df.filter("session_id = 's1' and id > 2")
    assert sorted(r.id for r in one.collect()) == [4, 7, 10]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "id#" in plan and not re.search(r"session_id#\d+ = s1", plan)  # asked of the pages
    assert sorted(r.id for r in df.filter("session_id = 's1' and session_id = 's2'").collect()) == []
    with pytest.raises(Exception, match="path"):
        spark.read.format("task_pages").load().count()


def test_stream(spark, tmp_path):
    """New tasks in the last page and behind it come once, also after a restart."""
    pages.register(spark)
    seen = []

    def drain():
        made = []
        stream = spark.readStream.format("task_pages").option("path", f"{tmp_path}/t").option("page_size", 5).load()
        writer = stream.writeStream.foreachBatch(lambda b, _: made.extend(r.id for r in b.select("id").collect()))
        query = writer.option("checkpointLocation", f"{tmp_path}/state").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        seen.extend(made)
        return sorted(made)

    put(tmp_path / "t", 1, range(0, 5))
    put(tmp_path / "t", 2, range(5, 7))
    assert drain() == list(range(7))
    put(tmp_path / "t", 2, range(5, 10))
    put(tmp_path / "t", 3, range(10, 13))
    assert drain() == list(range(7, 13))
    assert drain() == [] and sorted(seen) == list(range(13))


def test_round_trip(spark, tmp_path):
    rows = [(k * 7 % 230, (f"s{k % 4}", k, None, 0, k), [(False, "[]", "a", None)] if k % 3 else []) for k in range(230)]
    df = spark.createDataFrame(rows, pages.labeling.TASKS).repartition(6)
    pages.write_pages(df, f"{tmp_path}/p", 50)
    back = pages.read_tasks(spark, f"{tmp_path}/p", 50)
    assert back.rdd.getNumPartitions() == 5
    plain = lambda d: sorted((r.id, tuple(r.data), [tuple(a) for a in r.annotations]) for r in d.collect())
    assert plain(back) == plain(df)
    assert [t["id"] for t in json.loads((tmp_path / "p" / "page-2.json").read_text())["tasks"]] == list(range(50, 100))
    pages.write_pages(df.filter("false"), f"{tmp_path}/e")
    assert pages.read_tasks(spark, f"{tmp_path}/e").count() == 0
