"""The bucketed catalogue: only touched buckets are written, and readers see old or new."""

import os

import pytest
from pyspark.sql import functions as F

from wearlake.sources import catalogue

SCHEMA = "session_id string, episode int, text string, at int"


@pytest.fixture
def table(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.createDataFrame([(f"s{k % 20}", k // 20, f"v{k}", 0) for k in range(200)] + [(None, 0, "none", 0)], SCHEMA)
    catalogue.create(df, path, buckets=8)
    return path


def _files(path):
    return {os.path.join(a, f): os.path.getmtime(os.path.join(a, f)) for a, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def _rows(spark, path):
    return sorted((tuple(r) for r in catalogue.read(spark, path).collect()), key=str)


def test_merge_touches_its_buckets_only(spark, table):
    before, files = _rows(spark, table), _files(table)
    new = spark.createDataFrame([("s3", 1, "late", 2), ("s3", 1, "early", 1), ("s3", 99, "more", 1), (None, 0, "changed", 5)], SCHEMA)
    version = catalogue.merge(new, table, ["session_id", "episode"], "at")
    want = [r for r in before if r[:2] not in (("s3", 1), (None, 0))] + [("s3", 1, "late", 2), ("s3", 99, "more", 1), (None, 0, "changed", 5)]
    assert _rows(spark, table) == sorted(want, key=str) and version.number == 2
    assert all(_files(table).get(f) == t for f, t in files.items())  # nothing old was written again
    written = {f.split("_bucket=")[1].split("/")[0] for f in _files(table) if f not in files}
    assert 1 <= len(written) <= 2
    with pytest.raises(ValueError):
        catalogue.merge(new, table, ["episode"], "at")
    assert catalogue.merge(new.filter("false"), table, ["session_id", "episode"], "at").number == 2


def test_delete(spark, table):
    before = _rows(spark, table)
    version, gone = catalogue.delete(spark, table, F.lit(True), sessions=["s4", "nobody"])
    assert gone == 10 and _rows(spark, table) == [r for r in before if r[0] != "s4"] and version.number == 2
    assert catalogue.delete(spark, table, F.col("session_id") == "s4")[1] == 0
    version, gone = catalogue.delete(spark, table, F.col("session_id") == F.lit("s5"))
    assert gone == 10 and ("none" in [r[2] for r in _rows(spark, table)])  # a null condition deletes nothing
    everything, gone = catalogue.delete(spark, table, F.lit(True))
    assert gone == 181 and everything.held == {} and _rows(spark, table) == []
    assert catalogue.read(spark, table).columns == ["session_id", "episode", "text", "at"]


def test_failure_before_the_commit_leaves_the_old_table(spark, table, monkeypatch):
    before = _rows(spark, table)
    commit = catalogue._commit

    def broken(*_):
        raise OSError("lost")

    monkeypatch.setattr(catalogue, "_commit", broken)
    new = spark.createDataFrame([("s3", 1, "late", 2)], SCHEMA)
    with pytest.raises(OSError, match="lost"):
        catalogue.merge(new, table, ["session_id", "episode"], "at")
    assert _rows(spark, table) == before
    monkeypatch.setattr(catalogue, "_commit", commit)
    assert catalogue.vacuum(spark, table) == 1 and _rows(spark, table) == before
    catalogue.merge(new, table, ["session_id", "episode"], "at")
    assert ("s3", 1, "late", 2) in _rows(spark, table)


def test_two_changes_at_once(spark, table):
    old = catalogue.current(spark, table)
    catalogue.merge(spark.createDataFrame([("s3", 1, "late", 2)], SCHEMA), table, ["session_id", "episode"], "at")
    now = _rows(spark, table)
    with pytest.raises(RuntimeError, match="meanwhile"):
        catalogue._replace(spark, old, old.rows(spark, [0, 1]), [0, 1])
    assert _rows(spark, table) == now
    with pytest.raises(FileExistsError):
        catalogue.create(catalogue.read(spark, table), table)
    assert catalogue.vacuum(spark, table, keep=5) == 1 and catalogue.vacuum(spark, table) >= 0 and _rows(spark, table) == now


def test_an_open_reader_keeps_its_version(spark, table):
    open_now = catalogue.read(spark, table)
    catalogue.delete(spark, table, F.lit(True), sessions=["s1"])
    assert open_now.count() == 201 and catalogue.read(spark, table).count() == 191
