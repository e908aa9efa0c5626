"""Queries on small tables whose parts past the former cuts decide the result."""

import hashlib
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

from tests.compare import duck, rows
from wearlake import registry as core
from wearlake.functions import text as tx
from wearlake.operators import composites, series

SF = "/root/testdata/sf0.001"


def run(spark, name, folder, **tables):
    for t, (rows, kinds) in tables.items():
        spark.createDataFrame(rows, kinds).write.parquet(f"{folder}/{t}.parquet")
    return core.queries()[name](spark, str(folder)).toPandas()


DOCS = "doc_id long, text string"


def slots(text):
    """The terms of a text on their slots, in integers."""
    n = Counter()
    for t in re.findall(tx.TOKEN, (text or "").lower()):
        if t in tx.VOCABULARY:
            n[tx.VOCABULARY.index(t)] += 1
        for j in range(len(t) - 1):
            n[
                len(tx.VOCABULARY) + int(
                    hashlib.md5(t[j : j + 2].encode()).hexdigest(), 16
                ) % (tx.DIMENSIONS - len(tx.VOCABULARY))
            ] += 1
    return n


def label(text, table):
    return next((a for a, words in table.items() for w in words if w in text.lower()), None)


def test_labels_of_whole_texts(spark, tmp_path):
    docs = [
        (1, "x " * 500 + "UNLOCK"), (2, "x " * 500 + "shelf"), (3, "x" * 59 + " रखो"), (4, None), (5, ""),
        (6, "x " * 500),
    ]
    got = run(spark, "action_scenario_label", tmp_path, documents=(docs, DOCS)).set_index("doc_id")
    assert got.action_type.to_dict() == {
        1: "open_door", 2: "other", 3: "put_down", 4: "idle", 5: "other", 6: "navigate"
    }
    assert got.scenario[2] == "warehouse" and got.action_conf[1] == 0.85
    made = core.queries()["instruction_build"](spark, str(tmp_path)).toPandas().set_index("doc_id")
    assert made.instruction_hi[1] == docs[0][1] and made.instruction_en[3] == docs[2][1].replace("रखो", "put down")
    n = core.queries()["auto_label_summary"](spark, str(tmp_path)).toPandas()
    assert (
        n[n.value.isin(["open_door", "put_down", "warehouse"])].n == 1
    ).all() and n.value.isin(["open_door", "put_down", "warehouse"]).sum() == 3
    assert "open_door" in core.queries()["prediction_json"](
        spark, str(tmp_path)
    ).filter("doc_id = 1").first()["prediction"]


def test_labels_of_all_documents(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    got = core.queries()["action_scenario_label"](spark, SF).toPandas().set_index("doc_id")
    for k, text in zip(docs.doc_id, docs.text):
        assert (got.action_conf[k] == 0.85) == (label(text, tx.ACTIONS) is not None)
        assert got.action_type[k] == (label(text, tx.ACTIONS) or got.action_type[k])
        assert got.scenario[k] == (label(text, tx.SCENARIOS) or got.scenario[k])


def test_terms_of_whole_texts(spark, tmp_path):
    docs = [(1, "a-b " * 60 + "Pick the BOX उठाओ"), (2, None), (3, "पिक x"), (4, "İstanbul KelvinK ſort 😀go")]
    got = run(spark, "embed_text_tf", tmp_path, documents=(docs, DOCS))
    assert {(r.doc_id, r.slot): r.n for r in got.itertuples()} == {
        (k, s): n for k, t in docs for s, n in slots(t).items()
    }
    whole = pd.read_parquet(f"{SF}/documents.parquet")
    got = core.queries()["embed_text_tf"](spark, SF).toPandas()
    want = {(k, s): (n, c) for k, t in zip(whole.doc_id, whole.text) for c in [slots(t)] for s, n in c.items()}
    assert len(got) == len(want)
    for r in got.itertuples():
        n, c = want[r.doc_id, r.slot]
        assert r.n == n and abs(r.weight - n / math.sqrt(sum(x * x for x in c.values()))) < 1e-6


def test_overlaps_of_whole_conversations(spark, tmp_path):
    long = " ".join(f"w{k}" for k in range(60))
    turns = [(1, k, f"{long} t{k}") for k in range(12)] + [(2, 0, "only"), (3, 0, "a"), (3, 7, "b")]
    tables = {"conversations": (turns, "conv_id long, turn long, text string")}
    texts = run(spark, "overlap_text", tmp_path, **tables)
    best = core.queries()["overlap_best"](spark, str(tmp_path)).toPandas()
    want, top = {}, {}
    for c in (1, 2, 3):
        mine = [(o * 2.0, o * 2.0 + 2.5, t) for k, o, t in turns if k == c]
        for s in range(math.ceil(max(b for _, b, _ in mine) / 3.2)):
            over = [(min(b, s * 3.2 + 3.2) - max(a, s * 3.2), t) for a, b, t in mine]
            want[c, s] = " ".join(t for x, t in over if x > 0.1)
            x, t = max(over, key=lambda p: p[0])
            top[c, s] = t if x > 0 else "record egocentric task"
    assert {(r.session, r.segment): r.text for r in texts.itertuples()} == want
    assert {(r.session, r.segment): r.text for r in best.itertuples()} == top
    assert all(any(t in x for x in want.values()) for _, _, t in turns)


def test_windows_of_all_frames(spark, tmp_path):
    t0 = pd.Timestamp("2024-01-01")
    events = [(k, 3 if k < 70 else 900, (t0 + pd.Timedelta(seconds=k)).to_pydatetime(), k / 4, "a") for k in range(100)]
    got = run(
        spark, "audio_window", tmp_path,
        events=(events, "event_id long, user_id long, ts timestamp_ntz, value double, event_type string"),
    )
    want = {
        (u, k - (70 if u == 900 else 0)): (v * 2, 0.0 if k in (69, 99) else v * 2 + 0.5) for k, u, _, v, _ in events
    }
    assert len(got) == 100 and {(r.session, r.frame): (r.w0, r.w1) for r in got.itertuples()} == want


def test_windows_against_sql_without_filter(spark):
    want = duck(core.oracle_sql()["audio_window"], SF)
    assert rows(core.queries()["audio_window"](spark, SF).toPandas()) == rows(want)


ORDERS = "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string, o_totalprice double"


def test_split_of_all_episodes(spark, tmp_path):
    orders = [(k * 7 % 101, k, "1-URGENT" if k % 5 == 0 else "5-LOW", "O", 1.0) for k in range(101)]
    got = run(spark, "train_val_split", tmp_path, orders=(orders, ORDERS))
    assert dict(zip(got.id, got.split)) == {k: "train" if k < 80 else "val" for k in range(101)}


def test_split_counts_rows_not_keys(spark):
    for n, share in ((0, 0.8), (1, 0.8), (1, 0.0), (7, 0.29), (500, 0.29), (500, 1.0)):
        df = spark.createDataFrame(
            [(f"é{k % 37:03d}" if k % 11 else None, k % 5, k) for k in range(n)], "a string, b long, k long"
        )
        got = series.train_share(df, ["a", "b"], share, 8, 64).toPandas()
        keys = [((r.a is not None and r.a == r.a, r.a if isinstance(r.a, str) else ""), r.b) for r in got.itertuples()]
        train = [k for k, s in zip(keys, got.split) if s == "train"]
        assert len(got) == n and len(train) == min(n, max(1, int(n * share)))
        assert sorted(train) == sorted(keys)[: len(train)]


def test_split_has_no_global_window(spark):
    plan = series.train_share(spark.range(1000), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_literals_of_whole_vectors(spark, tmp_path):
    vectors = [(1, [k / 7 for k in range(64)]), (2, [0.0] * 63 + [1.5]), (3, None)]
    got = run(
        spark, "vector_literal", tmp_path, embeddings=(vectors, "vec_id long, embedding array<float>")
    ).set_index("vec_id").literal
    assert got[2] == "[" + "0.00000000," * 63 + "1.50000000]" and got[3] is None
    real = pd.read_parquet(f"{SF}/embeddings.parquet")
    got = core.queries()["vector_literal"](spark, SF).toPandas().set_index("vec_id").literal
    assert got.to_dict() == {
        k: "[" + ",".join(f"{x:.8f}" for x in v) + "]" for k, v in zip(real.vec_id, real.embedding)
    }


def test_tokens_and_mask(spark, tmp_path):
    docs = [(1, "ab😀क" + "x" * 60), (2, "short"), (3, ""), (4, None)]
    ids = lambda t: ",".join(str(ord(c) % 32000) for c in t[:50].ljust(50, "\0"))
    mask = lambda t: ",".join(str(int(k < len(t))) for k in range(50))
    got = run(spark, "tokenize_codepoints", tmp_path, documents=(docs, DOCS))
    assert {
        r.doc_id: (r.tokens, r.mask) for r in got.itertuples()
    } == {k: (ids(t or ""), mask(t or "")) for k, t in docs}
    real = pd.read_parquet(f"{SF}/documents.parquet")
    got = core.queries()["tokenize_codepoints"](spark, SF).toPandas()
    assert {r.doc_id: (r.tokens, r.mask) for r in got.itertuples()} == {
        k: (ids(t), mask(t)) for k, t in zip(real.doc_id, real.text)
    }


def test_numbers_of_a_small_table_are_not_broadcast(spark):
    long = series.numbered(spark.range(50), F.lit(0), F.lit(999), "k")
    both = long.join(spark.range(10_000_000).withColumnRenamed("id", "k"), "k")
    assert "Broadcast" not in both._jdf.queryExecution().executedPlan().toString() and both.count() == 50_000
    s = spark.createDataFrame([(k % 3, float(k), 1.0 * k) for k in range(30)], "session long, t double, a double")
    frames = series.grid(s, 0.5).withColumn("frame", (F.col("t") * 2).cast("long"))
    pcm = s.groupBy("session").agg(F.collect_list("a").alias("samples")).withColumn("rate", F.lit(1))
    out = composites.align_streams(frames, s, None, pcm, ("a",), window=2.0, block=4)
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    assert len(rows) == len({(r.session, r.frame) for r in rows}) == frames.count()
    at = {(r.session, r.t): list(r.audio) for r in rows}
    assert at[0, 0.0] == [0.0, 3.0] and at[0, 6.5] == [18.0, 21.0] and at[1, 28.0] == [0.0, 0.0]
