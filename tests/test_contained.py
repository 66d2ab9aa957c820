"""Items mostly in one document: random tables with odd rows against the SQL, and blocks of few items against one."""

import random

import duckdb

from vellumq.operators import contained as H
from vellumq.plans import registry


def odd(spark, tmp_path):
    r = random.Random(6)
    said = lambda n, m: " ".join(f"w{min(r.randrange(m), r.randrange(m))}" for _ in range(n))
    docs = [(i, said(r.choice([0, 3, 30, 90]), 60)) for i in range(40)] + [(None, said(60, 60)), (None, said(60, 60)), (5, said(60, 60)), (90, None), (91, ""), (92, "W1 w1 W2 w3 w4")]
    items = [(f"i{i}", said(r.choice([2, 4, 9, 20]), 60)) for i in range(30)] + [(None, said(9, 60)), ("x", None), ("y", ""), ("z", "w1 w1 w1 nowhere nowhere2 nowhere3"), ("i1", "w1 w2")]
    spark.createDataFrame([(*d, "en", "s") for d in docs], "doc_id bigint, text string, lang string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")


def test_odd_rows(spark, tmp_path):
    odd(spark, tmp_path)
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    got = registry.QUERIES["containment"](spark, str(tmp_path)).select("item_id", "doc_id", "share", "strong").collect()
    want = c.sql(f"SELECT item_id, doc_id, share, strong FROM ({registry.ORACLES['containment']})").fetchall()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert [x for x in want if x[1] is None] and [x for x in want if x[1] == 5]


def test_blocks(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "c d e"), (3, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([("p", "a", 2), ("p", "b", 1), ("q", "c", 1), ("q", "e", 1), ("r", "x", 3), ("r", "d", 2)], "item_id string, w string, n bigint")
    want = {("p", 1, 3), ("q", 1, 1), ("q", 2, 2)}
    for most in (1, 3, 100):
        assert {tuple(x) for x in H.half_held(docs, items, most).collect()} == want
    assert H.half_held(docs, items.limit(0)).count() == 0 and H.half_held(docs.limit(0), items).count() == 0


def test_no_word_of_a_candidate_is_joined(spark):
    """What is shuffled is a row for each document and each item found."""
    plan = registry.QUERIES["containment"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "Generate explode" not in plan and plan.count("SortMergeJoin") == 2
