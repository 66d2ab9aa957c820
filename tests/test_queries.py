"""Every query against its oracle, and the entry points without the optional folders."""

import os
import subprocess
import sys

import duckdb
import pytest

from vellumq.plans import registry
from vellumq.session import TABLES

DATA = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


def plain(x):
    if isinstance(x, float):
        return "nan" if x != x else repr(round(x, 9) + 0.0)
    if isinstance(x, (list, tuple)):
        return repr([plain(y) for y in x])
    return str(x)


def rows(found):
    return sorted(tuple(plain(x) for x in r) for r in found)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, duck, name):
    want = duck.sql(registry.ORACLES[name])
    got = registry.QUERIES[name](spark, DATA)
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    assert rows(got.select(names).collect()) == rows(want.select(", ".join(f'"{n}"' for n in names)).fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, DATA).toPandas() is not None


def written(spark, path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_slips_of_all_later_copies(spark, tmp_path):
    lines = [f"line {i} of a text that all copies have in common" for i in range(8)]
    texts = ["\n".join(lines)] * 2 + ["\n".join(x.replace("common", "use") if i == n else x for i, x in enumerate(lines)) for n in range(5)]
    got = registry.QUERIES["slips3"](spark, written(spark, tmp_path, texts)).collect()
    assert {(r.doc, r.early, r.witness, r.word, r.was) for r in got} == {(d, 0, 1, "use", "common") for d in range(2, 7)}


def test_map_of_all_positions(spark, tmp_path):
    lines = [f"line {i} of a text that both of the copies hold" for i in range(12)]
    texts = ["\n".join(lines), "\n".join(x.replace("line 5 of", "line 5 more of") for x in lines)]
    got = registry.QUERIES["position_map"](spark, written(spark, tmp_path, texts)).collect()
    n = sum(len(x.split()) for x in lines)
    assert sorted((r.a, r.b, r.p) for r in got) == [(0, 1, p) for p in range(n)]
    assert all(texts[0].split()[r.p] == texts[1].split()[r.q] for r in got)


def test_entry(spark):
    sys.path.insert(0, ROOT)
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 60


def test_entry_alone():
    """The queries don't need the optional operators."""
    code = "import sys\nsys.modules['vellumq.llm'] = None\nsys.modules['corpus_pipeline'] = None\nimport __spark_entry__ as e\nassert not [q for q in e.queries() if q.startswith('op')] and 'pipeline' not in e.queries()\nassert len(e.queries()) > 50 and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_the_optional_operators():
    for folder, _, names in os.walk(f"{ROOT}/vellumq"):
        for name in names:
            if name.endswith(".py") and "llm" not in folder:
                with open(os.path.join(folder, name)) as f:
                    assert "vellumq.llm" not in f.read()


def test_text_without_a_match(spark, tmp_path):
    lines = [f"paragraph {i} that the two of them have word for word" for i in range(6)]
    texts = ["\n".join(lines), "\n".join(lines), "\n".join(["1 2 3", *[f"{x} {y}" for x, y in zip("abcdef", lines, strict=True)]]), "\n".join(str(i) * 30 for i in range(5)), "\n".join(str(i) * 30 for i in range(5))]
    got = registry.QUERIES["forward_match"](spark, written(spark, tmp_path, texts)).collect()
    assert {(r.doc, r.n, r.k) for r in got if r.doc == 1} == {(1, i, i) for i in range(6)} and not [r for r in got if r.doc == 4]


@pytest.mark.parametrize("name", ["token_coverage", "decision_report"])
def test_capitals_letter_by_letter(spark, tmp_path, name):
    """Letters whose capitals are several, or that hang on what follows, as SQL has them."""
    rows_ = [(i, t, "de", "s") for i, t in enumerate(["ßein ßer. ßein Verß. STRAßE ŉa. ﬁn ΣΑΣ İa ᾳa. ᾳb"] * 12)]
    frame = spark.createDataFrame(rows_, "doc_id long, text string, lang string, source string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = registry.QUERIES[name](spark, str(tmp_path))
    names = sorted(got.columns)
    assert rows(got.select(names).collect()) == rows(c.sql(f"SELECT {', '.join(names)} FROM ({registry.ORACLES[name]})").fetchall())


def test_held_words_are_not_broadcast(spark):
    """A table of words is far larger in memory than its files say: joins with it are merges."""
    plan = registry.QUERIES["containment"](spark, DATA)._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("SortMergeJoin") >= 2
