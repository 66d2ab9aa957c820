"""Learnt operators, the index, the pipeline and the queries themselves."""

import math
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from vellumq.llm import chat, decontaminate, jaccard, neighbours, packing, private, quality, registry, shared, toxicity

DATA = "/root/testdata"
needs_data = pytest.mark.skipif(not os.path.isdir(f"{DATA}/sf0.01"), reason="no tables")


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", 0.5, 1) for i, t in rows], "doc_id long, text string, label string, score double, key int").repartition(2)


# -- classifiers


@pytest.mark.parametrize(("operator", "label"), [(toxicity.toxicity, "toxic"), (quality.quality, "quality")])
def test_scores_of_odd_rows(spark, operator, label):
    texts = [f"alpha beta gamma {i} " * 20 + ("awful rotten " * 3 if i % 2 else "kind gentle ") for i in range(80)]
    docs = documents(spark, [*enumerate(texts), (None, "alpha"), (90, None), (91, ""), (92, " "), (3, "z" * 5000)])
    labels = spark.createDataFrame([(i, (i % 2) if label == "toxic" else 1 - i % 2) for i in range(80)] + [(5, None), (None, 1), (200, 1)], f"doc_id long, {label} int")
    out = operator(docs, labels, F.lit(True)).collect()
    assert len(out) == 85 and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r.score for r in out if r.doc_id != 3}
    bad = [by[i] for i in range(80) if i % 2 and i != 3]
    good = [by[i] for i in range(80) if not i % 2]
    assert (min(bad) > max(good)) if label == "toxic" else (np.mean(good) > np.mean(bad))
    assert by[90] == by[91]
    none = operator(docs, labels.limit(0), F.lit(True)).collect()
    assert {r.score for r in none} == {0.5}
    one = operator(docs, labels.filter(f"{label} = 1"), F.lit(True)).collect()
    assert all(r.score > 0.9 for r in one)
    assert operator(docs.limit(0), labels, F.lit(True)).count() == 0


def late_words(n):
    """Texts alike in their first 4 KB and told apart by what follows."""
    r = np.random.default_rng(6)
    start = " ".join(r.choice(["some", "plain", "words", "here"], 1000))
    return [(start + f" own{i}word " + " ".join(f"{'good' if i // 2 % 2 else 'bad'}{x}" for x in r.integers(0, 300, 150)), i // 2 % 2) for i in range(n)]


@pytest.mark.parametrize("size", [1 << 20, 4096])
def test_dictionaries_of_whole_texts(spark, size):
    rows = late_words(120)
    sample = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(rows[:80])], "order int, text string, label int")
    model = quality.train(sample, size)
    for y, held in ((1, b"".join(model[0])), (0, b"".join(model[1]))):
        assert (b"good" in held, b"bad" in held) == (y == 1, y == 0)
    docs = documents(spark, [(i, t) for i, (t, _) in enumerate(rows[80:])])
    assert all((r.score > 0.5) == (r.doc_id // 2 % 2 == 1) for r in quality.scored(docs, model).collect())


def test_dictionaries_have_one_way_at_every_size():
    texts = [(f"text {i} of some words that are said again and again, " * 9).encode() for i in range(40)]
    for n in (8, 20, 40):
        whole = sum(map(len, texts[:n]))
        held = quality.dictionary(texts[:n], 1 << 20)
        assert held[:4] == b"\x37\xa4\x30\xec" and len(held) <= max(256, whole // 8)
    assert quality.dictionary([], 4096) == quality.dictionary([b"x"], 4096) == b""


def labelled_texts(spark):
    r = np.random.default_rng(12)
    vocabulary = ["plain", "words", "here", "Älter", "and", "more", "x1", "longer-words"]
    texts = [" ".join(r.choice(vocabulary, r.integers(1, 90))) + (" awful rotten" if i % 3 == 0 else " kind") for i in range(90)]
    docs = documents(spark, enumerate(texts))
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 3 != 0)) for i in range(70)], "doc_id long, toxic int, quality int")
    return docs, labels


def plain_features(text):
    """Words, beginnings of four to six bytes, pairs and skip-grams, as themselves."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    out = {("w", x): 1.0 for x in w}
    out |= {("b", n, x.encode()[:n]): 1.0 for x in w for n in (4, 5, 6) if len(x.encode()) >= n}
    return out | {("p", gap, a, b): 0.3 for gap in (1, 2) for a, b in zip(w, w[gap:], strict=False)}


def plain_ftrl(rows, epochs=8, alpha=2.0, beta=1.0, l1=6.0):
    """FTRL-proximal, a coordinate at a time. Weights by feature; None: the constant."""
    z, n = {}, {}

    def weight(f):
        if f is not None and abs(z.get(f, 0)) <= l1:
            return 0.0
        return -(z.get(f, 0) - (math.copysign(l1, z.get(f, 0)) if f is not None else 0)) / ((beta + math.sqrt(n.get(f, 0))) / alpha)

    for _ in range(epochs):
        for features, y in rows:
            now = {f: weight(f) for f in features}
            p = 1 / (1 + math.exp(-sum(now[f] * v for f, v in features.items())))
            for f, v in features.items():
                g = (p - y) * v
                step = (math.sqrt(n.get(f, 0) + g * g) - math.sqrt(n.get(f, 0))) / alpha
                z[f], n[f] = z.get(f, 0) + g - step * now[f], n.get(f, 0) + g * g
    return {f: weight(f) for f in z}


def test_toxicity_by_plain_python(spark):
    docs, labels = labelled_texts(spark)
    rows = [(plain_features(r.text), r.label) for r in toxicity.labelled(docs, labels, "toxic", F.lit(True), 12_000, 1 << 30).orderBy("order", "label").collect()]
    assert len(rows) == 70
    seen = Counter(f for x, _ in rows for f in x)
    rows = [({f: v for f, v in x.items() if seen[f] >= 2} | {None: 1.0}, y) for x, y in rows]

    def margin(w, x):
        return sum(w.get(f, 0) * v for f, v in x.items())

    margins = [0.0] * len(rows)
    for half in (0, 1):
        w = plain_ftrl(rows[1 - half :: 2])
        margins[half::2] = [margin(w, x) for x, _ in rows[half::2]]
    slope, constant = toxicity.calibration(np.array(margins), np.array([y for _, y in rows]))
    w = plain_ftrl(rows)
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels, F.lit(True)).collect()}
    for r in docs.collect():
        want = 1 / (1 + math.exp(-(slope * margin(w, plain_features(r.text) | {None: 1.0}) + constant)))
        assert abs(got[r.doc_id] - want) < 1e-5


def test_quality_by_plain_compression(spark):
    docs, labels = labelled_texts(spark)
    rows = [(r.text.encode(), r.label) for r in toxicity.labelled(docs, labels, "quality", F.lit(True), 20_000, 1 << 30).orderBy("order", "label").collect()]

    def size(data, held):
        with_ = {"dict_data": zstandard.ZstdCompressionDict(held)} if held else {}
        return len(zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False, write_dict_id=False, **with_).compress(data))

    def values(data, pair):
        n = len(data) + 20
        good, bad, own = size(data, pair[0]) / n, size(data, pair[1]) / n, size(data, b"") / n
        return [bad - good, own, good, (bad - good) * min(1, 200 / (len(data) + 1)), own * own]

    pairs = [[zstandard.train_dictionary(max(256, sum(len(t) for t, y in rows[i::2] if y == want) // 8), [t for t, y in rows[i::2] if y == want]).as_bytes() for want in (1, 0)] for i in (0, 1)]
    x = np.array([values(t, pairs[i]) for i in (0, 1) for t, _ in rows[1 - i :: 2]])
    y = np.array([label for i in (0, 1) for _, label in rows[1 - i :: 2]])
    mean, scale = x.mean(0), x.std(0) + 1e-9
    w = np.zeros(6)
    x = np.column_stack(((x - mean) / scale, np.ones(len(x))))
    for _ in range(100):  # the penalised likelihood's best weights, by Newton steps without any bound
        p = 1 / (1 + np.exp(-x @ w))
        penalty = np.array([0.05] * 5 + [1e-6])
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
    got = {r.doc_id: r.score for r in quality.quality(docs, labels, F.lit(True)).collect()}
    for r in docs.collect():
        own = (np.mean([values(r.text.encode(), pair) for pair in pairs], axis=0) - mean) / scale
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-(own @ w[:5] + w[5])))) < 1e-3


@needs_data
def test_toxicity_of_held_out_rows(spark):
    check(spark, registry.QUERIES["op4_toxicity"](spark, f"{DATA}/sf0.1"), "toxic", 3, 1, f"{DATA}/sf0.1", 0.8, 0.9)


@needs_data
def test_quality_of_held_out_rows(spark):
    check(spark, registry.QUERIES["op10_quality"](spark, f"{DATA}/sf0.1"), "quality", 4, 2, f"{DATA}/sf0.1", 0.9, 0.9)


def check(spark, out, label, modulus, fold, data, recall, precision):
    rows = out.join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").toPandas()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % modulus == fold for i in rows.doc_id]).all()
    assert (rows.predicted == (rows.score >= 0.7)).all()
    held = rows[rows.held_out]
    true, said = held[label] == 1, held.predicted == 1
    assert (true & said).sum() >= recall * true.sum() and (true & said).sum() >= precision * said.sum()


def test_ftrl_is_sparse():
    r = np.random.default_rng(1)
    data = []
    for _ in range(400):
        y = int(r.random() < 0.3)
        places = np.unique(np.append(r.integers(10, 5990, 30), [5] if y else [6]))
        data.append((np.append(places, 6000), y))
    w = toxicity.fitted(data, 6000, 5)
    assert w[5] > 1 > w[6] and np.count_nonzero(w[:-1]) < 600


# -- neighbours


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1.0) for i, v in rows], "vec_id long, embedding array<float>, label int, v double").repartition(3)


def brute_nearest(rows, k=10):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and len(v) == 4 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ok = list({(i, tuple(v)): (i, v) for i, v in ok}.values())
    out = {}
    for q, v in ok:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for i, w in ok if i != q)[:k]
            out[q] = near
    return out


def test_nearest_by_brute_force(spark):
    r = np.random.default_rng(2)
    rows = [(i, r.normal(size=4).round(1).tolist()) for i in range(600)] + [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(600, 900)]
    rows += [(1000, None), (1100, [0.0] * 4), (1200, [None, 1.0, 1.0, 1.0]), (1300, [float("nan")] * 4), (1400, [float("inf")] + [1.0] * 3), (1500, [1.0]), (None, [1.0] * 4), (600, [1.0, 2.0, 3.0, 4.0])]
    index = neighbours.Index(vectors(spark, rows), recall=1.0, leaf_rows=40, full=30)
    assert index.tree.leaves > 3
    index.visits = index.tree.leaves  # all leaves: exact
    got = {}
    for x in index.search(index.rows.filter("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.score, x.vec_id))
    want = brute_nearest(rows)
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [i for _, i in got[q]] == [i for _, i in near] and np.allclose([d for d, _ in got[q]], [d for d, _ in near])


def test_few_vectors(spark):
    few = neighbours.Index(vectors(spark, [(0, [1.0, 2.0]), (1, [1.0, 3.0]), (2, [1.0, 2.0])]))
    assert [(x.query_id, x["rank"], x.vec_id) for x in few.search(few.rows.filter("vec_id = 0")).orderBy("rank").collect()] == [(0, 1, 2), (0, 2, 1)]
    none = neighbours.Index(vectors(spark, [(0, None)]))
    assert none.search(none.rows).count() == 0


@needs_data
def test_recall(spark):
    data = f"{DATA}/sf0.1"
    found = registry.QUERIES["op9_nearest_neighbours"](spark, data).toPandas()
    rows = spark.read.parquet(f"{data}/embeddings.parquet").toPandas()
    v, ids = np.stack(rows.embedding).astype(float), rows.vec_id.values
    hit = n = 0
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((v - v[ids == q][0]) ** 2).sum(1))
        far[ids == q] = np.inf
        true = set(ids[np.lexsort((ids, far))[:10]].tolist())
        hit, n = hit + len(true & set(found[found.query_id == q].vec_id)), n + 10
    assert hit >= 0.9 * n


# -- queries


@needs_data
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracles(spark, name):
    data = f"{DATA}/sf0.001"
    c = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    want = c.sql(registry.ORACLES[name])
    got = registry.QUERIES[name](spark, data)
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    a = sorted(map(repr, (tuple(r) for r in got.select(names).collect())))
    assert a == sorted(map(repr, want.select(", ".join(f'"{n}"' for n in names)).fetchall()))


@needs_data
@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_queries_run(spark, name):
    data = f"{DATA}/sf0.001"
    got = registry.QUERIES[name](spark, data).toPandas()
    docs = spark.read.parquet(f"{data}/{'embeddings' if name == 'op11_near_vectors' else 'documents'}.parquet").count()
    assert len(got) and (name in ("op1_packing", "op9_nearest_neighbours") or len(got) == docs)


# -- pipeline


def test_pipeline_by_brute_force(spark, tmp_path):
    import corpus_pipeline as pipeline

    vile = ["idiot moron scum", "pathetic loser trash", "stupid clown disgusting"]
    texts = [(i, " ".join(f"w{(i * 37 + j * j) % 997}" for j in range(60)) + (" " + vile[i % 3] if i % 4 == 0 else "")) for i in range(120)]
    passage = " ".join(f"q{j}" for j in range(14))
    texts += [(200, texts[1][1] + " end"), (201, texts[1][1]), (202, "lead " + passage + " tail"), (203, "write to jo.doe@mail.org or +1 415 555 0134 soon " * 2), (204, None), (205, ""), (201, texts[1][1])]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, passage), (1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(120)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "private_data", "packing"]

    at, got = shared.table(spark, str(tmp_path), "documents"), {}
    for name, stage in pipeline.STAGES[:-1]:
        before = at.orderBy("doc_id").collect()
        at = shared.written(stage(spark, at, str(tmp_path)), name)
        assert at.columns == docs.columns
        got[name] = (before, at.orderBy("doc_id").collect())
    before, after = got["toxicity"]
    assert {r.doc_id for r in after} == {i for i, _ in texts if i >= 120 or i % 4}
    before, after = got["near_duplicates"]
    from test_text_operators import brute_classes

    known = brute_classes([r.text or "" for r in before], 5, 80)
    assert len(after) == len({c for _, c in known.values()}) and {200, 201} & {r.doc_id for r in after} == set()
    before, after = got["decontamination"]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {202}
    before, after = got["private_data"]
    model = private.model(docs.filter(F.col("doc_id").isin([r.doc_id for r in before])).dropDuplicates())
    for b, a in zip(before, after, strict=True):
        spans = [x[:3] for x in model.spans(b.text or "")]
        assert a.text == (b.text if b.text is None else private.redacted(b.text, spans))
        assert a.n_chars == (b.n_chars if a.text is None else len(a.text))
    assert "@" not in "".join(a.text or "" for a in after)
    pieces = pipeline.run(spark, str(tmp_path)).collect()
    import public_tokenizers

    encode = packing.encoder(public_tokenizers.path("byte_bpe_50k.json"), None)
    want = sorted((r.doc_id, n) for r in after for n in packing.cuts(len(encode(r.text or "")) + 1, 1024))
    assert sorted((p.doc_id, p.length) for p in pieces) == want
    assert chat and decontaminate and jaccard and quality


@pytest.mark.parametrize("texts", [[], [None, None, ""], ["one text"] * 3, ["long " * 200_000, "long " * 200_000, None]])
def test_stages_of_odd_tables(spark, tmp_path, texts):
    """Empty tables, nulls, repeated rows with null ids, very long texts, and tables without items or labels."""
    import corpus_pipeline as pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(None if i == 2 else 7, t, None, None, None) for i, t in enumerate(texts)], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at = shared.table(spark, str(tmp_path), "documents")
    for name, stage in pipeline.STAGES[:-1]:
        at = shared.written(stage(spark, at, str(tmp_path)), name)
        assert at.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = [r.text for r in at.collect()]
    want = {(): 0, (None, None, ""): 3, ("one text",) * 3: 1}.get(tuple(texts), 2)
    assert len(kept) == want
    pieces = pipeline.STAGES[-1][1](spark, at, str(tmp_path)).collect()
    assert len({(p.doc_id, p.start) for p in pieces}) >= min(1, len(kept))


# -- samples of very many rows


def test_shares_are_never_empty(spark):
    rows = spark.range(200_000).select(F.xxhash64("id").alias("h"))
    for share in (0.0, 1e-30, 0.25, 1.0, 7.0):
        n = rows.filter(shared.within(F.col("h"), share)).count()
        assert abs(n - min(1.0, share) * 200_000) < 900
    # of 10^12 rows a share of 20,000 still has parts, and keeps what is that small
    assert spark.sql("SELECT 5L AS h, -1L AS far").filter(shared.within(F.col("h"), 20_000 / 10**12)).filter(~shared.within(F.col("far"), 20_000 / 10**12)).count() == 1


def test_long_spans_are_cut_not_left_out(spark):
    text = "mail " + "x" * 5000 + "@example.com and a word behind it"
    held = private.contexts(documents(spark, [(1, text)]), span_chars=100)
    assert held and all(e - s <= 100 and " and a word" in t and len(t) < 400 for t, s, _, e in held)
