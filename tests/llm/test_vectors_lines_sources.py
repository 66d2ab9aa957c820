"""Near vectors, first-seen lines and source divergence: brute force, the SQL, and the defined results for odd rows."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vellumq.llm import divergence, firstseen, polytope

# -- near vectors


def links(rows, cosine=0.9):
    """n_links and component of each row by brute force."""
    fit = [i for i, (name, v) in enumerate(rows) if name is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    near, least = defaultdict(set), {i: i for i in range(len(rows))}
    for i in fit:
        for j in fit:
            a, b = rows[i][1], rows[j][1]
            if i != j and len(a) == len(b):
                a, b = np.array(a) / np.abs(a).max(), np.array(b) / np.abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                    near[i].add(j)
    seen, out = set(), []
    for i in fit:
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - group:
                group.add(j)
                todo.append(j)
        seen |= group
        for j in group:
            least[j] = min(rows[k][0] for k in group)
    for i, (name, _) in enumerate(rows):
        out.append((name, len(near[i]), least[i] if i in fit else name))
    return sorted(out, key=repr)


def clouds(random, size=16):
    """A tight group, a wide one whose members all link though no leader covers them, a chain, loose vectors, and copies."""
    centre = random.normal(size=(4, size))
    centre /= np.linalg.norm(centre, axis=1)[:, None]
    tight = centre[0] + 0.02 * random.normal(size=(120, size))
    wide = centre[1] + 0.055 * random.normal(size=(60, size))
    chain = [centre[2] * math.cos(0.2 * i) + centre[3] * math.sin(0.2 * i) for i in range(7)]
    loose = random.normal(size=(150, size))
    rows = [*tight, *wide, *chain, *loose, *([tight[0] * 1e200] * 3), *([loose[0]] * 40), loose[1] * 1e-200]
    return [v.tolist() for v in rows]


@pytest.mark.parametrize("sizes", [{}, {"full": 15, "block": 8, "leaders": 1, "bucket": 4}, {"full": 10, "block": 16, "leaders": 3, "probes": 6}])
def test_near_vectors_by_brute_force(spark, sizes):
    random = np.random.default_rng(9)
    vectors = clouds(random)
    order = random.permutation(len(vectors))
    rows = [(int(i) * 3, vectors[k]) for i, k in enumerate(order)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = polytope.NearVectors(table, recall=0.9999, **sizes).result().collect()
    want = links(rows)
    found = sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr)
    assert [x[0] for x in found] == [x[0] for x in want]
    assert all(a[1] <= b[1] for a, b in zip(found, want, strict=True))  # never a link below the threshold
    assert sum(x[1] for x in found) >= 0.998 * sum(x[1] for x in want)
    assert np.mean([a == b for a, b in zip(found, want, strict=True)]) > 0.98


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (2, [1.0, 0.1]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 0.0]), (None, None), (8, [1.0]), (9, [1.0, 0.0, 0.0]), (10, []), (11, [2.0])]
    table = spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], "vec_id long, embedding array<double>, v string, entry int, class double").repartition(3)
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in polytope.NearVectors(table).result().collect()), key=repr)
    assert got == links(rows)
    none = polytope.NearVectors(table.limit(0)).result()
    assert none.count() == 0 and none.columns == ["vec_id", "n_links", "component_id"]


def test_rotations_keep_length_and_tables_keep_recall():
    x = polytope.unit(np.random.default_rng(3).normal(size=(50, 64)))
    assert np.allclose(np.linalg.norm(polytope.hadamard(x), axis=1), 1)
    own = polytope.Hash(64, 2, 1, 8).codes(x)
    assert own.shape == (50, 8) and all(len(set(r)) == 8 for r in own.tolist())
    assert polytope.tables_for(64, 1, 8, 0.9, 0.99) <= polytope.tables_for(64, 3, 8, 0.9, 0.99)


# -- first-seen lines


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def stripped(rows, batches, least=20, held=2):
    """What brute force keeps of (id, text, batch), and the ledger."""
    before, docs, lines, ledger = Counter(), [], Counter(), {}
    for n in range(batches):
        now = Counter()
        for name, text, batch in rows:
            if batch != n:
                continue
            own = (text or "").split("\n")
            gone = [i for i, x in enumerate(own) if len(key_of(x)) >= least and before[key_of(x)] >= held]
            for i in gone:
                lines[key_of(own[i])] += 1
                ledger.setdefault(key_of(own[i]), n)
            docs.append((name, n, len(own), len(gone), "\n".join(x for i, x in enumerate(own) if i not in gone)))
            now.update({key_of(x) for x in own})
        before += now
    sha = lambda k: hashlib.sha256(k.encode()).hexdigest()
    return sorted(docs, key=repr), sorted((sha(k), n, before[k], lines[k]) for k, n in ledger.items())


LONG = "This line is longer than twenty"
SHORT = "exactly nineteen ch"
LINES = [
    (1, f"{LONG}\n{SHORT}\n\n", 0), (2, f"  {LONG.upper()}\t\n{LONG}", 0), (3, f"{LONG}\nx\n\x0b{LONG}\r", 1), (4, None, 1), (5, "", 1), (6, f"{LONG}", 3), (7, f"a\n{LONG}\n{LONG} ", 3), (7, f"a\n{LONG}\n{LONG} ", 3),
    (None, f"É{LONG}\n{SHORT}!", 0), (8, f"É{LONG}\n{SHORT}!", 0), (9, f"é{LONG}\n{SHORT}!\n\n", 1), (10, f"É{LONG}\n {SHORT}!", 3), (11, "y" * 50_000 + "\n" + f"{SHORT}!\n" * 2000, 3), (12, f"{SHORT}\n{SHORT}", 3),
]


def test_lines_by_brute_force(spark):
    rows = [(i, t, 7, b, "x", 0.5) for i, t, b in LINES]
    table = spark.createDataFrame(rows, "doc_id long, text string, row int, batch int, lines string, key double").repartition(3)
    stripper = firstseen.Stripper(table, F.col("batch"), 4)
    out = stripper.run()
    docs, ledger = stripped(LINES, 4)
    assert sorted(((r.doc.doc_id, r.outcome.batch, r.outcome.n_all, r.outcome.n_removed, r.outcome.kept) for r in out.collect()), key=repr) == docs
    assert {r.doc.row for r in out.collect()} == {7} and {r.doc.lines for r in out.collect()} == {"x"}  # clashing names stay with the document
    assert sorted((r.key.hex(), r.batch, r.n_all, r.n_removed) for r in stripper.ledger().collect()) == ledger
    assert len(ledger) == 3 and sum(x[3] for x in ledger) > 2000


def test_no_lines(spark):
    stripper = firstseen.Stripper(spark.createDataFrame([], "doc_id long, text string"), F.lit(0), 2)
    assert stripper.run().count() == 0 and stripper.ledger().count() == 0


def test_lines_query_and_its_sql(spark, tmp_path):
    texts = [f"{LONG}\nown line of document {i}\n{SHORT}" if i % 3 else f"{LONG} \n{LONG}" for i in range(60)]
    rows = [*enumerate(texts), (None, LONG), (70, None), (70, LONG)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in firstseen.op12_first_seen_lines(spark, str(tmp_path)).collect()), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(con.execute(firstseen.ORACLE_SQL).fetchall(), key=repr)
    number = lambda i: 10 * (zlib.crc32(("" if i is None else str(i)).encode()) % 64) // 64
    docs, ledger = stripped([(i, t, number(i)) for i, t in rows], 10)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [("doc", None if i is None else str(i), b, n, k, sha(t)) for i, b, n, k, t in docs] + [("line", *x, None) for x in ledger]
    assert got == sorted(want, key=repr)


# -- source divergence


def odd_sources(spark):
    random = np.random.default_rng(4)
    vocabulary = ["alpha", "Beta", "gamma", "délta", "eps", "zeta", "eta"]
    rows = []
    for i in range(240):
        n = int(random.integers(0, 12))
        text = " ".join(random.choice(vocabulary, n, p=[0.3, 0.2, 0.2, 0.1, 0.1, 0.05, 0.05])) + (" rare" if i < 8 else "") + ("1x-y" if i % 9 == 0 else "")
        rows.append((i, text, ["en", "fr", None][i % 3], ["s1", "s2", "s3", None, ""][int(random.integers(0, 5))], "z", 1))
    rows += [(1000 + i, "solo", "en", "s9", "z", 1) for i in range(11)]
    rows += [(900, None, "en", "empty", "z", 1), (901, "", "xx", "s1", "z", 1), (902, "... 12", "xx", "s2", "z", 1), (903, "alpha " * 30_000, "en", "s1", "z", 1), (904, "é" * 40_000, None, "s2", "z", 1), (1, "alpha", "en", "s1", "z", 1), (None, "alpha", "en", "s1", "z", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, term string, count int").repartition(4)


def audited(docs):
    """Values of all pairs and the leading terms by brute force."""
    import re

    fold = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for r in docs:
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", fold(r.text))
        group = (r.lang or "", r.source or "")
        groups.add(group)
        counts[group].update(found)
        held[group[0]].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in held[lang].items() if n >= 10)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * len(kept)) for t in kept}  # noqa: E731, B023
        sources = sorted(g[1] for g in groups if g[0] == lang)
        p = {s: share(counts[lang, s]) for s in sources}
        whole = share(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            terms = sorted((-f(p[s][t], whole[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > whole[t])[:10]
            out += [(lang, s, part, item.decode(), -v, i) for part, rows in (("pair", pairs), ("term", terms)) for i, (v, item) in enumerate(rows, 1)]
    return sorted(out)


def test_sources_by_brute_force(spark, tmp_path):
    docs = odd_sources(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in divergence.op13_source_divergence(spark, str(tmp_path)).collect())
    want = audited(docs.collect())
    assert got == want and {x[2] for x in got} == {"pair", "term"} and any(x[0] == "xx" and x[4] == 0 for x in got)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(con.execute(divergence.ORACLE_SQL).fetchall())


def test_histograms_cover_the_vocabulary(spark):
    docs = odd_sources(spark)
    kept = divergence.term_counts(docs, flush=3).cache()
    group = divergence.groups(docs, kept)
    v = {r.lang: r.v for r in divergence.languages(kept).collect()}
    cells = divergence.joint_histograms(kept, group).collect()
    assert all(r.terms > 0 for r in cells)
    sums = Counter()
    for r in cells:
        sums[r.lang, r.a, r.b] += r.terms
    assert sums and all(n == v[k[0]] for k, n in sums.items())
    assert any(r.count_a == 0 and r.count_b == 0 for r in cells) and any(r.count_a == 0 < r.count_b for r in cells)
    kept.unpersist()


def test_no_sources(spark):
    docs = odd_sources(spark).limit(0)
    kept = divergence.term_counts(docs)
    assert kept.count() == 0 and divergence.divergence(kept, divergence.groups(docs, kept)).count() == 0


def test_shares_beyond_64_bits(spark):
    rows = [(0, 0, 1), (10**13, 10**14, 10**6), (10**17, 10**18, 10**9), (5, 7, 3)]
    out = spark.createDataFrame(rows, "count long, n long, v long").select("*", divergence.share(F.col("count"), F.col("n"), F.col("v")).alias("p")).collect()
    assert [r.p for r in out] == [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in rows]


def test_texts_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "_PIECE", 10)
    text = ("abc defgh é1ij " * 20 + "k" * 50 + " z").encode()
    parts = list(divergence.pieces(text))
    assert b"".join(parts) == text and len(parts) > 5
    assert [t for p in parts for t in divergence.TERM.findall(p)] == divergence.TERM.findall(text)
    assert pa.array([b"x"]).type == pa.binary()
