"""Source divergence audit: how far the sources of a language differ in their words, from joint count histograms.

1. ``term_counts`` counts terms in each task before the shuffle: occurrences by language, source and term, and the documents that hold the term. A language keeps
   the terms that enough of its documents hold.
2. ``joint_histograms`` tallies for each pair of a language's sources how many terms have the counts (a, b) in them. Pairs of counts above zero come from a join on the
   term; cells with a zero are implied: a source's own histogram of counts less what the join has taken, and (0, 0) is what remains of the vocabulary.
3. ``divergence`` evaluates the measure once for each cell and multiplies; ``leading_terms`` gives each source's terms that stand out against its language.

A share p of a term is 1 + floor(10^9 (count + 2) / (N + 2 V)); the measure of two shares is floor((p - q)^2 / (p + q)), all in whole numbers: products beyond 64 bits are decimals.

Defined results: null text, lang and source are empty ones; a group occurs if it has a row, even without terms; repeated rows count each; equal values are ranked by the bytes of the
item; with no kept term values are 0 and there is no leading term; an empty table gives no rows; texts are read whole, long ones in pieces cut between terms; other columns aren't read.
What the join makes for a term is bounded by the pairs of sources that hold it, whatever the number of documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumq.llm import shared, words

#: The bytes of terms (A-Z, a-z, all non-ASCII); shares are parts of SCALE, with PRIOR added to each count.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
BETWEEN = re.compile(rb"[^A-Za-z\x80-\xff]")
SCALE, PRIOR = 1_000_000_000, 2

_PIECE = 1 << 20


def pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about a megabyte, cut between terms."""
    start = 0
    while len(text) - start > _PIECE and (cut := BETWEEN.search(text, start + _PIECE)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def term_counts(docs: DataFrame, least_docs: int = 10, flush: int = 200_000) -> DataFrame:
    """lang, source, term, count of the terms that at least so many documents of the language hold. Each task sums up to about ``flush`` entries before it sends them."""

    def tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[tuple, Counter] = {}
        held: dict[tuple, Counter] = {}

        def out() -> pa.RecordBatch:
            rows = [(*group, term, n, held[group][term]) for group, own in count.items() for term, n in own.items()]
            count.clear()
            held.clear()
            columns = zip(*rows, strict=True) if rows else [()] * 5
            types = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
            lang, source, term, n, docs_ = (pa.array(list(c), t) for c, t in zip(columns, types, strict=True))
            return pa.RecordBatch.from_arrays([lang, source, term.cast(pa.string()), n, docs_], names=["lang", "source", "term", "count", "docs"])

        for batch in batches:
            for part in words.pieces([batch], "text"):
                for lang, source, text in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), part.column("text").cast(pa.binary()).to_pylist(), strict=True):
                    own, seen = count.setdefault((lang, source), Counter()), set()
                    for piece in pieces(text):
                        found = TERM.findall(piece.lower())  # of bytes: A-Z alone
                        own.update(found)
                        seen.update(found)
                    held.setdefault((lang, source), Counter()).update(seen)
            if sum(map(len, count.values())) > flush:
                yield out()
        yield out()

    rows = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    sent = rows.mapInArrow(tally, "lang string, source string, term string, count bigint, docs bigint").repartition("lang", "term")
    counts = sent.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))  # in the same partitioning, as is the window
    return counts.withColumn("docs", F.sum("docs").over(Window.partitionBy("lang", "term"))).filter(F.col("docs") >= least_docs).drop("docs")


def groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, n, terms, v, total of every occurring group: its occurrences of kept terms, how many kept terms it holds, and both for its language."""
    every = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count("*").alias("terms"))
    return every.join(own, ["lang", "source"], "left").join(languages(kept), "lang", "left").select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "terms", "v", "total")))


def languages(kept: DataFrame) -> DataFrame:
    """lang, v, total: kept terms of a language and their occurrences."""
    return kept.groupBy("lang", "term").agg(F.sum("count").alias("count")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("count").alias("total"))


def joint_histograms(kept: DataFrame, group: DataFrame) -> DataFrame:
    """lang, a, b, count_a, count_b, terms for sources a < b of a language: in how many kept terms they have these counts, zeros included."""
    one = kept.select("lang", "term", F.col("source").alias("a"), F.col("count").alias("count_a"))
    two = kept.select("lang", "term", F.col("source").alias("b"), F.col("count").alias("count_b"))
    both = one.join(two, ["lang", "term"]).filter("a < b").groupBy("lang", "a", "b", "count_a", "count_b").agg(F.count("*").alias("terms"))
    cell = lambda a, b, n: F.struct(F.lit(a).cast("long").alias("count_a") if a is not None else F.col("count_a"), F.lit(b).cast("long").alias("count_b") if b is not None else F.col("count_b"), n.alias("terms"))
    m = F.col("terms")
    met = both.select("lang", "a", "b", F.inline(F.array(cell(None, None, m), cell(None, 0, -m), cell(0, None, -m), cell(0, 0, m))))
    pairs = group.select("lang", F.col("source").alias("a"), F.col("terms").alias("terms_a"), "v").join(group.select("lang", F.col("source").alias("b"), F.col("terms").alias("terms_b")), "lang").filter("a < b")
    own = kept.groupBy("lang", "source", "count").agg(F.count("*").alias("terms"))
    zero = F.lit(0).cast("long")
    left = pairs.select("lang", "a", "b").join(own.withColumnRenamed("source", "a"), ["lang", "a"]).select("lang", "a", "b", F.col("count").alias("count_a"), zero.alias("count_b"), "terms")
    right = pairs.select("lang", "a", "b").join(own.withColumnRenamed("source", "b"), ["lang", "b"]).select("lang", "a", "b", zero.alias("count_a"), F.col("count").alias("count_b"), "terms")
    rest = pairs.select("lang", "a", "b", zero.alias("count_a"), zero.alias("count_b"), F.expr("v - terms_a - terms_b").alias("terms"))
    cells = met.unionByName(left).unionByName(right).unionByName(rest)
    return cells.groupBy("lang", "a", "b", "count_a", "count_b").agg(F.sum("terms").alias("terms")).filter("terms <> 0")


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(SCALE (count + PRIOR) / (n + PRIOR v)) as a long."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + PRIOR).cast("decimal(20,0)")
    below = (n + PRIOR * v).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, below)


def measure(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares stay below 2^30, so 64 bits hold the square."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def divergence(kept: DataFrame, group: DataFrame) -> DataFrame:
    """lang, a, b, value of sources a < b of a language: the measure summed over all kept terms."""
    cells = joint_histograms(kept, group)
    ends = [group.select("lang", F.col("source").alias(x), F.col("n").alias(f"n_{x}"), *(["v"] if x == "a" else [])) for x in ("a", "b")]
    pairs = ends[0].join(ends[1], "lang").filter("a < b")
    valued = cells.join(pairs, ["lang", "a", "b"]).withColumn("f", measure(share(F.col("count_a"), F.col("n_a"), F.col("v")), share(F.col("count_b"), F.col("n_b"), F.col("v"))))
    sums = valued.groupBy("lang", "a", "b").agg(F.sum(F.col("f") * F.col("terms")).alias("value"))
    return pairs.select("lang", "a", "b").join(sums, ["lang", "a", "b"], "left").withColumn("value", F.coalesce("value", F.lit(0).cast("long")))


def leading_terms(kept: DataFrame, group: DataFrame, top: int = 10) -> DataFrame:
    """lang, source, term, value, rank: terms of which a source holds a larger share than its language, by the measure of the two shares."""
    whole = kept.groupBy("lang", "term").agg(F.sum("count").alias("whole"))
    rows = kept.join(whole, ["lang", "term"]).join(group, ["lang", "source"]).drop("terms")
    p, q = share(F.col("count"), F.col("n"), F.col("v")), share(F.col("whole"), F.col("total"), F.col("v"))
    rows = rows.select("lang", "source", "term", p.alias("p"), q.alias("q")).filter("p > q").select("lang", "source", "term", measure(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    """Of each source of a language: its distance from every other source, and the ten terms by which it stands out most."""
    docs = shared.table(spark, sf_dir, "documents")
    kept = shared.written(term_counts(docs), "terms")
    group = shared.written(groups(docs, kept), "groups")
    both = divergence(kept, group).select("lang", "value", F.inline(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ("lang", "source", "part", "item", "value", "rank")
    pairs = both.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(order)).select(*columns)
    return pairs.unionByName(leading_terms(kept, group).withColumn("part", F.lit("term")).withColumnRenamed("term", "item").select(*columns))


ORACLE_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
held AS (SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
vocabulary AS (SELECT lang, term, count(*)::HUGEINT AS whole FROM held GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
counted AS (SELECT h.lang, h.source, h.term, count(*)::HUGEINT AS count FROM held h JOIN vocabulary USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(whole)::HUGEINT AS total FROM vocabulary GROUP BY lang),
sums AS (SELECT lang, source, sum(count)::HUGEINT AS n FROM counted GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, t.term, coalesce(c.count, 0) AS count, 1 + 1000000000::HUGEINT * (coalesce(c.count, 0) + 2) // (coalesce(s.n, 0) + 2 * l.v) AS p, 1 + 1000000000::HUGEINT * (t.whole + 2) // (l.total + 2 * l.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN vocabulary t USING (lang) LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
valued AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0)::BIGINT AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN valued v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM shares WHERE count > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
