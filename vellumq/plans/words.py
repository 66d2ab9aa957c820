"""Queries over words, sentences and lines, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellumq.functions import text as T
from vellumq.operators import tokens as K
from vellumq.operators.contained import half_held
from vellumq.operators.graph import settled
from vellumq.plans import sql as S
from vellumq.session import table

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query(f"WITH {S.TOK} SELECT lower(word) AS word, count(*) AS n FROM tok GROUP BY 1 ORDER BY n DESC, 1 LIMIT 100")
def word_freq_top(spark, sf_dir):
    """The 100 commonest words."""
    words = _docs(spark, sf_dir).select(F.explode(T.words(F.col("text"))).alias("w"))
    return words.groupBy(F.lower("w").alias("word")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(100)


@query(f"""WITH {S.TOK}, l AS (SELECT doc_id, list(word ORDER BY pos) AS w FROM tok GROUP BY doc_id)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, array_to_string(w[greatest(i - 6, 1):i + 6], ' ') AS context FROM l, unnest(range(1, len(w) + 1)) AS u(i) WHERE lower(w[i]) = 'from'""")
def kwic(spark, sf_dir):
    """Each 'from' with six words on either side."""
    return K.keyword_in_context(_docs(spark, sf_dir), "from")


@query(rf"""WITH {S.SENT} SELECT doc_id, CAST(sent_no AS INTEGER) AS sent_no, CAST(len(regexp_extract_all(s, '\S+')) AS BIGINT) AS words,
  CAST(list_max(list_transform(regexp_extract_all(s, '\S+'), lambda x: length(x))) AS INTEGER) AS longest FROM sent""")
def sentence_stats(spark, sf_dir):
    """Words of each sentence, and the longest word's length."""
    w = T.spaced_words(F.col("s"))
    return K.sentences(_docs(spark, sf_dir)).select("doc_id", "sent_no", F.size(w).cast("long").alias("words"), F.array_max(F.transform(w, F.length)).alias("longest"))


_DOUBLED = r"(?<![\p{L}\p{N}_])([\p{L}\p{N}_]+) \1(?![\p{L}\p{N}_])"


@query(r"""WITH t AS (SELECT doc_id, regexp_extract_all(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+') AS x FROM documents),
p AS (SELECT doc_id, i, x[i] AS w, i > 2 AND x[i - 1] = ' ' AND x[i - 2] = x[i] AS again FROM t, unnest(range(1, len(x) + 1)) AS u(i) WHERE regexp_matches(x[i], '^[\p{L}\p{N}_]')),
g AS (SELECT *, sum(CASE WHEN again THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM p),
r AS (SELECT doc_id, run, any_value(w) AS w, count(*) // 2 AS n FROM g GROUP BY ALL)
SELECT w AS word, CAST(sum(n) AS BIGINT) AS n, count(DISTINCT doc_id) AS docs FROM r WHERE n > 0 AND w NOT IN ('that', 'had', 'is', 'do', 'very') GROUP BY 1""")
def doubled_words(spark, sf_dir):
    """Words that stand twice with one space between, but for those that may."""
    found = _docs(spark, sf_dir).select("doc_id", F.explode(F.regexp_extract_all(T.collapsed(F.col("text")), F.lit(_DOUBLED), F.lit(1))).alias("word"))
    each = found.filter(~F.col("word").isin(*T.FINE_DOUBLED)).groupBy("word", "doc_id").agg(F.count("*").alias("n"))
    return each.groupBy("word").agg(F.sum("n").alias("n"), F.count("*").alias("docs"))


@query(f"""WITH {S.LINE}, g AS (SELECT *, line_no - row_number() OVER (PARTITION BY doc_id, s ORDER BY line_no) AS island FROM line)
SELECT doc_id, CAST(min(line_no) AS INTEGER) AS first_line, count(*) AS n, s AS line FROM g GROUP BY doc_id, s, island HAVING count(*) > 1""")
def repeated_line_runs(spark, sf_dir):
    """Runs of equal neighbouring lines: gaps and islands over the line numbers."""
    rows = K.lines(_docs(spark, sf_dir).filter("text is not null"))
    island = F.col("line_no") - F.row_number().over(Window.partitionBy("doc_id", "s").orderBy("line_no"))
    runs = rows.withColumn("island", island).groupBy("doc_id", "s", "island").agg(F.min("line_no").alias("first_line"), F.count("*").alias("n")).filter("n > 1")
    return runs.select("doc_id", "first_line", "n", F.col("s").alias("line"))


@query(r"""WITH t AS (SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '\S+'), lambda x: lower(x)) AS w FROM documents),
g AS (SELECT doc_id, array_to_string(w[i:i + 3], ' ') AS g, count(*) AS n FROM t, unnest(range(1, len(w) - 2)) AS u(i) WHERE len(w) > 40 GROUP BY ALL)
SELECT doc_id, max(n) AS most FROM g GROUP BY 1 HAVING max(n) >= 8""")
def looped_docs(spark, sf_dir):
    """Texts that a reader ran in circles on: a run of four words eight times or more."""
    return K.looped(_docs(spark, sf_dir))


def _variants(spark, sf_dir, key, kept="[a-zſ]"):
    # a key is empty if the word has none of the kept signs: asking that first, the key is made once
    words = _docs(spark, sf_dir).select(F.explode(T.words(F.col("text"))).alias("w")).groupBy(F.lower("w").alias("w")).agg(F.count("*").alias("n"))
    groups = words.filter(F.col("w").rlike(kept)).withColumn("key", key(F.col("w"))).groupBy("key").agg(F.count("*").alias("spellings"), F.sum("n").alias("n"), F.max_by("w", F.struct("n", "w")).alias("commonest"))
    return groups.filter("spellings >= 2")


def _variants_sql(key: str) -> str:
    return f"""WITH {S.TOK}, w AS (SELECT lower(word) AS w, count(*) AS n FROM tok GROUP BY 1), k AS (SELECT *, {key} AS key FROM w)
SELECT key, count(*) AS spellings, CAST(sum(n) AS BIGINT) AS n, arg_max(w, (n, w)) AS commonest FROM k WHERE key <> '' GROUP BY key HAVING count(*) >= 2"""


@query(_variants_sql(S.loose("w")))
def variant_spellings(spark, sf_dir):
    """Spellings that two printings would share, by the loose key. Keys are made once for each distinct word."""
    return _variants(spark, sf_dir, T.loose_key)


@query(_variants_sql(S.ocr("w")))
def ocr_variants(spark, sf_dir):
    return _variants(spark, sf_dir, T.ocr_key)


@query(_variants_sql(S.crop("w")))
def crop_variants(spark, sf_dir):
    return _variants(spark, sf_dir, T.crop_key, "[a-z0-9ſ]")


@query("""SELECT sha256(coalesce(text, '')) AS sha256, count(*) AS copies, min(doc_id) AS first_doc, count(DISTINCT source) AS sources FROM documents GROUP BY 1 HAVING count(*) >= 2""")
def dup_groups(spark, sf_dir):
    """Documents with equal texts."""
    rows = _docs(spark, sf_dir).select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"), "doc_id", "source")
    each = rows.groupBy("sha256", "source").agg(F.count("*").alias("n"), F.min("doc_id").alias("d"))
    return each.groupBy("sha256").agg(F.sum("n").alias("copies"), F.min("d").alias("first_doc"), F.count("source").alias("sources")).filter("copies >= 2")


@query(f"""WITH {S.TOK}, a AS (SELECT lower(word) AS word, count(*) AS n FROM tok GROUP BY 1), b AS (SELECT lower(unnest(regexp_extract_all(text, '{S.WORD}'))) AS word, count(*) AS n FROM benchmark GROUP BY 1)
SELECT coalesce(a.word, b.word) AS word, greatest(coalesce(a.n, 0) - coalesce(b.n, 0), 0) AS gone, greatest(coalesce(b.n, 0) - coalesce(a.n, 0), 0) AS came FROM a FULL JOIN b ON a.word = b.word WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def multiset_diff(spark, sf_dir):
    """Words that the documents have more often than the benchmark, or less: one aggregate, no join."""
    docs = _docs(spark, sf_dir).select(F.lit(1).alias("side"), F.explode(T.words(F.col("text"))).alias("w"))
    items = table(spark, sf_dir, "benchmark").select(F.lit(2).alias("side"), F.explode(T.words(F.col("text"))).alias("w"))
    n = docs.unionByName(items).groupBy(F.lower("w").alias("word")).agg(F.count(F.when(F.col("side") == 1, 1)).alias("a"), F.count(F.when(F.col("side") == 2, 1)).alias("b"))
    return n.filter("a <> b").select("word", F.greatest(F.col("a") - F.col("b"), F.lit(0)).alias("gone"), F.greatest(F.col("b") - F.col("a"), F.lit(0)).alias("came"))


@query(f"""WITH {S.TOK}, dt AS (SELECT DISTINCT doc_id, lower(word) AS w FROM tok), it AS (SELECT item_id, lower(unnest(regexp_extract_all(text, '{S.WORD}'))) AS w FROM benchmark),
iw AS (SELECT item_id, w, count(*) AS n FROM it GROUP BY ALL), tot AS (SELECT item_id, sum(n) AS total FROM iw GROUP BY 1 HAVING sum(n) >= 4)
SELECT item_id, doc_id, round(sum(n) / any_value(total), 6) AS share, sum(n) / any_value(total) >= 0.8 AS strong FROM iw JOIN dt USING (w) JOIN tot USING (item_id) GROUP BY ALL HAVING sum(n) / any_value(total) >= 0.5""")
def containment(spark, sf_dir):
    """Benchmark items whose words, with repeats, are mostly in one document.

    Items are looked for by their rarest words, and those found counted in full, within the row of the document (``contained``).
    """
    items = table(spark, sf_dir, "benchmark").select("item_id", F.explode(T.words(F.col("text"))).alias("w")).groupBy("item_id", F.lower("w").alias("w")).agg(F.count("*").alias("n"))
    total = items.groupBy("item_id").agg(F.sum("n").alias("total")).filter("total >= 4")
    items = settled(items.join(total, "item_id"))
    got = half_held(_docs(spark, sf_dir), items).join(items.select("item_id", "total").distinct().hint("merge"), "item_id")
    share = F.col("got") / F.col("total")
    return got.select("item_id", "doc_id", F.round(share, 6).alias("share"), (share >= 0.8).alias("strong"))


@query(f"""WITH {S.TOK} SELECT DISTINCT a.doc_id, CAST(a.pos AS INTEGER) AS pos FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND lower(a.word) = 'with' AND lower(b.word) = 'from' AND abs(a.pos - b.pos) <= 3""")
def proximity_pairs(spark, sf_dir):
    """Each 'with' that has a 'from' within three words."""
    return K.proximity(_docs(spark, sf_dir), "with", "from")


def _count(sign: str):
    return F.sum(F.length("text") - F.length(F.replace(F.col("text"), F.lit(sign), F.lit(""))))


@query("""WITH c AS (SELECT lang, sum(length(text) - length(translate(text, '‘’', ''))) AS s, sum(length(text) - length(translate(text, '“”', ''))) AS d, sum(length(text) - length(replace(text, '"', ''))) AS q FROM documents GROUP BY 1)
SELECT lang, s > d AS single, q < d / 10 AS straight_q, CAST(q AS BIGINT) AS straight FROM c""")
def corpus_style(spark, sf_dir):
    """Which quotes a language's texts use."""
    c = _docs(spark, sf_dir).groupBy("lang").agg((_count("‘") + _count("’")).alias("s"), (_count("“") + _count("”")).alias("d"), _count('"').alias("q"))
    return c.select("lang", (F.col("s") > F.col("d")).alias("single"), (F.col("q") < F.col("d") / 10).alias("straight_q"), F.col("q").alias("straight"))


@query("""SELECT lang, median(n_chars) AS median, list_sort(list(n_chars))[CAST(floor(count(*) * 0.9) AS BIGINT) + 1] AS p90,
  (SELECT b FROM (SELECT n_chars // 500 AS b, sum(n_chars) AS s FROM documents x WHERE x.lang = d.lang GROUP BY 1) ORDER BY s DESC, b DESC LIMIT 1) AS mode_bucket FROM documents d GROUP BY lang""")
def stats_geometry(spark, sf_dir):
    """Median, the value at index int(0.9 n), and the bucket of lengths that holds most text, by language. The index comes from a distribution of distinct values, not from a list of all."""
    n = _docs(spark, sf_dir).groupBy("lang", "n_chars").agg(F.count("*").alias("n"))
    order = Window.partitionBy("lang").orderBy("n_chars")
    ranked = n.withColumn("upto", F.sum("n").over(order)).withColumn("total", F.sum("n").over(Window.partitionBy("lang")))
    p90 = ranked.filter(F.col("upto") > F.floor(F.col("total") * 0.9)).groupBy("lang").agg(F.min("n_chars").alias("p90"))
    low = ranked.filter(F.col("upto") > F.floor((F.col("total") - 1) / 2)).groupBy("lang").agg(F.min("n_chars").alias("low"))
    high = ranked.filter(F.col("upto") > F.floor(F.col("total") / 2)).groupBy("lang").agg(F.min("n_chars").alias("high"))
    mode = n.groupBy("lang", F.expr("n_chars div 500").alias("b")).agg(F.sum(F.col("n") * F.col("n_chars")).alias("s")).groupBy("lang").agg(F.max_by("b", F.struct("s", "b")).alias("mode_bucket"))
    return p90.join(low, "lang").join(high, "lang").join(mode, "lang").select("lang", ((F.col("low") + F.col("high")) / 2).alias("median"), "p90", "mode_bucket")


@query(f"""WITH {S.TOK}, t AS (SELECT DISTINCT doc_id, lower(word) AS w FROM tok), d AS (SELECT w, count(*) AS docs FROM t GROUP BY 1), b AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '{S.WORD}'))) AS w FROM benchmark)
SELECT w AS word, docs FROM d WHERE length(w) > 2 AND docs < 3 AND w NOT IN (SELECT w FROM b)""")
def unknown_words(spark, sf_dir):
    """Words of fewer than three documents that no benchmark item has."""
    words = _docs(spark, sf_dir).select(F.explode(F.array_distinct(F.transform(T.words(F.col("text")), F.lower))).alias("word")).filter(F.length("word") > 2)
    known = table(spark, sf_dir, "benchmark").select(F.explode(T.words(F.col("text"))).alias("w")).select(F.lower("w").alias("word")).distinct()
    return words.groupBy("word").agg(F.count("*").alias("docs")).filter("docs < 3").join(known, "word", "left_anti")


@query(rf"""WITH {S.TOK}, en AS (SELECT lower(word) AS w FROM tok WHERE lang = 'en' GROUP BY 1 HAVING count(*) >= 3), {S.SENT},
sw AS (SELECT doc_id, sent_no, lower(unnest(regexp_extract_all(s, '{S.WORD}'))) AS w FROM sent WHERE lang = 'en'),
c AS (SELECT doc_id, sent_no, count(*) AS words, count(en.w) AS known FROM sw LEFT JOIN en USING (w) GROUP BY ALL)
SELECT doc_id, CAST(sent_no AS INTEGER) AS sent_no, words, known FROM c WHERE words >= 4 AND known * 2 < words""")
def foreign_runs(spark, sf_dir):
    """Sentences of English documents with four words or more of which fewer than half are common English words."""
    docs = _docs(spark, sf_dir).filter("lang = 'en'")
    rows = settled(K.sentences(docs).select(F.monotonically_increasing_id().alias("id"), "doc_id", "sent_no", F.transform(T.words(F.col("s")), F.lower).alias("w")).filter("size(w) > 0"))
    # a word of fewer than three places is at its first and its last, so rare words are counted without a row for each place of a common one
    places = rows.select("id", F.explode("w").alias("w")).groupBy("w").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last")).filter("n < 3")
    rare = places.select(F.explode(F.when(F.col("n") == 1, F.array("first")).otherwise(F.array("first", "last"))).alias("id")).groupBy("id").agg(F.count("*").alias("rare"))
    each = rows.select("id", "doc_id", "sent_no", F.size("w").alias("words")).join(rare.hint("merge"), "id", "left")
    c = each.groupBy("doc_id", "sent_no").agg(F.sum("words").alias("words"), F.sum(F.col("words") - F.coalesce("rare", F.lit(0))).alias("known"))
    return c.filter("words >= 4 and known * 2 < words")


@query(f"""WITH {S.TOK}, r AS (SELECT lower(word) AS w, count(*) AS n FROM tok WHERE length(word) >= 2 AND regexp_matches(word, '^[ivxlcIVXLC]+$') GROUP BY 1),
v AS (SELECT w, n, list_transform(range(1, length(w) + 1), lambda i: CASE w[i] WHEN 'i' THEN 1 WHEN 'v' THEN 5 WHEN 'x' THEN 10 WHEN 'l' THEN 50 ELSE 100 END) AS d FROM r)
SELECT w AS word, n, CAST(list_sum(list_transform(range(1, len(d) + 1), lambda i: CASE WHEN i < len(d) AND d[i + 1] > d[i] THEN -d[i] ELSE d[i] END)) AS INTEGER) AS value FROM v""")
def roman_values(spark, sf_dir):
    words = _docs(spark, sf_dir).select(F.explode(T.words(F.col("text"))).alias("w")).filter(F.col("w").rlike("^[ivxlcIVXLC]{2,}$"))
    return words.groupBy(F.lower("w").alias("word")).agg(F.count("*").alias("n")).withColumn("value", T.roman_value(F.col("word")))


_BOOKS_SQL = ", ".join(f"'{b}'" for b in T.BOOKS)


@query(f"""WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{S.WORD}') AS w FROM documents)
SELECT doc_id, CAST(len(w) AS BIGINT) AS words, CAST(len(list_filter(range(1, len(w) + 1), lambda i: NOT regexp_matches(w[i], '^[0-9]+$') AND NOT (list_contains([{_BOOKS_SQL}], w[i]) AND i < len(w) AND regexp_matches(coalesce(w[i + 1], ''), '^[0-9]+$')))) AS BIGINT) AS kept FROM t""")
def drop_refs(spark, sf_dir):
    """Words of a text, and those left when scripture references go."""
    w = T.words(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.size(w).cast("long").alias("words"), F.size(K.without_references(w)).cast("long").alias("kept"))


@query(f"""WITH {S.TOK}, w AS (SELECT lower(word) AS w, count(*) AS n FROM tok WHERE regexp_matches(lower(word), '^[a-z]+$') GROUP BY 1), r AS (SELECT w, n, {S.letterforms('w')} AS modern FROM w)
SELECT w AS word, modern, n FROM r WHERE modern <> w""")
def letterform_rules(spark, sf_dir):
    """Distinct words that the letterform rules change."""
    words = _docs(spark, sf_dir).select(F.explode(T.words(F.col("text"))).alias("w")).groupBy(F.lower("w").alias("word")).agg(F.count("*").alias("n")).filter(F.col("word").rlike("^[a-z]+$"))
    return words.withColumn("modern", T.letterforms(F.col("word"))).filter("modern <> word").select("word", "modern", "n")


@query(f"""WITH {S.LINE} SELECT doc_id, count(*) AS marks, CAST(sum(len(regexp_extract_all(s, '{S.WORD}'))) AS BIGINT) AS words, CAST(count(*) + sum(len(regexp_extract_all(s, '{S.WORD}'))) - 1 AS INTEGER) AS last_pos FROM line GROUP BY 1""")
def reading_stream(spark, sf_dir):
    """Marks and words of each document's reading stream, and its last position."""
    rows = K.reading_stream(_docs(spark, sf_dir))
    return rows.groupBy("doc_id").agg(F.count(F.when(F.col("kind") == "m", 1)).alias("marks"), F.count(F.when(F.col("kind") == "w", 1)).alias("words"), F.max("pos").alias("last_pos"))
