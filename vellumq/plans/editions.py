"""Queries over layers, decisions and modern spellings, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumq.functions import text as T
from vellumq.operators import layers as L
from vellumq.operators import normalise as N
from vellumq.plans import sql as S
from vellumq.plans.words import _docs

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _readings(spark, sf_dir):
    """lang, source, word, start, n, modern: distinct words with their machine reading; the rules run once for each."""
    first = F.transform(T.sentences(F.col("text")), lambda s: F.transform(T.words(s), lambda w, i: F.struct(w.alias("word"), (i == 0).alias("start"))))
    rows = _docs(spark, sf_dir).select("lang", "source", F.explode(F.flatten(first)).alias("x")).groupBy("lang", "source", "x.word", "x.start").agg(F.count("*").alias("n"))
    lower = T.small_letters(F.col("word"))
    rows = rows.withColumn("modern", F.when(lower.rlike("^[a-z]+$"), T.letterforms(lower)).otherwise(lower))
    modern = F.col("modern")
    small = F.when(F.col("start"), F.concat(T.capitals(F.substring(modern, 1, 1)), F.substring(modern, F.lit(2), F.length(modern)))).otherwise(modern)
    return rows.withColumn("modern", F.when((T.capitals(F.col("word")) == F.col("word")) & (F.length("word") > 1), T.capitals(modern)).otherwise(small))


_READ = f"""{S.SENT}, tw AS (SELECT lang, source, w[i] AS word, i = 1 AS start FROM (SELECT lang, source, regexp_extract_all(s, '{S.WORD}') AS w FROM sent), unnest(range(1, len(w) + 1)) AS u(i)),
rd AS (SELECT lang, source, word, start, count(*) AS n, CASE WHEN regexp_matches(lower(word), '^[a-z]+$') THEN {S.letterforms('lower(word)')} ELSE lower(word) END AS m FROM tw GROUP BY ALL),
r AS (SELECT *, CASE WHEN upper(word) = word AND length(word) > 1 THEN upper(m) WHEN start THEN upper(m[1]) || m[2:] ELSE m END AS modern FROM rd)"""


@query(f"""WITH {_READ}
SELECT lang, source, CAST(sum(n) AS BIGINT) AS words, CAST(sum(CASE WHEN word <> modern THEN n ELSE 0 END) AS BIGINT) AS form, CAST(sum(CASE WHEN lower(word) <> lower(modern) THEN n ELSE 0 END) AS BIGINT) AS spelling,
  CAST(sum(CASE WHEN word <> modern AND lower(word) = lower(modern) THEN n ELSE 0 END) AS BIGINT) AS case_only, round(100 * sum(CASE WHEN word = modern THEN n ELSE 0 END) / greatest(sum(n), 1), 1) AS unchanged_pct
FROM r GROUP BY lang, source""")
def token_coverage(spark, sf_dir):
    """Words of each language and source that the machine's reading leaves as they are, or changes in form: letterform rules, and capitals at sentence starts only."""
    r = _readings(spark, sf_dir)
    n = F.col("n")
    return r.groupBy("lang", "source").agg(
        F.sum(n).alias("words"), F.sum(F.when(F.col("word") != F.col("modern"), n).otherwise(0)).alias("form"),
        F.sum(F.when(T.small_letters(F.col("word")) != T.small_letters(F.col("modern")), n).otherwise(0)).alias("spelling"),
        F.sum(F.when((F.col("word") != F.col("modern")) & (T.small_letters(F.col("word")) == T.small_letters(F.col("modern"))), n).otherwise(0)).alias("case_only"),
        F.round(100 * F.sum(F.when(F.col("word") == F.col("modern"), n).otherwise(0)) / F.greatest(F.sum(n), F.lit(1)), 1).alias("unchanged_pct"),
    )


@query(f"""WITH {_READ} SELECT CASE WHEN lower(word) = lower(modern) THEN 'case' ELSE 'spelling' END AS type, word AS orig, modern AS auto, CAST(sum(n) AS BIGINT) AS n FROM r WHERE word <> modern GROUP BY ALL HAVING sum(n) >= 10""")
def decision_report(spark, sf_dir):
    """The machine's decisions that were made ten times or more: kind, old, new, count."""
    r = _readings(spark, sf_dir).filter("word <> modern")
    kind = F.when(T.small_letters(F.col("word")) == T.small_letters(F.col("modern")), "case").otherwise("spelling")
    return r.groupBy(kind.alias("type"), F.col("word").alias("orig"), F.col("modern").alias("auto")).agg(F.sum("n").alias("n")).filter("n >= 10")


def _vocabulary(spark, sf_dir):
    return _docs(spark, sf_dir).select(F.explode(T.words(F.col("text"))).alias("w")).select(F.lower("w").alias("word")).filter(F.col("word").rlike("^[a-z]+$"))


_SILENT = """list_filter([q, CASE WHEN q LIKE '%e' AND length(q) > 3 THEN left(q, -1) END, CASE WHEN q LIKE '%e' AND length(q) > 4 AND q[-2] = q[-3] THEN left(q, -2) END,
 CASE WHEN q LIKE '%es' AND length(q) > 4 THEN left(q, -2) || 's' END, CASE WHEN q LIKE '%es' AND length(q) > 5 AND q[-3] = q[-4] THEN left(q, -3) || 's' END,
 CASE WHEN right(q, 2) IN ('ll', 'ff', 'mm', 'nn', 'pp', 'tt', 'rr', 'ss') AND length(q) > 4 THEN left(q, -1) END, CASE WHEN q LIKE '%nes' AND length(q) > 4 THEN q || 's' END,
 CASE WHEN q LIKE '%cke' AND length(q) > 4 THEN left(q, -2) || 'c' END, CASE WHEN q LIKE '%eness' AND length(q) > 6 THEN left(q, -5) || 'ness' END, CASE WHEN q LIKE '%sness' AND length(q) > 6 THEN left(q, -5) || 'ssness' END], lambda x: x IS NOT NULL)"""
_VOCAB = f"""{S.TOK}, vocab AS (SELECT lower(word) AS word, count(*) AS freq FROM tok WHERE regexp_matches(lower(word), '^[a-z]+$') GROUP BY 1), known AS (SELECT * FROM vocab WHERE freq >= 3)"""


@query(f"""WITH {_VOCAB}, p AS (SELECT word, {S.letterforms('word')} AS q FROM vocab WHERE word NOT IN ('hath', 'doth', 'hast', 'dost', 'thou', 'thee', 'thy', 'thine', 'ye', 'art', 'shalt', 'wilt')),
f AS (SELECT word, q, {_SILENT} AS forms FROM p), x AS (SELECT word, q, forms[i] AS form, i FROM f, unnest(range(1, len(forms) + 1)) AS u(i)),
h AS (SELECT x.word, arg_min(form, i) AS form FROM x JOIN known ON form = known.word GROUP BY 1), m AS (SELECT word, coalesce(form, q) AS modern FROM p LEFT JOIN h USING (word))
SELECT word, modern, CASE WHEN modern <> word THEN 'rules' ELSE 'none' END AS rule FROM m UNION ALL SELECT word, word, 'exception' FROM vocab WHERE word IN ('hath', 'doth', 'hast', 'dost', 'thou', 'thee', 'thy', 'thine', 'ye', 'art', 'shalt', 'wilt')""")
def dictionary_reading(spark, sf_dir):
    """Modern spelling of each distinct word: tables win over rules, rules need the corpus's own dictionary (words of three places or more)."""
    words = _vocabulary(spark, sf_dir)
    return N.modernised(words.distinct(), N.dictionary(words))


@query()
def oracle_spelling(spark, sf_dir):
    """For words outside the dictionary, the known word with the fewest u/v and i/j swapped."""
    words = _vocabulary(spark, sf_dir)
    return N.letterform_search(words.distinct(), N.dictionary(words))


@query()
def verb_roots(spark, sf_dir):
    """Verbs in -eth and -est whose root has a modern spelling."""
    words = _vocabulary(spark, sf_dir)
    return N.verb_roots(words.distinct(), N.dictionary(words))


def _decided(orig, auto):
    """A word's decisions: the machine's, and the editor's who takes back those of words in capitals."""
    reg = lambda text, resp: F.struct(text.alias("text"), F.lit(resp).alias("resp"), F.lit("spelling").alias("type"))
    machine = F.when(auto != orig, reg(auto, L.MACHINE))
    editor = F.when((auto != orig) & (F.upper(orig) == orig), reg(orig, L.EDITOR))
    return F.array_compact(F.array(machine, editor))


def _choices(spark, sf_dir):
    """Choices of the documents: the machine's letterforms, and an editor who takes back those of words in capitals."""
    rows = _docs(spark, sf_dir).select("doc_id", "lang", F.posexplode(T.words(F.col("text"))).alias("pos", "orig"))
    lower = F.lower("orig")
    auto = F.when(lower.rlike("^[a-z]+$"), T.case_pattern(F.col("orig"), T.letterforms(lower))).otherwise(F.col("orig"))
    return rows.withColumn("regs", _decided(F.col("orig"), auto))


def _row_choices(words):
    """The same choices (orig, regs) of an array of words, step by step within its row; each step is worked out once for a word."""
    step = lambda rows, name, make: F.transform(rows, lambda r: F.struct(r["orig"].alias("orig"), make(r).alias(name)))
    rows = F.transform(words, lambda w: F.struct(w.alias("orig"), F.lower(w).alias("lower")))
    rows = step(rows, "modern", lambda r: F.when(r["lower"].rlike("^[a-z]+$"), T.letterforms(r["lower"])))
    rows = step(rows, "auto", lambda r: F.when(r["modern"].isNotNull(), T.case_pattern(r["orig"], r["modern"])).otherwise(r["orig"]))
    return step(rows, "regs", lambda r: _decided(r["orig"], r["auto"]))


_CHOICE = f"""{S.TOK}, c AS (SELECT doc_id, lang, pos, word AS orig, CASE WHEN regexp_matches(lower(word), '^[a-z]+$') THEN (SELECT CASE WHEN upper(word) = word AND length(word) > 1 THEN upper(z) WHEN upper(word[1]) = word[1] THEN upper(z[1]) || z[2:] ELSE z END FROM (SELECT {S.letterforms('lower(word)')} AS z)) ELSE word END AS auto FROM tok)"""


@query(f"""WITH {_CHOICE} SELECT doc_id, sha256(string_agg(CASE WHEN upper(orig) = orig THEN orig ELSE auto END, ' ' ORDER BY pos)) AS reg_sha256, sha256(string_agg(orig, ' ' ORDER BY pos)) AS orig_sha256 FROM c GROUP BY doc_id""")
def layer_projection(spark, sf_dir):
    """Digests of the printed and of the edited layer of each document, from one table of choices."""
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    if docs.groupBy("doc_id").count().filter("count > 1").isEmpty():
        rows = docs.select("doc_id", T.words(F.col("text")).alias("w"))
    else:  # texts of one doc_id are one document, whose words stand by their places
        placed = F.transform("texts", lambda t: F.transform(T.words(t), lambda w, i: F.struct(i.alias("pos"), w.alias("orig"))))
        rows = docs.groupBy("doc_id").agg(F.collect_list("text").alias("texts")).select("doc_id", F.array_sort(F.flatten(placed))["orig"].alias("w"))
    both = rows.filter("size(w) > 0").select("doc_id", "w", F.transform(_row_choices(F.col("w")), lambda r: L.reading(r["regs"], r["orig"])).alias("reg"))
    return both.select("doc_id", F.sha2(F.array_join("reg", " "), 256).alias("reg_sha256"), F.sha2(F.array_join("w", " "), 256).alias("orig_sha256"))


@query(f"""WITH {_CHOICE} SELECT orig, auto, CASE WHEN upper(orig) = orig THEN orig END AS editor, count(*) AS n FROM c WHERE auto <> orig GROUP BY ALL""")
def decision_triples(spark, sf_dir):
    """Distinct decisions: printed, the machine's, the editor's, count."""
    return L.decision_triples(_choices(spark, sf_dir).filter(F.size("regs") > 0))


@query(f"""WITH {_CHOICE} SELECT lang, CAST(count(*) AS BIGINT) AS words, CAST(count(*) FILTER (auto <> orig AND upper(orig) <> orig) AS BIGINT) AS form, CAST(0 AS BIGINT) AS grammar, CAST(0 AS BIGINT) AS wording, CAST(0 AS BIGINT) AS added, CAST(0 AS BIGINT) AS removed,
  round(100 * count(*) FILTER (NOT (auto <> orig AND upper(orig) <> orig)) / greatest(count(*), 1), 1) AS unchanged_pct FROM c GROUP BY lang""")
def coverage_by_language(spark, sf_dir):
    """Coverage arithmetic over the table of choices."""
    return L.coverage(_choices(spark, sf_dir), "lang")
