"""Queries that score, choose, sample, plant and count, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumq.functions import text as T
from vellumq.operators import select as C
from vellumq.operators import tokens as K
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


_SMALL = ", ".join(f"'{w}'" for w in T.SMALL)
_SCORES = rf"""{S.SENT}, sw AS (SELECT doc_id, sent_no, list_transform(regexp_extract_all(s, '\S+'), lambda x: lower(x)) AS w FROM sent),
wd AS (SELECT doc_id, sent_no, i - 1 AS place, CASE WHEN i > 1 THEN w[i - 1] END AS before, w[i] AS word FROM sw, unnest(range(1, len(w) + 1)) AS u(i)),
bi AS (SELECT before, word, count(*) AS n FROM wd WHERE before IS NOT NULL GROUP BY ALL), fi AS (SELECT before, sum(n) AS total FROM bi GROUP BY 1),
sc AS (SELECT before, word, CASE WHEN lp <= -15 THEN 15.0 ELSE -lp END AS score FROM (SELECT before, word, greatest(-15.0, ln(n / total)) AS lp FROM bi JOIN fi USING (before) WHERE regexp_replace(word, '[^a-z]', '', 'g') IN ({_SMALL}))),
ws AS (SELECT doc_id, sent_no, place, wd.word, round(coalesce(score, 0.0), 6) + 0.0 AS score FROM wd LEFT JOIN sc USING (before, word)),
ss AS (SELECT doc_id, sent_no, count(*) AS words, max(score) AS score, min(place) FILTER (score = m) AS place, list(score ORDER BY score DESC) AS strength FROM (SELECT *, max(score) OVER (PARTITION BY doc_id, sent_no) AS m FROM ws) GROUP BY ALL)"""


def _scored(spark, sf_dir):
    return C.scored_sentences(_docs(spark, sf_dir))


@query(f"WITH {_SCORES} SELECT doc_id, CAST(sent_no AS INTEGER) AS sent_no, words, score, CAST(CASE WHEN score > 0 THEN place ELSE -1 END AS INTEGER) AS strongest FROM ss")
def sentence_strongest(spark, sf_dir):
    """Each sentence's highest word score and its first place."""
    return _scored(spark, sf_dir).select("doc_id", "sent_no", "words", "score", F.coalesce("strongest", F.lit(-1)).alias("strongest"))


@query(f"""WITH {_SCORES}, r AS (SELECT doc_id, sent_no, words, score, sum(words) OVER (ORDER BY list_transform(strength, lambda x: -x), doc_id, sent_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS used, sum(words) OVER () AS total FROM ss)
SELECT doc_id, CAST(sent_no AS INTEGER) AS sent_no, words FROM r WHERE coalesce(used, 0) < 0.15 * total""")
def budget_top(spark, sf_dir):
    """The strongest sentences up to 15 % of all words."""
    return C.strongest_sentences(_docs(spark, sf_dir)).select("doc_id", "sent_no", "words")


@query(rf"""WITH {S.SENT}, n AS (SELECT doc_id, sent_no, CAST(len(regexp_extract_all(s, '\S+')) AS BIGINT) AS words FROM sent),
r AS (SELECT *, sum(words) OVER (ORDER BY sha256('7:' || doc_id || ':' || sent_no), doc_id, sent_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS used, sum(words) OVER () AS total FROM n)
SELECT doc_id, CAST(sent_no AS INTEGER) AS sent_no, words FROM r WHERE coalesce(used, 0) < 0.05 * total""")
def hash_sample(spark, sf_dir):
    """A reproducible sample of sentences up to 5 % of all words."""
    rows = K.sentences(_docs(spark, sf_dir)).select("doc_id", "sent_no", F.size(T.spaced_words(F.col("s"))).cast("long").alias("words"))
    return C.hash_sample(rows, 7, 0.05, "words", "doc_id", "sent_no")


_PLANT = r"""w0 AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '\S+') AS w FROM documents), w1 AS (SELECT doc_id, w, least(least(40, len(w) // 2) + ('0x' || left(sha256('1:' || doc_id), 8))::BIGINT % greatest(len(w) - 80, 1), len(w) - 1) AS place FROM w0 WHERE len(w) >= 40)"""


@query(f"""WITH {_PLANT} SELECT doc_id, CAST(place AS INTEGER) AS "at", w[place + 1] AS word, sha256(array_to_string(list_concat(w[1:place + 1], w[place + 1:]), ' ')) AS sha256 FROM w1""")
def planted_slips(spark, sf_dir):
    """A doubled word planted in each text, and the text's digest."""
    return C.plant_doubles(_docs(spark, sf_dir)).select("doc_id", "at", "word", F.sha2("text", 256).alias("sha256"))


_FINE = ", ".join(f"'{w}'" for w in T.FINE_DOUBLED)


@query(rf"""WITH {_PLANT}, v1 AS (SELECT doc_id, place, list_concat(w[1:place + 1], w[place + 1:]) AS v FROM w1),
fl AS (SELECT doc_id, i - 1 AS a FROM v1, unnest(range(1, len(v))) AS u(i) WHERE v[i] = v[i + 1] AND regexp_matches(v[i], '^[\p{{L}}\p{{N}}_]+$') AND v[i] NOT IN ({_FINE})),
met AS (SELECT doc_id, a FROM fl JOIN v1 USING (doc_id) WHERE a - 3 <= place + 1 AND place <= a + 4)
SELECT (SELECT count(*) FROM v1) AS planted, (SELECT count(DISTINCT doc_id) FROM met) AS caught, (SELECT count(*) FROM fl) AS flags, (SELECT count(*) FROM fl) - (SELECT count(*) FROM met) AS false_alarms""")
def plant_score(spark, sf_dir):
    """How many planted doubles the doubled-words rule flags, and how many flags meet none."""
    from vellumq.operators.graph import settled

    planted = settled(C.plant_doubles(_docs(spark, sf_dir)))
    targets = planted.select(F.col("doc_id").alias("file"), F.col("at").alias("w1"), (F.col("at") + 1).alias("w2"))
    flags = planted.select(F.col("doc_id").alias("file"), F.explode(K.doubled_places(T.spaced_words(F.col("text")))).alias("a"))
    return C.caught(targets, flags.select("file", "a", (F.col("a") + 1).alias("b")))


@query(r"""WITH RECURSIVE l AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: len(regexp_extract_all(x, '\S+'))) AS n FROM documents WHERE text IS NOT NULL),
f AS (SELECT doc_id, n, 1 AS i, 0 AS chunk, 1 AS first, n[1] AS used FROM l UNION ALL
  SELECT doc_id, n, i + 1, CASE WHEN used + n[i + 1] > 100 THEN chunk + 1 ELSE chunk END, CASE WHEN used + n[i + 1] > 100 THEN i + 1 ELSE first END, CASE WHEN used + n[i + 1] > 100 THEN n[i + 1] ELSE used + n[i + 1] END FROM f WHERE i < len(n))
SELECT doc_id, CAST(chunk AS INTEGER) AS chunk, CAST(min(first) - 1 AS INTEGER) AS first_line, CAST(count(*) AS INTEGER) AS lines, max(used) AS words FROM f GROUP BY doc_id, chunk""")
def chunks_greedy(spark, sf_dir):
    """Lines put together up to 100 words."""
    return C.chunks(_docs(spark, sf_dir))
