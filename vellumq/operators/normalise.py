"""Modern spellings of early words: tables first, rules next, a search over letterforms last.

All work is on distinct words: a corpus has few of them, its tokens are joined back by the word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumq.functions import text as T

#: Letters that were one letter in print, and the longest search.
SWAPS = {"u": "v", "v": "u", "i": "j", "j": "i"}
MOST_PLACES = 7


@dataclass(frozen=True)
class Tables:
    """Decisions about single words, as data. Earlier fields win."""

    exceptions: tuple[str, ...] = ("hath", "doth", "hast", "dost", "thou", "thee", "thy", "thine", "ye", "art", "shalt", "wilt")
    names: dict[str, str] = field(default_factory=dict)
    manual: dict[str, str] = field(default_factory=dict)
    untouched: tuple[str, ...] = ()


def dictionary(words: DataFrame, least: int = 3) -> DataFrame:
    """word, freq of words that stand often enough to be trusted."""
    return words.groupBy("word").agg(F.count("*").alias("freq")).filter(F.col("freq") >= least)


def first_known(words: DataFrame, forms: Column, known: DataFrame) -> DataFrame:
    """word, form: the first of a word's forms that the dictionary has."""
    rows = words.select("word", F.posexplode(forms).alias("at", "form"))
    return rows.join(known.select(F.col("word").alias("form")), "form", "left_semi").groupBy("word").agg(F.min_by("form", "at").alias("form"))


def modernised(words: DataFrame, known: DataFrame, tables: Tables = Tables()) -> DataFrame:
    """word, modern, rule for distinct lower-case words: exception, name, manual, untouched, rules, or none."""
    def mapping(x: dict[str, str]) -> Column:
        return F.create_map(*[F.lit(v) for kv in x.items() for v in kv]) if x else F.create_map().cast("map<string,string>")

    table = F.when(F.col("word").isin(*tables.exceptions) if tables.exceptions else F.lit(False), F.struct(F.col("word").alias("m"), F.lit("exception").alias("rule")))
    for name, pairs in (("name", tables.names), ("manual", tables.manual)):
        got = F.try_element_at(mapping(pairs), F.col("word"))
        table = table.when(got.isNotNull(), F.struct(got.alias("m"), F.lit(name).alias("rule")))
    if tables.untouched:
        table = table.when(F.col("word").isin(*tables.untouched), F.struct(F.col("word").alias("m"), F.lit("untouched").alias("rule")))
    rows = words.select("word", table.alias("t"), T.letterforms(F.col("word")).alias("plain"))
    forms = first_known(rows.filter("t is null").select("word", "plain"), F.concat(F.array("plain"), T.silent_e_forms(F.col("plain"))), known)
    ruled = F.coalesce("form", "plain")
    return rows.join(forms, "word", "left").select(
        "word", F.coalesce("t.m", F.when(F.col("t").isNull(), ruled)).alias("modern"),
        F.coalesce("t.rule", F.when(ruled != F.col("word"), "rules").otherwise("none")).alias("rule"),
    )


def swapped(word: str) -> Iterator[list[str]]:
    """The forms of a word by number of letters swapped, one list for each number."""
    places = [i for i, c in enumerate(word) if c in SWAPS]
    if not places or len(places) > MOST_PLACES:
        return
    for n in range(1, len(places) + 1):
        masks = [m for m in range(1 << len(places)) if m.bit_count() == n]
        yield ["".join(SWAPS[c] if i in places and m >> places.index(i) & 1 else c for i, c in enumerate(word)) for m in masks]


def letterform_search(words: DataFrame, known: DataFrame) -> DataFrame:
    """word, modern: for unknown words, the known form with the fewest letters swapped; of equals the commonest, then the first by letter.

    The forms are made in Python (at most 2^7 a word, distinct words only), and met with the dictionary by a join, not by a broadcast.
    """
    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(w, n, f) for w in batch.column("word").to_pylist() for n, forms in enumerate(swapped(w), 1) for f in forms]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else ((), (), ()), (pa.string(), pa.int32(), pa.string()), strict=True)], names=["word", "swaps", "form"])

    unknown = words.select("word").join(known.select("word"), "word", "left_anti")
    forms = unknown.mapInArrow(make, "word string, swaps int, form string")
    plain = T.suffix_rule(F.col("form"))
    tried = forms.select("word", "swaps", F.explode(F.array_distinct(F.concat(F.array("form", plain), T.silent_e_forms(plain)))).alias("form"))
    hits = tried.join(known.select(F.col("word").alias("form"), "freq"), "form")
    return hits.groupBy("word").agg(F.min_by("form", F.struct("swaps", -F.col("freq"), "form")).alias("modern"))


def verb_roots(words: DataFrame, known: DataFrame) -> DataFrame:
    """word, modern: an old verb ending kept, the root before it made modern."""
    ending = F.regexp_extract("word", "(eth|est)$", 1)
    rows = words.select("word", ending.alias("ending")).filter((F.col("ending") != "") & (F.length("word") > 5))
    rows = rows.withColumn("root", F.substring("word", F.lit(1), F.length("word") - 3))
    plain = T.ij_rule(T.uv_rule(F.col("root")))
    roots = first_known(rows.select(F.col("root").alias("word"), plain.alias("plain")).distinct(), F.concat(F.array("plain"), T.silent_e_forms(F.col("plain"))), known).withColumnRenamed("word", "root")
    return rows.join(roots, "root").filter("form <> root").select("word", F.concat("form", "ending").alias("modern"))


def spelling_chain(words: DataFrame, known: DataFrame, tables: Tables = Tables()) -> DataFrame:
    """word, modern, rule: tables and rules, then, for what they don't bring to a known word, the search over letterforms, and then the roots of old verbs."""
    first = modernised(words, known, tables)
    settled = first.filter(~F.col("rule").isin("rules", "none")).select("word")
    open_ = first.join(settled, "word", "left_anti").join(known.select(F.col("word").alias("modern")), "modern", "left_anti").select("word")
    searched = letterform_search(open_, known).withColumn("found", F.lit("letterforms"))
    roots = verb_roots(open_, known).withColumn("found", F.lit("verb root"))
    later = searched.unionByName(roots.join(searched.select("word"), "word", "left_anti")).withColumnRenamed("modern", "other")
    return first.join(later, "word", "left").select("word", F.coalesce("other", "modern").alias("modern"), F.coalesce("found", "rule").alias("rule"))
