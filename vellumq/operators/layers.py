"""Decisions (choices) over tokens, the layers they project, and coverage.

A choice row: doc_id, pos, orig, abbr?, expan?, regs: array<struct<text, resp, type>>. A null reading means "as printed",
an empty one "left out"; the two are never mixed up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumq.functions import text as T

EDITOR, MACHINE = "#editor", "#auto"
#: The types of a decision that change only a word's form.
FORM = ("spelling", "case", "punctuation", "spacing", "reference")


def reading(regs: str | Column = "regs", orig: str | Column = "orig", expan: str | None = None, only_machine: bool = False) -> Column:
    """The effective reading: the editor's, else the first, else the expansion, else what is printed."""
    editor = F.filter(regs, lambda r: r["resp"] == EDITOR)
    machine = F.filter(regs, lambda r: r["resp"] == MACHINE)
    chosen = F.get(machine, 0)["text"] if only_machine else F.coalesce(F.get(editor, 0)["text"], F.get(regs, 0)["text"])
    return F.coalesce(chosen, *([F.col(expan)] if expan else []), orig)


def effective(regs: str = "regs") -> Column:
    """The decision behind the effective reading: struct<text, resp, type> or null."""
    return F.coalesce(F.get(F.filter(regs, lambda r: r["resp"] == EDITOR), 0), F.get(F.col(regs), 0))


def layer(choices: DataFrame, name: str, expand: bool = False, only_machine: bool = False) -> DataFrame:
    """doc_id, pos, text of one layer: orig, reg, abbr or expan."""
    if name == "orig":
        text = F.coalesce("expan", "orig") if expand else F.coalesce("abbr", "orig") if "abbr" in choices.columns else F.col("orig")
    elif name == "reg":
        text = reading(only_machine=only_machine)
    else:
        text = F.coalesce(name, "orig")
    return choices.select("doc_id", "pos", text.alias("text"))


def printed(choices: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text: a layer's tokens joined in reading order, those left out skipped."""
    rows = choices.filter(F.col(text) != "").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", F.col(text).alias("t")))).alias("x"))
    return rows.select("doc_id", F.array_join(F.transform("x", lambda r: r["t"]), " ").alias("text"))


def n_words(text: Column) -> Column:
    return F.size(T.words(text))


def coverage(choices: DataFrame, *by: str) -> DataFrame:
    """Printed words by what became of them: form only, grammar, other wording (with words added and removed), unchanged.

    Weights are printed word counts. A decision without a type counts as spelling.
    """
    e = effective()
    rows = choices.select(*by, n_words(F.col("orig")).alias("o"), n_words(F.coalesce(reading(), F.lit(""))).alias("r"), F.when((e["text"].isNotNull()) & (e["text"] != F.col("orig")), F.coalesce(e["type"], F.lit("spelling"))).alias("type"))
    form, wording = F.col("type").isin(*FORM), F.col("type").isNotNull() & ~F.col("type").isin(*FORM, "grammar")
    out = rows.groupBy(*by).agg(
        F.sum("o").alias("words"), F.coalesce(F.sum(F.when(form, F.col("o"))), F.lit(0)).alias("form"), F.coalesce(F.sum(F.when(F.col("type") == "grammar", F.col("o"))), F.lit(0)).alias("grammar"),
        F.coalesce(F.sum(F.when(wording, F.col("o"))), F.lit(0)).alias("wording"), F.coalesce(F.sum(F.when(wording, F.greatest(F.lit(0), F.col("r") - F.col("o")))), F.lit(0)).alias("added"), F.coalesce(F.sum(F.when(wording, F.greatest(F.lit(0), F.col("o") - F.col("r")))), F.lit(0)).alias("removed"),
    )
    unchanged = F.col("words") - F.col("form") - F.col("grammar") - F.col("wording")
    return out.withColumn("unchanged_pct", F.round(100 * unchanged / F.greatest("words", F.lit(1)), 1))


def summary(form: str = "form", words: str = "words") -> Column:
    return F.format_string("%d of %d words changed in form (%s %%)", form, words, F.round(100 * F.col(form) / F.greatest(words, F.lit(1)), 1).cast("string"))


def decisions_by_kind(choices: DataFrame) -> DataFrame:
    """type, n of the effective decisions."""
    return choices.select(effective().alias("e")).filter("e is not null").groupBy(F.coalesce("e.type", F.lit("spelling")).alias("type")).agg(F.count("*").alias("n"))


def decision_triples(choices: DataFrame) -> DataFrame:
    """orig, auto, editor, n of distinct decisions."""
    auto = F.get(F.filter("regs", lambda r: r["resp"] == MACHINE), 0)["text"]
    editor = F.get(F.filter("regs", lambda r: r["resp"] == EDITOR), 0)["text"]
    return choices.groupBy("orig", auto.alias("auto"), editor.alias("editor")).agg(F.count("*").alias("n"))


def case_breaks(choices: DataFrame) -> DataFrame:
    """Choices by which the machine lowercases a printed God."""
    auto = F.exists("regs", lambda r: (r["resp"] == MACHINE) & r["text"].rlike(r"\bgod\b"))
    return choices.filter(F.col("orig").rlike(r"\bG(?:od|OD)\b") & auto)
