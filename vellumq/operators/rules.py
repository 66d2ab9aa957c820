"""Quality rules as a table of patterns, and their violations as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumq.functions import text as T

W = r"[\p{L}\p{N}_]"
#: The patterns of the lint, by kind.
LINTS = {
    "spacing": rf"{W} \s*[,;:!?](?=\s|$)|{W} \.(?=\s|$)|“ (?={W})|(?<={W}) ”",
    "punctuation": r"[,;:][,;:.](?!\d)|(?<!etc)\.[,;:](?!\d)|\.{4,}",
    "quotes": r"“[^”‘’]{0,400}?’’",
    "semicolon": r"#(?:emph|strong|super|smallcaps|footnote)\[[^\]\n]*\];",
    "doubled": rf"(?<!{W})({W}+) \1(?!{W})",
    "glued": r"[a-z][,;:][A-Za-z]|[a-z]\.[A-Z][a-z]",
}
#: The divine name with a small h, but for the adjective after one of these words.
HOLY = r"(?<!\bhis )(?<!\bthy )(?<!\bthat )(?<!\bmy )(?<!\bour )(?<!\byour )(?<!\bher )(?<!\band )\bholy (?:Ghost\b|Spirit\b)|\bholy Ghost\b"
#: Fixed value: a word, then an opening quote where a closing one belongs; a line that is only markup.
WRONG_CLOSE = rf"(?m){W}[‘“](?=[\s,.;:!?)\]]|$)"
MARKUP_LINE = r"^\s*(#set|#import|#\[|\]|//|=)"


def prose(text: Column) -> Column:
    """Lines that are only markup left out, white space collapsed."""
    return T.collapsed(F.array_join(F.filter(T.lines(text), lambda s: ~s.rlike(MARKUP_LINE)), " "))


def _struct(rule: str):
    return lambda m: F.struct(F.lit(rule).alias("rule"), m.alias("match"))


def lint(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    found = F.flatten(F.array(*[F.transform(F.regexp_extract_all("t", F.lit(p), F.lit(0)), _struct(rule)) for rule, p in LINTS.items()]))
    rows = texts.select(key, prose(F.col("text")).alias("t")).select(key, F.explode(found).alias("x")).select(key, "x.rule", "x.match")
    fine = F.lower(F.split("match", " ")[0]).isin(*T.FINE_DOUBLED)
    return rows.filter((F.col("rule") != "doubled") | ~fine)


def holy_names(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    return texts.select(key, F.explode(F.regexp_extract_all(prose(F.col("text")), F.lit(HOLY), F.lit(0))).alias("match")).select(key, F.lit("holy").alias("rule"), "match")


def wrong_quotes(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    return texts.select(key, F.explode(F.regexp_extract_all("text", F.lit(WRONG_CLOSE), F.lit(0))).alias("match")).select(key, F.lit("quotes curled").alias("rule"), "match")


def archaic_changes(table: DataFrame, archaic: tuple[str, ...]) -> DataFrame:
    """Entries (word, modern) of a spelling table that change an old word, or turn -eth into -s."""
    changed = F.col("word").isin(*archaic) & (F.lower("modern") != F.col("word"))
    return table.filter(changed | (F.col("word").endswith("eth") & F.lower("modern").endswith("s")))


def house(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """All rules of running text as one table of violations."""
    return lint(texts, key).unionByName(holy_names(texts, key)).unionByName(wrong_quotes(texts, key))


def portable_counts(text: Column) -> Column:
    """Counts of three rules whose patterns need no look around."""
    rules = {"spacing": rf"{W} [,;:!?]( |$)", "punctuation": r"[,;:][,;:.][^0-9]", "glued": LINTS["glued"]}
    return F.array(*[F.struct(F.lit(k).alias("kind"), F.size(F.regexp_extract_all(text, F.lit(p), F.lit(0))).alias("n")) for k, p in rules.items()])


def reasons(rules: dict[str, Column]) -> Column:
    """The names of the conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]))
