"""Planted cases for the tests: each operator on rows that hold what it is for, with the rows it must give as SQL. None is a registered query, as none reads a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumq.functions import text as T
from vellumq.operators import align as A
from vellumq.operators import gates as Q
from vellumq.operators import html as H
from vellumq.operators import layers as L
from vellumq.operators import markup as M
from vellumq.operators import normalise as N
from vellumq.operators import ordered as O
from vellumq.operators import outline as U
from vellumq.operators import predicates as P
from vellumq.operators import references as R
from vellumq.operators import rules as Y
from vellumq.operators import scans as C
from vellumq.operators import select as X
from vellumq.operators import sync as Z
from vellumq.operators import witness as V

QUERIES, ORACLES = {}, {}
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def sql_value(x: object) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, str):
        return " || chr(10) || ".join("'" + part.replace("'", "''") + "'" for part in x.split("\n"))
    return str(x).upper() if isinstance(x, bool) else repr(x)


def case(columns: str, *rows: tuple):
    """Registers a query that makes these columns ("name type, ...") and the rows it must give."""
    fields = [c.split() for c in columns.split(", ")]

    def add(f: Callable[[SparkSession], DataFrame]):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark).select(*[F.col(n).cast(t).alias(n) for n, t in fields])

        query.__name__, query.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = query
        casts = ", ".join(f'CAST(c{i} AS {TYPES[t]}) AS "{n}"' for i, (n, t) in enumerate(fields))
        values = ", ".join("(" + ", ".join(map(sql_value, r)) + ")" for r in rows)
        ORACLES[f.__name__] = f"SELECT {casts} FROM (VALUES {values}) AS t({', '.join(f'c{i}' for i in range(len(fields)))})"
        return f

    return add


PAIR = "a bigint, b bigint, text_a string, text_b string"
REGS = "array<struct<text:string,resp:string,type:string>>"

# -- alignment

_KINDS = [
    ("He said ‘so’", "He said 'so'", "quotes"), ("See any thing here", "See anything here", "spacing"), ("bread, wine", "bread; wine", "punct"), ("in Heb. xii. 5 is", "in Heb 12:5 is", "refs"), ("the God of", "the god of", "case"),
    ("he hath it", "he has it", "grammar"), ("place whereof he", "place of which he", "grammar"), ("a publick house", "a public house", "spelling"), ("one cat more", "one dog more", "wording"),
]


@case("a bigint, kind string", *[(i, k) for i, (_, _, k) in enumerate(_KINDS)])
def case_change_kinds(spark):
    """SM3: one change of each kind. The Hebrews reference is several differences, of which the first kind by seq is taken with all signs."""
    rows = [(i, i, x, y) for i, (x, y, _) in enumerate(_KINDS)]
    found = A.changes(spark.createDataFrame(rows, PAIR))
    refs = spark.createDataFrame([(["Heb", ".", "xii", ".", "5"], ["Heb", "12", ":", "5"])], "old array<string>, new array<string>").select(F.lit(3).cast("long").alias("a"), A.change_kind(F.col("old"), F.col("new"), F.lit(0.0)).alias("kind"))
    return found.filter("a <> 3").select("a", "kind").distinct().unionByName(refs)


_DECISIONS = [("God", "god", "case"), ("loue", "love", "spelling"), ("hath", "has", "grammar"), ("be", "is", "grammar"), ("saith", "says", "grammar"), ("an", "a", "grammar"), ("wert", "were", "grammar"), ("loveth", "loves", "grammar"), ("be", "bee", "spelling"), ("12", "13", "emendation"), ("cat", "dog", "emendation")]


@case("a bigint, old string, new string, kind string", *[(i, *x) for i, x in enumerate(_DECISIONS)])
def case_decision_classes(spark):
    """SM2: decisions on one word."""
    return A.decisions(spark.createDataFrame([(i, i, f"so {x} it", f"so {y} it") for i, (x, y, _) in enumerate(_DECISIONS)], PAIR)).select("a", "old", "new", "kind")


@case("a bigint, i int, j int", (1, 0, 0), (1, 1, 1), (1, 2, None), (2, None, 0), (2, 0, 1), (2, 1, 2), (3, 0, 1), (3, 1, 0))
def case_note_pairs(spark):
    """Notes in order, one alone, notes behind a long insertion, notes that cross."""
    notes = "the first of the notes\nthe second one of them"
    rows = [(1, 1, "a note on grace\nanother thing\nzzzz qqqq xxxx", "A note on grace.\nanother thing here"), (2, 2, notes, " ".join(f"x{i}" for i in range(700)) + "\n" + notes), (3, 3, "rom 3 25\nluke 7 13", "luke 7 13\nrom 3 25")]
    return A.note_pairs(spark.createDataFrame(rows, PAIR))


@case("a bigint, row int, old string, new string", (1, 0, "0", "0"), (1, 1, "1", ""), (1, 2, "2", "1"), (1, 3, "", "2"), (2, 0, "0,1", "0,1"), (3, 0, "0", "0"), (3, 1, "", "1"))
def case_block_pairs(spark):
    """J3, AG21: blocks that correspond, one left out, one added, two that overlap two."""
    rows = [(1, 1, "a b c\nx y\nd e f", "a b c\nd e f\nq"), (2, 2, "a b c d\ne f", "a b\nc d e f"), (3, 3, "one two", "one two\nthree")]
    return A.block_pairs(spark.createDataFrame(rows, PAIR)).select("a", "row", *[F.array_join(c, ",").alias(c) for c in ("old", "new")])


@case("a bigint, cluster int, source string, target string", (1, 0, "two three four", "too three fore"), (2, 0, "b", "x"), (2, 1, "e", "y z"))
def case_clusters(spark):
    """Differences one equal word apart are one cluster."""
    return A.clusters(spark.createDataFrame([(1, 1, "one two three four five six", "one too three fore five six"), (2, 2, "a b c d e f", "a x c d y z f")], PAIR))


@case("a bigint, p int, q int", (1, 0, 0), (1, 1, 1), (1, 2, 4), (1, 3, 5))
def case_position_map(spark):
    """Positions behind an insertion."""
    return A.whole_map(A.ops(spark.createDataFrame([(1, 1, "a b c d", "a b x y c d")], PAIR)))


@case("words_a bigint, words_b bigint, ratio double, places bigint", (3, 3, 1.0, 0))
def case_drift(spark):
    """J2's loose reading: spellings of one word are no drift."""
    return V.drift(spark.createDataFrame([(1, 2, "loue the Lorde", "love the Lord")], PAIR))


@case("doc bigint, at int, word string, was string", (1, 4, "a", "the"))
def case_slips(spark):
    """A word that two witnesses have otherwise."""
    return V.slips(spark.createDataFrame([(1, 2, 3, "the cat sat on a mat", "the cat sat on the mat", "then the cat sat on the mat again")], "doc long, early long, witness long, text string, early_text string, witness_text string"))


def _told(spark):
    text = "At the old mill was grain and it was good"
    told = ["At the old mill there was grain and it was good", "At the old mill thero was grain and it was goud", "At the old mill was PAGE2 grain grain and it was goud"]
    return V.witness_words(spark.createDataFrame([(1, n, text, t) for n, t in enumerate(told, 2)], PAIR))


@case("b bigint, i1 int, words string, witnesses bigint", (2, 4, "there", 2), (3, 4, "thero", 2))
def case_collate(spark):
    """Words that two witnesses have, read alike; a catchword is none."""
    return V.collate(_told(spark)).withColumn("words", F.array_join("words", " "))


@case("at int, word string, witnesses bigint", (9, "goud", 2))
def case_near_misses(spark):
    """One word for which two witnesses have one other."""
    return V.near_misses(_told(spark))


@case("n int, k int, likeness double", (0, 1, 0.9995), (2, 3, 0.9995), (4, 4, 0.923077))
def case_forward_match(spark):
    """Paragraphs in turn; none is matched twice or behind the last."""
    key = lambda n: " ".join(f"w{n}x{i}" for i in range(6))
    own = spark.createDataFrame([("d", i, key(n)) for i, n in enumerate((1, 1, 3, 2, 4))], "doc string, n int, key string")
    other = spark.createDataFrame([("d", i, key(n) + (" more" if n == 4 else "")) for i, n in enumerate((0, 1, 2, 3, 4))], "doc string, n int, key string")
    return V.forward_match(own, other)


# -- outlines

_OUTLINE = [
    (1, "1. Trades: many.\n1. Smiths, thus:\n1. Of iron.\n2. Of tin.\n2. Potters.\n2. Farms."), (2, "1. Soil\n2. Seed\n1. Soil is tilled.\n1. By oxen, in two ways:\n2. By hand.\n2. Seed is sown."),
    (3, "First, wool: kinds.\n(1) Fine.\n(2) Coarse.\nplain\nSecondly, flax."), (4, None),
]


@case(
    "doc_id bigint, line int, level int, style string, n int, retake boolean",
    *[(1, i, lvl, "digit", n, False) for i, (lvl, n) in enumerate([(0, 1), (1, 1), (2, 1), (2, 2), (1, 2), (0, 2)], 1)],
    *[(2, i, lvl, "digit", n, i == 3) for i, (lvl, n) in enumerate([(0, 1), (0, 2), (0, 1), (1, 1), (1, 2), (0, 2)], 1)],
    (3, 1, 0, "word", 1, False), (3, 2, 1, "paren", 1, False), (3, 3, 1, "paren", 2, False), (3, 5, 0, "word", 2, False),
)
def case_outline(spark):
    """W8, SF13: points in points, announced ones taken up again, styles told apart."""
    return U.outlines(spark.createDataFrame(_OUTLINE, "doc_id bigint, text string"))


@case("pos int, parent int, number int", (0, -1, 1), (1, 0, 1), (2, 0, 2), (3, 2, 1), (4, -1, 2), (5, 4, 1))
def case_level_counters(spark):
    """Counters that start again under each new point above."""
    return O.level_counters(spark.createDataFrame([(1, i, n) for i, n in enumerate([0, 1, 1, 2, 0, 1])], "doc_id bigint, pos int, level int"))


@case("t string, rank int", ("I. a", 0), ("2. b", 1), ("(3.) c", 2), ("[4.] d", 3), ("1st. e", 4), ("plain", None))
def case_mark_ranks(spark):
    """SF14: ranks of a later edition's marks."""
    rows = spark.createDataFrame([(t,) for t in ("I. a", "2. b", "(3.) c", "[4.] d", "1st. e", "plain")], "t string")
    return rows.select("t", P.mark_rank(F.col("t")).alias("rank"))


# -- editions and markup


def _choices(spark):
    return spark.createDataFrame([
        (1, 0, "God", [("god", "#editor", "case")]), (1, 1, "loue", [("love", "#auto", "spelling"), ("Love", "#editor", None)]), (1, 2, "hath", [("has", "#editor", "grammar")]),
        (1, 3, "old words", [("three new words", "#editor", "emendation")]), (1, 4, "gone", [("", "#editor", "omission")]), (1, 5, "same", []),
    ], f"doc_id bigint, pos int, orig string, regs {REGS}")


@case("doc_id bigint, words bigint, form bigint, grammar bigint, wording bigint, added bigint, removed bigint, unchanged_pct double", (1, 7, 2, 1, 3, 1, 1, 14.3))
def case_coverage(spark):
    """AG1: words by what was done to them, with every class present."""
    return L.coverage(_choices(spark), "doc_id")


@case("pos int, text string", (0, "god"), (1, "Love"), (2, "has"), (3, "three new words"), (4, ""), (5, "same"))
def case_layer(spark):
    """PF1: the editor's layer."""
    return L.layer(_choices(spark), "reg")


@case("text string", ("god Love has three new words same",))
def case_printed(spark):
    """PF3: the layer as a text."""
    return L.printed(L.layer(_choices(spark), "reg"))


@case("type string, n bigint", ("case", 1), ("spelling", 1), ("grammar", 1), ("emendation", 1), ("omission", 1))
def case_decision_kinds(spark):
    """AG6: decisions by kind."""
    return L.decisions_by_kind(_choices(spark))


_XML = '<div type="chapter"><head>A <hi>b</hi></head><p>Printed <choice><orig>loue</orig><reg resp="#auto" type="spelling">love</reg><reg resp="#editor">Love</reg></choice> &amp; more,<note n="1">a note</note> end.</p></div>'


@case("doc_id bigint, xml string", (1, _XML))
def case_xml_round_trip(spark):
    """SC3, SK9: the tokens of an edition give its text back."""
    tokens = M.xml_tokens(spark.createDataFrame([(1, _XML)], "doc_id bigint, xml string"))
    return tokens.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tok_id", "text"))), lambda x: x["text"]), "").alias("xml"))


@case("doc_id bigint, kind string, n bigint", (1, "error", 1), (2, "word", 2), (2, "open", 1), (2, "close", 1), (2, "space", 1))
def case_xml_kinds(spark):
    """SC5: kinds of tokens; a text that isn't well formed is one error."""
    rows = M.xml_tokens(spark.createDataFrame([(1, "<p>"), (2, "<p>a b</p>")], "doc_id bigint, xml string"))
    return rows.groupBy("doc_id", "kind").agg(F.count("*").alias("n"))


@case("at int, kind string", (2, "split"), (3, "list"))
def case_structure(spark):
    """QA8: a paragraph split, a list made."""
    return Z.structure(spark.createDataFrame([(1, 2, "one two three\n\nfour five", "one two\n\nthree\n\n+ four five")], PAIR))


@case("facet string, same boolean", ("words", True), ("italics", False), ("notes", True), ("headings", True), ("lists", True))
def case_facets(spark):
    """SM11, QA7: what two chapters have in common."""
    return Z.facets(spark.createDataFrame([(1, 2, "a #emph[b]", "a b")], PAIR))


@case("a bigint, orig string, auto string, editor string, type string, failed string", (1, "loue", "love", None, "spelling", ""), (1, "Iustice", "Justice", "justice", "spelling", ""), (1, "vpon", "upon", None, "spelling", ""), (2, None, None, None, None, "well formed"))
def case_sync(spark):
    """J21, QA3: a source and its review as decisions in the source, and the checks that fail."""
    rows = [(1, 1, "<p>I loue the Iustice and stand vpon it.</p>", "I love the justice and stand upon it."), (2, 2, "<p>", "x")]
    found = Z.sync(spark.createDataFrame(rows, "a bigint, b bigint, xml string, review string"))
    return found.select("a", F.explode_outer("decisions").alias("d"), F.array_join("failed", ",").alias("failed")).select("a", "d.orig", "d.auto", "d.editor", "d.type", "failed")


@case("phrase string, n bigint", ("the holy word", 2), ("word.", 1), ("none", 0))
def case_phrases_once(spark):
    """QA9: how often a correction's phrase stands in a text."""
    return Z.once(spark.createDataFrame([(1, "the holy\n word. the holy word"), (2, None)], "doc_id bigint, text string"), ["the holy word", "word.", "none"])


@case("k string, before string, after string", ("a", None, "b"), ("b", "a", "c"), ("c", "b", None))
def case_partners(spark):
    """Neighbours in a group."""
    return Z.partners(spark.createDataFrame([("g", 1, "a"), ("g", 2, "b"), ("g", 3, "c")], "g string, n int, k string"), "g", "n", "k")


# -- references


def _verse_counts(spark):
    return spark.createDataFrame([("1 Samuel", 14, 52), ("Psalms", 37, 40), ("1 Corinthians", 7, 40), ("Hebrews", 12, 29), ("Psalms", 23, 6), ("Genesis", 1, 31)], "book string, chapter int, n int")


@case("share double", (0.25,))
def case_weak_quotes(spark):
    """PF14: quotations that share too little with their verse."""
    return R.weak_quotes(spark.createDataFrame([(["a", "b", "c", "d"], ["a"]), (["a", "b", "c", "d"], ["a", "b"]), (["a"], [])], "words array<string>, verse array<string>"))


# -- spelling


@case("word string, modern string, rule string", ("iustice", "justice", "rules"), ("hath", "hath", "exception"), ("looke", "look", "rules"), ("prou", "prov", "manual"), ("zzz", "zzz", "none"), ("jjvuv", "iivvu", "letterforms"), ("lookeeth", "looketh", "verb root"))
def case_spelling_chain(spark):
    """J11, SF4: tables, rules, letterforms, verb roots."""
    words = spark.createDataFrame([(w,) for w in ("iustice", "hath", "looke", "prou", "zzz", "jjvuv", "lookeeth")], "word string")
    known = spark.createDataFrame([("justice", 9), ("look", 5), ("iivvu", 3)], "word string, freq bigint")
    return N.spelling_chain(words, known, N.Tables(manual={"prou": "prov"}))


@case("word string, forms string", ("stirre", "stirr,stir"), ("goates", "goats"), ("busines", "busins,business"))
def case_silent_e(spark):
    """SF3: forms without a silent e."""
    return spark.createDataFrame([("stirre",), ("goates",), ("busines",)], "word string").select("word", F.array_join(T.silent_e_forms(F.col("word")), ",").alias("forms"))


@case("t string, curled string", ("\"I'll go,\" he said ('so')", "“I’ll go,” he said (‘so’)"))
def case_curled(spark):
    """Straight quotes as curly ones."""
    return spark.createDataFrame([("\"I'll go,\" he said ('so')",)], "t string").select("t", T.curled(F.col("t")).alias("curled"))


@case("key string", ("εν αρχη",), (None,))
def case_accents(spark):
    """SF22: letters without accents."""
    return P.stripped_accents(spark.createDataFrame([("Ἐν ἀρχῇ",), (None,)], "t string"), "t")


# -- folds and predicates


def _stream(spark, rows):
    return spark.createDataFrame([(1, i, k, t) for i, (k, t) in enumerate(rows)], "doc_id bigint, pos int, kind string, text string")


@case("pos int, parent int", (0, None), (1, 0), (2, 0), (3, 2), (4, None))
def case_nested_items(spark):
    """QA8c: list items under their item."""
    return O.nested_items(spark.createDataFrame([(1, 0, 0), (1, 1, 1), (1, 2, 1), (1, 3, 2), (1, 4, 0)], "doc_id bigint, pos int, depth int"))


@case("pos int, block int, previous int, next int", (0, 0, None, 1), (1, 1, 0, None), (2, 1, None, None))
def case_split_blocks(spark):
    """QA8b: a block that is split is linked both ways."""
    return O.split_blocks(spark.createDataFrame([(1, 0, False), (1, 1, True), (1, 2, False)], "doc_id bigint, pos int, split boolean"))


@case("pos int, text string", (0, "a"), (1, "|"), (2, " "), (3, "b"))
def case_page_break_spaces(spark):
    """A space moves behind a page mark."""
    return O.page_break_spaces(_stream(spark, [("w", "a"), ("s", " "), ("p", "|"), ("w", "b")]))


@case("pos int, text string", (1, "grace"), (3, "grace"))
def case_catchwords(spark):
    """Words that stand on either side of a page mark."""
    return O.near_page_marks(_stream(spark, [("w", "of"), ("w", "grace"), ("p", "|"), ("w", "grace"), ("w", "and")])).filter("catch")


@case("pos int, joined string, change string", (0, "anything", "parted"))
def case_spacing_changes(spark):
    """Words that one text parts and the other joins."""
    return O.spacing_changes(_stream(spark, [("w", "any"), ("w", "thing")]), _stream(spark, [("w", "Anything")]))


@case("o string, n string, fill string", ("gr…e", "grace", "ac"), ("gr…e", "glory", None), ("x", "x", None))
def case_gap_fill(spark):
    """What an editor puts into a gap."""
    rows = spark.createDataFrame([("gr…e", "grace"), ("gr…e", "glory"), ("x", "x")], "o string, n string")
    return rows.select("o", "n", O.gap_fill(F.col("o"), F.col("n")).alias("fill"))


@case("joined string", ("(a, b).",))
def case_joined_tokens(spark):
    """AG22: tokens as a text."""
    return spark.createDataFrame([(["(", "a", ",", "b", ")", "."],)], "w array<string>").select(O.joined_tokens(F.col("w")).alias("joined"))


@case("el string", ("a",))
def case_empty_in_edition(spark):
    """PF15: elements without words in an edition."""
    return P.empty_in_edition(spark.createDataFrame([("a", "x", [("", "#editor", "omission")]), ("a", "y", [(" ", "#editor", None)]), ("b", "z", [])], f"el string, orig string, regs {REGS}"), "el")


@case("division string", ("v",))
def case_verse_divisions(spark):
    """PF16: divisions that are mostly verse."""
    return P.verse_divisions(spark.createDataFrame([("v", "l", "one two three four"), ("v", "p", "five"), ("p", "l", "a"), ("p", "p", "b"), ("e", "l", "")], "division string, kind string, text string"))


@case("t string, depth int, ends boolean", ("a (b [c", 2, False), ("End (", 1, True), ("", 0, True), ("x) y", 0, False), (") and", 0, False))
def case_states_before(spark):
    """W14, W16, PF22: open brackets, and whether a stop before a text ends a sentence."""
    rows = spark.createDataFrame([("a (b [c",), ("End (",), ("",), ("x) y",), (") and",)], "t string")
    return rows.select("t", P.bracket_depth(F.col("t")).alias("depth"), P.ends_sentence(F.col("t")).alias("ends"))


@case("t string, number int", ("m", 1), ("n", 2))
def case_footnote_numbers(spark):
    """Notes numbered in reading order."""
    return P.footnote_numbers(spark.createDataFrame([(1, 5, "n"), (1, 2, "m")], "doc_id bigint, pos int, t string"))


@case("pos int, after_level boolean, same_list boolean", (0, False, False), (1, False, True), (2, True, False))
def case_after_level(spark):
    """Blocks after a deeper one, and lists that go on."""
    return P.after_level(spark.createDataFrame([(1, 0, 0, "u"), (1, 1, 1, "u"), (1, 2, 0, "o")], "doc_id bigint, pos int, level int, list string"))


@case("path string, edition string", ("a", "both"), ("b", "modern"), ("c", "none"))
def case_belongs(spark):
    """PF18: which editions a file belongs to."""
    return P.belongs(spark.createDataFrame([("a",), ("b",), ("c",)], "path string"), spark.createDataFrame([("modern", "a"), ("classic", "a"), ("modern", "b")], "start string, node string"))


@case("word string", ("hath",), ("approueth",))
def case_archaic_changes(spark):
    """PF13: spellings that change an old word into another."""
    return Y.archaic_changes(spark.createDataFrame([("hath", "has"), ("approueth", "approves"), ("moneth", "month"), ("loue", "love")], "word string, modern string"), ("hath",))


# -- scans, pages, selection, gates


def _boxes(spark):
    rows = [(1, 5, 1, 1, 1, 1, 10, 20, 5, 6, "Of"), (1, 5, 1, 1, 1, 2, 20, 18, 9, 6, "Temptation"), (1, 5, 1, 1, 2, 1, 10, 30, 5, 6, "ſin"), (1, 4, 1, 1, 2, 0, 0, 0, 99, 99, "x")]
    return C.lines(spark.createDataFrame(rows, "page int, level int, block_num int, par_num int, line_num int, word_num int, left int, top int, width int, height int, text string"))


@case("page int, hits int, at int, left int, top int, right int, bottom int", (1, 2, 1, 10, 18, 29, 36))
def case_best_window(spark):
    """The lines that hold most of the words, some misread."""
    return C.best_window(_boxes(spark), ["temptatjon", "fin"], 2)


@case("line_num int, words string, left int, top int, right int, bottom int", (1, "Of Temptation", 10, 18, 29, 26), (2, "ſin", 10, 30, 15, 36))
def case_line_words(spark):
    """SC12, AG16: lines with their words and boxes."""
    return _boxes(spark).withColumn("words", F.array_join("words", " "))


@case("page int, at int, n int", (1, 2, 5))
def case_stray_numbers(spark):
    """A note's number that doesn't follow."""
    return C.stray_numbers(spark.createDataFrame([(1, 0, 1), (1, 1, 2), (1, 2, 5)], "page int, at int, n int"))


@case("book string, size int", ("b", 12))
def case_body_size(spark):
    """AG8: the size that most text is set in."""
    return C.body_size(spark.createDataFrame([("b", 10, "aaa"), ("b", 12, "aa"), ("b", 12, "a")], "book string, size int, text string"))


@case("page int", (2,))
def case_done_pages(spark):
    """SC13: pages still to be read."""
    pages = spark.createDataFrame([("s", 2, "x"), ("s", 1, "y")], "scan string, page int, text string")
    return C.done_pages(pages, pages.filter("page = 1"), ["scan", "page"])


@case("text string", ("wonderful A-\nB",))
def case_dehyphenated(spark):
    """SC11: words parted by a line's end."""
    return spark.createDataFrame([("won-\nderful A-\nB",)], "text string").select(C.dehyphenated().alias("text"))


@case("block int, parent int", (0, None), (1, 0), (2, 1), (3, 0), (4, None))
def case_nested_headings(spark):
    """Headings under their heading."""
    return H.nested(spark.createDataFrame([(1, 0, 1), (1, 1, 2), (1, 2, 3), (1, 3, 2), (1, 4, 1)], "page_id bigint, block int, level int"), "page_id")


@case("href string, text string", ("u#n1", "the note"))
def case_anchored(spark):
    """Links with the notes they lead to."""
    pages = spark.createDataFrame([(1, "<body><h1>A</h1><p>two <a class=x href='u#n1'>link</a></body>")], "page_id bigint, html string")
    return H.anchored(H.links(pages).select("page_id", "href"), spark.createDataFrame([(1, "n1", "the note")], "page_id bigint, id string, text string"))


_TARGETS, _FLAGS = [("f", 10, 11), ("f", 500, 501), ("g", 10, 11)], [("f", 14, 15), ("f", 600, 601), ("f", 3, 8)]


@case("file string, w1 int", ("f", 10))
def case_spans_hit(spark):
    """Planted errors that a flag meets."""
    return X.spans_hit(spark.createDataFrame(_TARGETS, "file string, w1 int, w2 int"), spark.createDataFrame(_FLAGS, "file string, a int, b int"))


@case("file string, w1 int", ("f", 10))
def case_covered_by(spark):
    """Planted errors inside a sentence that was read."""
    return X.covered_by(spark.createDataFrame(_TARGETS, "file string, w1 int, w2 int"), spark.createDataFrame([("f", 11, 20)], "file string, a int, b int"))


@case("planted bigint, caught bigint, flags bigint, false_alarms bigint", (3, 1, 3, 1))
def case_caught(spark):
    """AG11: what a reader caught."""
    return X.caught(spark.createDataFrame(_TARGETS, "file string, w1 int, w2 int"), spark.createDataFrame(_FLAGS, "file string, a int, b int"))


@case("unit string, holds boolean, state string", ("a", True, "done"), ("b", False, "carried"), ("c", False, "held"), ("d", True, "ready"), ("e", False, "changed"))
def case_states(spark):
    """QA6: every state of a unit, changed ones too."""
    return Q.state(spark.createDataFrame([("a", [], [], True), ("b", ["x"], [], True), ("c", [], ["p"], True), ("d", [], [], False), ("e", ["x"], [], False)], "unit string, changed array<string>, problems array<string>, signed boolean"))


def _prints(spark):
    old = Q.fingerprints(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, t string"), "k", "t", "old")
    return old, Q.fingerprints(spark.createDataFrame([(1, "a"), (2, "c"), (4, "")], "k int, t string"), "k", "t", "new")


@case("key string, change string", ("1", "same"), ("2", "changed"), ("3", "gone"), ("4", "added"))
def case_compared(spark):
    """J16, QA4: two snapshots."""
    return Q.compared(*_prints(spark))


@case("change string, key string", ("added", "4"), ("gone", "3"))
def case_added_and_gone(spark):
    """SO2: what came and went."""
    return Q.added_and_gone(*_prints(spark), "key")


@case("k string, n bigint", ("a", 2), ("c", 0))
def case_exactly_one(spark):
    """Corrections that don't fit one place."""
    return Q.exactly_one(spark.createDataFrame([("a",), ("a",), ("b",)], "k string"), spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), "k")


@case("id string, title string, note string", ("e1", "T1", "x"), ("e2", "t2", None))
def case_inherited(spark):
    """Fields taken from a parent."""
    own = spark.createDataFrame([("e1", "b1", None, "x"), ("e2", "b2", "t2", None)], "id string, book string, title string, note string")
    return Q.inherited(own, spark.createDataFrame([("b1", "T1", "n1")], "book string, title string, note string"), "book", ["title", "note"])


@case("k string", ("b",))
def case_not_covered(spark):
    """PF5: blocks that no part covers."""
    return Q.covered(spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("a",)], "k string"), "k")


@case("path string, kind string, volume int, edition string", ("x/vol2/chapters/modern/a.typ", "chapter", 2, "modern"), ("cover.pdf", "pdf", None, "classic"))
def case_editions(spark):
    """PF11: what a path says."""
    return Q.editions(spark.createDataFrame([("x/vol2/chapters/modern/a.typ",), ("cover.pdf",)], "path string"))
