"""Scripture references in their context: partial ones take book and chapter from what goes before, lists become rows, and all are put into one form.

1. ``signs``: the words, numbers and marks of texts that name a book before a number, each with its kind: name, lead ("ver.", "chap."), num, sep, or other.
2. A reference is a name or a lead with the numbers and separators that follow it without a break: an island by a running count of all other signs. A number opens a chapter where a stop or colon and a
   further number follow it, and it isn't itself behind a stop ("17 and 27. 4." has the chapter 27), or behind a semicolon.
3. Book and chapter are carried within a line by windows, so "ver. 9" and "chap. 3. 4" get theirs from the last reference that has them; a new line forgets both.
4. Validity is a join with the table of chapters (book, chapter, n verses). A list of numbers after commas that aren't verses may be chapters ("Ps. 32, 109"); books of one chapter have verses alone ("Jude 5").
5. ``restyled`` splices the new forms of references that are valid throughout into their texts.

Texts are never joined with each other; names and chapters are lookups of some hundred and some thousand rows. Null texts, and texts without a full reference, have no rows and stay as they are.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellumq.operators import references as R

#: Signs with the blanks before them, leads of verses and of chapters, separators, books of one chapter, and numbers in Roman numerals.
SIGN = r"[ \t\r]*(?:\p{L}+|[0-9]+|\n|[^\p{L}0-9 \t\r\n])|[ \t\r]+"
VERSE = ("ver", "vers", "v", "vv", "verse", "verses")
CHAPTER = ("ch", "chap", "chaps", "chapter", "chapters")
SEPARATOR = (".", ":", ",", ";", "-", "–", "and", "&")
DASH = ("-", "–")
STOP = (".", ":")
BETWEEN = (*SEPARATOR, ", and", ". and", "; and", ", &", ". &", "; &")
ONE_CHAPTER = ("Obadiah", "Philemon", "2 John", "3 John", "Jude")
ROMAN = r"^(?=.)c{0,3}(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})$"
ORDINAL = ("1", "2", "3", "I", "II", "III")


def forms() -> list[tuple[str, str | None, str | None]]:
    """(form, book, base): lower-case forms of one word of books without a number, and of the names behind a number. A form of several books is the first's."""
    plain, base = {}, {}
    for book in R.BOOKS:
        number, _, rest = book.rpartition(" ") if book[0] in "123" else ("", "", book)
        word = rest.split(" ")[0]
        for n in range(2 if number else 3, len(word) + 1):
            (base if number else plain).setdefault(word[:n].lower(), rest if number else book)
    plain |= {k: v for k, v in R.SHORT.items() if " " not in k}
    return [(k, plain.get(k), base.get(k)) for k in sorted(plain.keys() | base.keys())]


def beginnings() -> str:
    """A pattern of a name's beginning and a number after it."""
    starts = sorted({k[:3].capitalize() for k, book, _ in forms() if book} | {k[:2].capitalize() for k, _, base in forms() if base} | {k.capitalize() for k in R.SHORT if len(k) < 3})
    return rf"(?:^|[^\p{{L}}])(?:{'|'.join(starts)})\p{{L}}*\.?[ \t\r]*(?:[0-9]|[ivxlcIVXLC]+[^\p{{L}}])"


def _tree(names: list[str]) -> str:
    """A pattern of these names, by their first letters."""
    tree: dict[str, list[str]] = {}
    for name in names:
        tree.setdefault(name[0], []).append(name[1:])
    return "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in sorted(tree.items()))


def quick_beginnings() -> str:
    """What beginnings() matches, with the names as a tree: at a place where no name's first letter stands one look settles it."""
    names, after = re.fullmatch(r"\(\?:\^\|\[\^\\p\{L\}\]\)\(\?:([^()]*)\)(.*)", beginnings()).groups()
    first = "".join(sorted({x[0] for x in names.split("|")}))
    return rf"(?:^|[^\p{{L}}])(?=[{first}])(?:{_tree(names.split('|'))}){after}"


def full() -> str:
    """A pattern of a whole name, in any case but for its capital, with a number right behind it or behind one stop. Where there is none no reference takes a book, so there is no row; "Then 5" begins like a name and isn't one."""
    names = [k for k, _, _ in forms()] + ["solomon", "songs"]
    return rf"(?:^|[^\p{{L}}])(?=\p{{Lu}})(?iu:{_tree(names)})(?!\p{{L}})[ \t\r]*\.?[ \t\r]*(?:[0-9]{{1,3}}(?![0-9\p{{L}}])|[ivxlcIVXLC]+(?!\p{{L}}))"


def candidate(text: Column) -> Column:
    """Whether a text may hold a full reference."""
    return F.coalesce(text.rlike(quick_beginnings()) & text.rlike(full()), F.lit(False))


def roman(word: Column) -> Column:
    """The value of a Roman numeral: each letter, less twice the one before where that is smaller."""
    one = F.transform(F.split(F.lower(word), ""), lambda c: F.when(c == "i", 1).when(c == "v", 5).when(c == "x", 10).when(c == "l", 50).when(c == "c", 100).otherwise(0))
    return F.aggregate(one, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last")), lambda a, x: F.struct((a["sum"] + x - F.when(a["last"] < x, 2 * a["last"]).otherwise(0)).alias("sum"), x.alias("last")), lambda a: a["sum"])


def signs(documents: DataFrame) -> DataFrame:
    """doc_id, pos, w, start, len, line, kind, book, extra, value, run: the signs of candidate texts, and the island each is in. start is a character's place, extra the signs before a name that are part of it."""
    spark: SparkSession = documents.sparkSession
    rows = documents.filter(candidate(F.col("text"))).select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(f"({SIGN})"), 1)).alias("pos", "piece"))
    order = Window.partitionBy("doc_id").orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("w", F.regexp_replace("piece", "^[ \\t\\r]+", "")).withColumn("len", F.length("w")).withColumn("start", (F.sum(F.length("piece")).over(so_far) - F.col("len")).cast("int"))
    rows = rows.withColumn("line", F.sum((F.col("w") == "\n").cast("int")).over(so_far)).withColumn("tight", F.length("piece") == F.col("len"))
    known = F.broadcast(spark.createDataFrame(forms(), "form string, plain string, base string"))  # some 500 rows, made by rule
    capital = F.col("w").rlike(r"^\p{Lu}")
    rows = rows.withColumn("form", F.when(capital, F.lower("w"))).join(known, "form", "left").drop("form")

    def back(c: str, n: int = 1) -> Column:
        return F.lag(c, n).over(order)

    def on(c: str, n: int = 1) -> Column:
        return F.lead(c, n).over(order)

    before = F.when(F.col("base").isNotNull() & back("w").isin(*ORDINAL), back("w")).when(F.col("base").isNotNull() & (back("w") == ".") & back("w", 2).isin(*ORDINAL), back("w", 2))
    numbered = F.concat(F.when(before.isin("1", "2", "3"), before).otherwise(F.length(before).cast("string")), F.lit(" "), F.col("base"))
    song = F.col("w").isin("Solomon", "Songs") & (back("w") == "of") & (back("w", 2) == "Song")
    rows = rows.withColumn("numbered", F.when(numbered.isin(*R.BOOKS), numbered)).withColumn("song", F.coalesce(song, F.lit(False)))
    rows = rows.withColumn("book", F.when(F.col("song"), "Song of Solomon").otherwise(F.coalesce("numbered", "plain")))
    rows = rows.withColumn("extra", F.when(F.col("song"), 2).when(F.col("numbered").isNotNull(), F.when(back("w") == ".", 2).otherwise(1)).otherwise(0))
    rows = rows.withColumn("part", F.coalesce((on("extra") >= 1) | (on("extra", 2) >= 2), F.lit(False)))
    rows = rows.withColumn("digits", F.col("w").rlike("^[0-9]{1,3}$") & ~F.coalesce(on("tight") & on("w").rlike(r"^\p{L}"), F.lit(False)))
    rows = rows.withColumn("behind", F.coalesce(back("book").isNotNull() | ((back("w") == ".") & back("book", 2).isNotNull()), F.lit(False)))
    is_roman = F.lower("w").rlike(ROMAN)
    counted = F.col("digits") | is_roman
    rows = rows.withColumn("counted", counted)
    numeral = is_roman & (F.col("behind") | ((F.col("w") == F.lower("w")) & on("w").isin(*STOP) & on("digits", 2)))
    verses, chapters = F.lower("w").isin(*VERSE), F.lower("w").isin(*CHAPTER)
    follows = F.when(verses, on("digits") | ((on("w") == ".") & on("digits", 2))).when(chapters, on("counted") | ((on("w") == ".") & on("counted", 2)))
    lead = F.coalesce((verses | chapters) & ~F.col("behind") & follows, F.lit(False))
    kind = F.when(F.col("part"), "other").when(F.col("book").isNotNull(), "name").when(lead, "lead").when(F.col("digits") | F.coalesce(numeral, F.lit(False)), "num").when(F.lower("w").isin(*SEPARATOR), "sep").otherwise("other")
    rows = rows.withColumn("kind", kind).withColumn("value", F.when(F.col("kind") == "num", F.when(F.col("digits"), F.col("w").try_cast("int")).otherwise(roman(F.col("w")))))
    run = F.sum((~F.col("kind").isin("num", "sep")).cast("int")).over(so_far)
    return rows.withColumn("run", run).select("doc_id", "pos", "w", "start", "len", "line", "kind", "book", "extra", "value", "run")


def resolved(signs: DataFrame, chapters: DataFrame) -> DataFrame:
    """doc_id, run, n, start, end, head (name, verse or chapter), book, chapter, verse, upto, reading, valid: a row for each verse, range or chapter alone.

    start and end: the reference's characters; n: the row's place in it; upto: the end of a range; reading: verses, chapter, or chapters for a list of them. chapters: book, chapter, n; unique, 5,000 rows at most, which is checked before they are sent.
    """
    if chapters.limit(5001).count() > 5000:
        raise ValueError("a table of chapters has 5,000 rows at most")
    order = Window.partitionBy("doc_id").orderBy("pos")
    lag = lambda c, n: F.lag(c, n).over(order)
    held = lambda n: lag("kind", n).isin("num", "name", "lead")
    by = F.when(held(1), "").when(held(2), F.lower(lag("w", 1))).when(held(3) & (lag("kind", 2) == "sep"), F.concat(F.lower(lag("w", 2)), F.lit(" "), F.lower(lag("w", 1)))).otherwise("x")
    start = F.when(F.col("extra") > 0, F.when(F.col("extra") == 1, lag("start", 1)).otherwise(lag("start", 2))).otherwise(F.col("start"))
    rows = signs.withColumn("by", by).withColumn("next", F.lead("w").over(order)).withColumn("begin", start)
    heads = rows.filter("kind IN ('name', 'lead')").select("doc_id", "run", F.when(F.col("kind") == "name", "name").when(F.lower("w").isin(*VERSE), "verse").otherwise("chapter").alias("head"), "book", F.col("begin").alias("start"))
    own = Window.partitionBy("doc_id", "run").orderBy("pos")
    own_so_far = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("doc_id", "run")
    nums = rows.filter("kind = 'num'").select("doc_id", "run", "pos", "line", "by", "next", "value", (F.col("start") + F.col("len")).alias("end")).join(heads, ["doc_id", "run"]).withColumn("i", F.row_number().over(own))
    bare = (F.col("by") == "") & (F.col("i") == 2) & F.coalesce(F.col("next").isin(".", ",", ";", ")"), F.lit(False))
    fits = F.when(F.col("i") == 1, F.col("by").isin("", ".")).otherwise(F.col("by").isin(*BETWEEN) | bare)
    nums = nums.withColumn("bad", F.max((~fits).cast("int")).over(own_so_far)).filter("bad = 0")
    nums = nums.withColumn("then", F.lead("by").over(own)).withColumn("upto", F.when(F.col("then").isin(*DASH), F.lead("value").over(own))).withColumn("end", F.when(F.col("then").isin(*DASH), F.lead("end").over(own)).otherwise(F.col("end")))
    first_stop = F.first("then").over(own_so_far)
    nums = nums.withColumn("single", F.col("book").isin(*ONE_CHAPTER) & ~((F.first("value").over(own_so_far) == 1) & F.coalesce(first_stop.isin(*STOP), F.lit(False))))
    stops = F.coalesce(F.col("then").isin(*STOP), F.lit(False))
    opens = F.when(F.col("head") == "verse", F.lit(False)).when(F.coalesce("single", F.lit(False)), F.lit(False)).when(F.col("i") == 1, F.lit(True)).when(F.col("by").startswith(";"), F.lit(True)).otherwise(stops & ~F.col("by").isin(*STOP, *DASH, ""))
    nums = nums.withColumn("opens", opens)
    line = Window.partitionBy("doc_id", "line").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nums = nums.withColumn("book", F.last("book", ignorenulls=True).over(line))
    nums = nums.withColumn("chapter", F.last(F.when(F.col("opens"), F.col("value")).when(F.coalesce("single", F.lit(False)), 1), ignorenulls=True).over(line))
    nums = nums.withColumn("next_opens", F.lead("opens").over(own)).withColumn("absorbed", F.col("opens") & F.coalesce(~F.col("next_opens") & ~F.col("then").isin(*DASH), F.lit(False)))
    nums = nums.filter(~F.col("by").isin(*DASH) & F.col("book").isNotNull()).withColumn("verse", F.when(~F.col("opens"), F.col("value")))
    table = F.broadcast(chapters.select("book", "chapter", "n"))
    nums = nums.join(table, ["book", "chapter"], "left").join(F.broadcast(chapters.select("book", F.col("chapter").alias("value"), F.col("n").alias("as_chapter"))), ["book", "value"], "left")
    fine = F.when(F.col("opens"), F.col("n").isNotNull() & F.coalesce(F.col("upto") > F.col("value"), F.lit(True))).otherwise(F.col("verse").between(1, F.col("n")) & F.coalesce((F.col("upto") > F.col("verse")) & (F.col("upto") <= F.col("n")), F.lit(True)))
    nums = nums.withColumn("valid", F.coalesce(fine, F.lit(False)))
    listed = (F.col("head") == "name") & (F.count("*").over(whole) > 1) & F.min((F.col("i") == 1) | (F.col("by") == ",")).over(whole) & ~F.min("valid").over(whole) & F.min(F.col("as_chapter").isNotNull() & F.col("upto").isNull() & ~F.coalesce("single", F.lit(False))).over(whole)
    nums = nums.withColumn("listed", listed).filter("listed OR NOT absorbed")
    reading = F.when(F.col("listed"), "chapters").when(F.col("opens"), "chapter").otherwise("verses")
    nums = nums.withColumn("reading", reading).withColumn("end", F.max("end").over(whole)).withColumn("n", F.row_number().over(own))
    return nums.select("doc_id", "run", "n", "start", "end", "head", "book", F.when(F.col("listed"), F.col("value")).otherwise(F.col("chapter")).alias("chapter"), F.when(~F.col("listed"), F.col("verse")).alias("verse"), "upto", "reading", (F.col("valid") | F.col("listed")).alias("valid"))


def written(rows: DataFrame) -> DataFrame:
    """doc_id, run, start, end, new: references that are valid throughout, in the one form."""
    own = Window.partitionBy("doc_id", "run").orderBy("n")
    verse = F.concat(F.col("verse").cast("string"), F.coalesce(F.concat(F.lit("–"), F.col("upto").cast("string")), F.lit("")))
    chapter = F.concat(F.col("chapter").cast("string"), F.when(F.col("verse").isNull(), F.coalesce(F.concat(F.lit("–"), F.col("upto").cast("string")), F.lit(""))).otherwise(F.lit("")))
    bare = F.col("book").isin(*ONE_CHAPTER) | (F.col("head") == "verse")
    full = F.when(F.col("verse").isNull(), chapter).when(bare, verse).otherwise(F.concat(chapter, F.lit(":"), verse))
    again = F.col("verse").isNotNull() & (F.lag("chapter").over(own) == F.col("chapter")) & F.lag("verse").over(own).isNotNull()
    joint = F.when(F.lag("chapter").over(own).isNull(), "").when(again | (F.col("reading") == "chapters"), ", ").otherwise("; ")
    rows = rows.withColumn("text", F.concat(joint, F.when(again, verse).otherwise(full)))
    runs = rows.groupBy("doc_id", "run").agg(F.first("start").alias("start"), F.first("end").alias("end"), F.first("head").alias("head"), F.first("book").alias("book"), F.min("valid").alias("valid"), F.count("*").alias("rows"), F.max("upto").alias("upto"), F.array_sort(F.collect_list(F.struct("n", "text"))).alias("own"))
    lead = F.when(F.col("head") == "name", F.concat("book", F.lit(" "))).when(F.col("head") == "chapter", "ch. ").when((F.col("rows") > 1) | F.col("upto").isNotNull(), "vv. ").otherwise("v. ")
    return runs.filter("valid").select("doc_id", "run", "start", "end", F.concat(lead, F.array_join(F.transform("own", lambda x: x["text"]), "")).alias("new"))


def restyled(documents: DataFrame, new: DataFrame) -> DataFrame:
    """doc_id, changed, text: every text with its references in the one form; changed: how many there are."""
    spans = new.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "new"))).alias("spans"))
    rows = documents.select("doc_id", "text").join(spans, "doc_id", "left")
    kept = F.transform("spans", lambda x, i: F.concat(F.substring("text", F.coalesce(F.get("spans", i - 1)["end"], F.lit(0)) + 1, x["start"] - F.coalesce(F.get("spans", i - 1)["end"], F.lit(0))), x["new"]))
    tail = F.substring("text", F.get("spans", F.size("spans") - 1)["end"] + 1, F.length("text"))
    return rows.select("doc_id", F.coalesce(F.when(F.col("spans").isNotNull(), F.size("spans")), F.lit(0)).alias("changed"), F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.concat(F.array_join(kept, ""), tail)).alias("text"))
