"""Scripture references: names, numbers, lookup, and one style for all."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The books, in order, and abbreviations that aren't the beginning of a name.
BOOKS = """Genesis;Exodus;Leviticus;Numbers;Deuteronomy;Joshua;Judges;Ruth;1 Samuel;2 Samuel;1 Kings;2 Kings;1 Chronicles;2 Chronicles;Ezra;Nehemiah;Esther;Job;Psalms;Proverbs;Ecclesiastes;
Song of Solomon;Isaiah;Jeremiah;Lamentations;Ezekiel;Daniel;Hosea;Joel;Amos;Obadiah;Jonah;Micah;Nahum;Habakkuk;Zephaniah;Haggai;Zechariah;Malachi;Matthew;Mark;Luke;John;Acts;Romans;
1 Corinthians;2 Corinthians;Galatians;Ephesians;Philippians;Colossians;1 Thessalonians;2 Thessalonians;1 Timothy;2 Timothy;Titus;Philemon;Hebrews;James;1 Peter;2 Peter;1 John;2 John;3 John;Jude;Revelation""".replace("\n", "").split(";")
SHORT = {"gn": "Genesis", "dt": "Deuteronomy", "jdg": "Judges", "cant": "Song of Solomon", "song of songs": "Song of Solomon", "mt": "Matthew", "mk": "Mark", "lk": "Luke", "jn": "John", "phlm": "Philemon", "phm": "Philemon", "jas": "James", "apoc": "Revelation", "ps": "Psalms", "psalm": "Psalms", "php": "Philippians", "revelations": "Revelation"}


def names() -> dict[str, str]:
    """Lower-case forms of the books' names: beginnings of three letters or more that only one book has (of Philippians and Philemon the first), the short ones, and 1 or I before numbered books."""
    out: dict[str, str] = {}
    for book in BOOKS:
        number, _, rest = book.rpartition(" ") if book[0] in "123" else ("", "", book)
        for n in range(2 if number else 3, len(rest) + 1):
            for lead in [f"{number} ", number, "i" * int(number) + " ", "i" * int(number)] if number else [""]:
                out.setdefault(f"{lead}{rest[:n]}".lower(), book)
    return out | SHORT


NAMES = names()
_NAME = "|".join(sorted(map(re.escape, NAMES), key=len, reverse=True))
REFERENCE = re.compile(rf"(?<!\w)(?P<book>{_NAME})\b\.?\s+(?P<ch>\d{{1,3}}|[ivxlc]{{1,7}})(?P<sep>[.:]\s?|\s)(?P<vs>\d{{1,3}}(?:\s?[-–]\s?\d{{1,3}})?(?:\s?,\s?\d{{1,3}}(?:\s?[-–]\s?\d{{1,3}})?)*)(?P<after>ff)?", re.I)


def value(number: str) -> int:
    from vellumq.operators.align import roman

    return int(number) if number.isdigit() else roman(number)


def verse_numbers(text: str) -> list[int]:
    out: list[int] = []
    for part in re.split(r"\s?,\s?", text):
        a, *b = map(int, re.split(r"\s?[-–]\s?", part))
        out += range(a, max(a, *b) + 1 if b else a + 1)
    return out


def found(text: str) -> Iterator[dict]:
    """References with a stop or colon between chapter and verse; with a bare space only before a stop, a comma or a note."""
    for m in REFERENCE.finditer(text):
        if m.group("sep").isspace() and not re.match(r"[.,;)]|#footnote\[", text[m.end() :]):
            continue
        if m.group("book").lower() in ("is", "am", "job") and m.group("book").islower():
            continue
        yield {"start": m.start(), "end": m.end(), "name": m.group("book"), "book": NAMES[m.group("book").lower()], "chapter": value(m.group("ch")), "verses": verse_numbers(m.group("vs")), "text": m.group()}


SCHEMA = pa.schema([("start", pa.int32()), ("end", pa.int32()), ("name", pa.string()), ("book", pa.string()), ("chapter", pa.int32()), ("verses", pa.list_(pa.int32())), ("text", pa.string())])


def references(documents: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    from vellumq.operators.markup import over_texts

    return over_texts(documents, key, column, found, SCHEMA, "start int, end int, name string, book string, chapter int, verses array<int>, text string")


def missing(refs: DataFrame, verse_count: DataFrame) -> DataFrame:
    """References whose chapter or verse isn't there; verse_count: book, chapter, n."""
    held = refs.join(verse_count.select("book", "chapter", "n"), ["book", "chapter"], "left")
    return held.filter(F.col("n").isNull() | F.exists("verses", lambda v: (v < 1) | (v > F.col("n"))))


def styles(refs: DataFrame, n: int = 25) -> DataFrame:
    return refs.groupBy("name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name").limit(n)


def weak_quotes(quotes: DataFrame, least: int = 4, share: float = 0.5) -> DataFrame:
    """Quotes (words, verse words) of ``least`` words or more of which fewer than ``share``, repeats counted, are in the verse."""
    held = F.size(F.filter("words", lambda w: F.array_contains("verse", w))) / F.size("words")
    return quotes.filter(F.size("words") >= least).withColumn("share", F.round(held, 6)).filter(F.col("share") < share)


def quoted_before(text: str, at: int) -> str | None:
    """The quotation that ends just before a place: between the last closing mark and the mark that opens it."""
    head = text[:at].rstrip(" ([,.;:—-")
    if not head or head[-1] not in "”’\"'":
        return None
    opens = {"”": "“", "’": "‘", '"': '"', "'": "'"}[head[-1]]
    begin = head.rfind(opens, 0, len(head) - 1)
    return head[begin + 1 : -1] if begin >= 0 else None


def restyled(text: str, counts: dict[tuple[str, int], int]) -> str:
    """References in the form 'Book 14:27', if the chapter has such verses."""
    out, done = [], 0
    for r in found(text):
        n = counts.get((r["book"], r["chapter"]))
        if n is None or any(not 1 <= v <= n for v in r["verses"]):
            continue
        m = REFERENCE.match(text, r["start"])
        out += [text[done : r["start"]], f"{m.group('book')} {r['chapter']}:{m.group('vs')}{m.group('after') or ''}"]
        done = r["end"]
    return "".join(out) + text[done:]


def restyle(documents: DataFrame, verse_count: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """key, text. The table of chapters is the reader's own lookup: 1,189 rows for the whole canon, checked before it is sent."""
    rows = verse_count.select("book", "chapter", "n").limit(5001).collect()
    if len(rows) > 5000:
        raise ValueError("a table of chapters has 5,000 rows at most")
    sent = documents.sparkSession.sparkContext.broadcast({(r[0], r[1]): r[2] for r in rows})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if t is None else restyled(t, sent.value) for t in batch.column(1).to_pylist()], pa.string())], names=[key, column])

    return documents.select(key, column).mapInArrow(run, f"{key} bigint, {column} string")
