"""Repeated passages by a distributed sparse suffix array.

A passage is a run of at least ``size`` words (50) that stands in two documents or more. Suffixes are retained only at
content-selected positions: of the ``size - anchor + 1`` runs of ``anchor`` words (24) in a window of ``size`` words, the one with the least
hash, the leftmost of equals. Equal windows select equal positions, so a passage always holds a retained suffix that its
other places hold too; about one suffix in fourteen words is kept.

1. ``anchors`` gives the first ``anchor`` words of each retained suffix, as a hash. ``several`` counts the documents of each, partially in each
   task, and keeps those of two or more.
2. ``suffixes`` writes, for each place that remains, the words that follow the anchor and the words before it, as far as a window that selects it
   can reach: the sparse suffix array's entry, with its left context.
3. ``compared`` receives the entries sorted by anchor, then by the words that follow: the suffix array's order. Neighbours are compared: their common
   right prefix, by its length, splits the array into the ranges of entries that may match that far; within a range the words to the
   left are extended over, a word at a time. What matches right and left in two documents or more is a match, and matches that
   go on word by word with the same partner come out as one.
4. Anchors that more than ``crowd`` documents hold would be one task's work. Their entries are compared as single windows (``lone``), counted partially in
   each task; the rows are the same.
5. ``merged`` joins the matches of a text that touch into its maximal passages.

A passage has one partner: the least other document that holds each window of it. Where that document changes, another passage
begins, so that all documents of a window are linked, each with the least one, and the least with the second.

The result is exact up to collisions of hashes (64 bits for anchors, 40 for each word of their contexts): a word is in a passage if and only if a
window of size words around it also stands in another document.

Defined results: null and empty texts, and texts of fewer words, have no passages; rows with one doc_id are one document (a passage repeated
only within it is none; equal passages of its texts are listed once); rows with a null doc_id are one document too, listed with a null;
empty tables give no rows; extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumq.llm import shared, words

NAMELESS = -(1 << 63)
_BASE = np.uint64(0xD1342543DE82EF95)
_BACK = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
_STEP = np.uint64(0xF1357AEA2E62A9C5)
#: Bytes of a word's hash in the contexts.
BYTES = 5
NO_ONE = np.iinfo(np.int64).max


def runs(own: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words."""
    n = len(own) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    powers = np.cumprod(np.full(len(own), _BASE, np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(own * powers)))
    back = np.cumprod(np.full(n, _BACK, np.uint64))
    return words.mix((sums[k:] - sums[:-k]) * back + np.uint64(k))


def selected(texts: pa.Array, size: int, anchor: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For each text its words' hashes, and for each retained place, ascending: the place, the anchor's hash, and the first and last window that selects it."""
    own, first = words.word_hashes(texts, words.SOLID)
    least = runs(own, anchor)
    span = size - anchor + 1
    place = sliding_window_view(least, span).argmin(1) if len(least) >= span else np.zeros(0, np.int64)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        at = np.arange(a, b - size + 1)
        p = at + place[at]  # never falls from one window to the next
        new = np.flatnonzero(np.concatenate((np.ones(min(1, len(p)), bool), p[1:] != p[:-1])))
        ends = np.append(new[1:], len(p)) - 1
        yield own[a:b], p[new] - a, least[p[new]], at[new] - a, at[ends[: len(new)]] - a


def texts_of(documents: DataFrame) -> DataFrame:
    """row (a text of a document), doc, text."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NAMELESS)).alias("doc")
    return documents.filter("text is not null").select(F.xxhash64("doc_id", "text").alias("row"), doc, "text")


def anchors(texts: DataFrame, size: int, anchor: int) -> DataFrame:
    """key, row, doc: distinct retained suffixes of each text."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in words.pieces(batches, "text"):
            keys = [np.unique(x[2]).view(np.int64) for x in selected(part.column("text"), size, anchor)]
            each = [len(k) for k in keys]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), *(pa.array(np.repeat(part.column(c).to_numpy(), each)) for c in ("row", "doc"))], names=["key", "row", "doc"])

    return texts.mapInArrow(emit, "key bigint, row bigint, doc bigint")


def several(rows: DataFrame) -> DataFrame:
    """key, docs: anchors of two documents or more, and of how many rows. A partial count: an anchor of a third of all rows is a row a task."""
    return rows.groupBy("key").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count("*").alias("docs")).filter("least <> most").select("key", "docs")


ENTRY = "key bigint, row bigint, doc bigint, at int, low int, high int, left binary, right binary"


def _contexts(own: np.ndarray, start: np.ndarray, length: np.ndarray, step: int) -> pa.Array:
    """For each place the hashes of so many words from there on, forwards or backwards."""
    offsets = np.concatenate(([0], np.cumsum(length)))
    inner = np.arange(offsets[-1]) - np.repeat(offsets[:-1], length)
    data = own[np.repeat(start, length) + step * inner].astype(">u8").view(np.uint8).reshape(-1, 8)[:, :BYTES]
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer((offsets * BYTES).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def suffixes(rows: DataFrame, size: int, anchor: int) -> DataFrame:
    """The entries of the suffix array: each place of a wanted anchor, the windows that select it (low to high words before it), and the words on either side; rows: row, doc, text, keys."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in words.pieces(batches, "text"):
            for i, (own, place, key, first, last) in enumerate(selected(part.column("text"), size, anchor)):
                i_keys = part.column("keys")[i].values.to_numpy()
                at = np.flatnonzero(np.isin(key.view(np.int64), i_keys))
                if not len(at):
                    continue
                p, low, high = place[at], place[at] - last[at], place[at] - first[at]
                left, right = _contexts(own, p - 1, high, -1), _contexts(own, p + anchor, size - anchor - low, 1)
                each = [pa.array(np.full(len(at), part.column(c)[i].as_py(), np.int64)) for c in ("row", "doc")]
                yield pa.RecordBatch.from_arrays([pa.array(key[at].view(np.int64)), *each, *(pa.array(x.astype(np.int32)) for x in (p, low, high)), left, right], names=["key", "row", "doc", "at", "low", "high", "left", "right"])

    return rows.mapInArrow(emit, ENTRY)


MATCH = "row bigint, doc bigint, first int, last int, other bigint"


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of a column of contexts, a row each, and their numbers."""
    column = column.cast(pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].reshape(-1, BYTES)
    wide = np.zeros((len(data), 8), np.uint8)
    wide[:, :BYTES] = data
    each = np.diff(offsets) // BYTES
    out = np.zeros((n, width), np.uint64)
    out[np.arange(width) < each[:, None]] = wide.view(">u8").ravel()
    return out, each


def _partners(group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each row the least other document of its group, NO_ONE if there is none."""
    order = np.lexsort((doc, group))
    g, d = group[order], doc[order]
    new = np.concatenate((np.ones(min(1, len(g)), bool), g[1:] != g[:-1]))
    first = np.flatnonzero(new)
    number = np.cumsum(new) - 1
    least = d[first][number]
    later = np.where(d != least, d, NO_ONE)
    second = np.minimum.reduceat(later, first)[number] if len(first) else later
    out = np.empty(len(g), np.int64)
    out[order] = np.where(d != least, least, second)
    return out


def matches(key: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray, left: np.ndarray, right: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """For each entry and each number of words before the anchor: the least other document with the same window, or NO_ONE. Entries come sorted by key and right."""
    width = left.shape[1]
    out = np.full((len(key), width + 1), NO_ONE)
    same = (right[1:] == right[:-1]) & (np.arange(width) < np.minimum(reach[1:], reach[:-1])[:, None])
    common = np.where(key[1:] == key[:-1], np.logical_and.accumulate(same, axis=1).sum(1), -1)  # neighbours' common prefix beyond the anchor
    behind = words.mix(key.view(np.uint64))  # what the words to the left are, so far
    for w in range(width + 1):
        if w:
            behind = words.mix(behind * _STEP + left[:, w - 1])
        own = np.flatnonzero((low <= w) & (w <= high))
        if len(own) > 1:
            range_ = np.concatenate(([0], np.cumsum(common < width - w)))  # a new range where the prefix is too short
            out[own, w] = _partners(words.mix(behind[own] + words.mix(range_[own].astype(np.uint64))), doc[own])
    return out


def _rows(entry: dict[str, np.ndarray], found: np.ndarray) -> pa.RecordBatch:
    """Matches of neighbouring windows with one partner as one."""
    some = found != NO_ONE
    i, w = np.nonzero(some[:, ::-1])  # by entry, the first window first
    w = found.shape[1] - 1 - w
    other, at = found[i, w], entry["at"][i] - w
    new = np.concatenate((np.ones(min(1, len(i)), bool), (i[1:] != i[:-1]) | (at[1:] != at[:-1] + 1) | (other[1:] != other[:-1])))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(i)) - 1 if len(first) else first
    rows = i[first]
    return pa.RecordBatch.from_arrays([pa.array(entry["row"][rows]), pa.array(entry["doc"][rows]), pa.array(at[first].astype(np.int32)), pa.array(at[last].astype(np.int32)), pa.array(other[first])], names=["row", "doc", "first", "last", "other"])


def compared(entries: DataFrame, size: int, anchor: int) -> DataFrame:
    """row, doc, first, last, other: windows first to last of a text, whose least other document is other. An anchor's entries are held together; there are at most those of ``crowd`` texts."""
    width = size - anchor

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(part: pa.Table) -> pa.RecordBatch:
            entry = {c: part.column(c).to_numpy() for c in ("key", "row", "doc", "at", "low", "high")}
            left, _ = _matrix(part.column("left").combine_chunks(), width)
            right, reach = _matrix(part.column("right").combine_chunks(), width)
            return _rows(entry, matches(entry["key"], entry["doc"], entry["low"], entry["high"], left, right, reach))

        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))  # the last key may go on
            if cut or held and held[-1].column("key")[-1].as_py() != key[-1]:
                yield out(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield out(pa.Table.from_batches(held))

    return entries.repartition("key").sortWithinPartitions("key", "right").mapInArrow(compare, MATCH)


def lone(rows: DataFrame, size: int, anchor: int) -> DataFrame:
    """The same rows for the anchors of crowds: each window by its hash, least and second document by partial counts; rows: row, doc, text, keys."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in words.pieces(batches, "text"):
            for i, (own, _, key, first, last) in enumerate(selected(part.column("text"), size, anchor)):
                at = np.flatnonzero(np.isin(key.view(np.int64), part.column("keys")[i].values.to_numpy()))
                each = last[at] - first[at] + 1
                place = np.repeat(first[at], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                whole = runs(own, size)[place].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(whole), *(pa.array(np.full(len(place), part.column(c)[i].as_py(), np.int64)) for c in ("row", "doc")), pa.array(place.astype(np.int32))], names=["window", "row", "doc", "first"])

    found = shared.written(rows.mapInArrow(emit, "window bigint, row bigint, doc bigint, first int"), "windows")
    # a table by itself, so that the join's skewed side is a shuffle that Spark can split
    least = shared.written(two_least(found.select("window", "doc")), "least")
    other = F.when(F.col("doc") == F.col("least"), F.col("second")).otherwise(F.col("least"))
    return found.join(least.hint("merge"), "window").select("row", "doc", "first", F.col("first").alias("last"), other.alias("other"))


def _two_least(window: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each window the rows of its two least documents, in order."""
    order = np.lexsort((doc, window))
    window, doc = window[order], doc[order]
    fresh = np.concatenate((np.ones(min(1, len(window)), bool), (window[1:] != window[:-1]) | (doc[1:] != doc[:-1])))
    window, doc = window[fresh], doc[fresh]
    keep = np.ones(len(window), bool)
    keep[2:] = window[2:] != window[:-2]
    return window[keep], doc[keep]


def two_least(rows: DataFrame) -> DataFrame:
    """window, least, second: of windows of two documents or more the two least. A batch sends two rows of a window at most."""

    def few(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _two_least(*(c.to_numpy() for c in batch.columns))], names=["window", "doc"])

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in _and_end(batches):
            window, doc = _two_least(*(np.concatenate((h, c)) for h, c in zip(held, batch, strict=True)))
            end = len(window) if not len(batch[0]) else int(np.searchsorted(window, window[-1])) if len(window) else 0  # the last window may go on
            pair = np.flatnonzero(window[1:end] == window[: max(0, end - 1)])
            yield pa.RecordBatch.from_arrays([pa.array(window[pair]), pa.array(doc[pair]), pa.array(doc[pair + 1])], names=["window", "least", "second"])
            held = (window[end:], doc[end:])

    small = rows.mapInArrow(few, "window bigint, doc bigint")
    return small.repartition("window").sortWithinPartitions("window", "doc").mapInArrow(pick, "window bigint, least bigint, second bigint")


def _and_end(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of all batches that have rows, then empty ones."""
    for batch in batches:
        if batch.num_rows:
            yield tuple(c.to_numpy() for c in batch.columns)
    yield (np.zeros(0, np.int64), np.zeros(0, np.int64))


def merged(rows: DataFrame, size: int) -> DataFrame:
    """doc, start, end, other: matches of a text with one partner that follow each other become one passage; rows stream."""

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            row, doc, first, last, other = (c.to_numpy() for c in batch.columns)
            if held is not None:
                row, doc, first, last, other = (np.concatenate(([h], x)) for h, x in zip(held, (row, doc, first, last, other), strict=True))
            if not len(row):
                continue
            # matches of one text and partner come in order and don't overlap, but for repeated rows, which are equal
            new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (other[1:] != other[:-1]) | (first[1:] > last[:-1] + 1))))
            ends = np.maximum.reduceat(last, new)
            held = (row[new[-1]], doc[new[-1]], first[new[-1]], ends[-1], other[new[-1]])
            yield _passages(doc[new[:-1]], first[new[:-1]], ends[:-1], other[new[:-1]], size)
        if held is not None:
            yield _passages(*(np.array([x]) for x in held[1:]), size)

    return rows.repartition("row").sortWithinPartitions("row", "other", "first").mapInArrow(merge, "doc bigint, start bigint, end bigint, other bigint")


def _passages(doc: np.ndarray, first: np.ndarray, last: np.ndarray, other: np.ndarray, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (doc, first, last.astype(np.int64) + size, other)], names=["doc", "start", "end", "other"])


def passages(documents: DataFrame, size: int = 50, anchor: int = 24, crowd: int = 4096) -> DataFrame:
    """doc_id, start, end (words of the document, end exclusive), n_words, other_id (the least other document that holds each window of it)."""
    if not 0 < anchor <= size:
        raise ValueError("an anchor has 1 to size words")
    texts = texts_of(documents)
    rows = shared.written(anchors(texts, size, anchor), "anchors")
    common = shared.written(several(rows), "several")
    kept = shared.written(rows.join(common.hint("merge"), "key").select("key", "row", "docs"), "suffixes")

    def held(wanted: str) -> DataFrame:
        keys = kept.filter(wanted).groupBy("row").agg(F.collect_set("key").alias("keys"))  # of one text each
        return texts.join(keys.hint("merge"), "row").select("row", "doc", "text", "keys")

    found = compared(suffixes(held(f"docs <= {crowd}"), size, anchor), size, anchor)
    if not kept.filter(f"docs > {crowd}").isEmpty():
        found = found.unionByName(lone(held(f"docs > {crowd}"), size, anchor))

    def name(column: str):
        return F.when(F.col(column) != NAMELESS, F.col(column))

    out = merged(found, size)
    return out.select(name("doc").alias("doc_id"), "start", "end", (F.col("end") - F.col("start")).alias("n_words"), name("other").alias("other_id")).distinct()


def op3_repeated_passages(spark, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more of whole documents that stand in several of them, a row for each passage and partner. Odd rows as in the module's text."""
    return passages(shared.table(spark, sf_dir, "documents"))


ORACLE_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
places AS (SELECT r, doc_id, i - 1 AS p, md5(array_to_string(w[i:i + 49], ' ')) AS g FROM docs, unnest(range(1, len(w) - 48)) AS u(i) WHERE len(w) >= 50),
ends AS (SELECT g, min(doc_id) AS least FROM places GROUP BY g HAVING min(doc_id) <> max(doc_id)),
seconds AS (SELECT g, min(doc_id) AS second FROM places JOIN ends USING (g) WHERE doc_id <> least GROUP BY g),
hits AS (SELECT r, doc_id, p, CASE WHEN doc_id = least THEN second ELSE least END AS other FROM places JOIN ends USING (g) JOIN seconds USING (g)),
islands AS (SELECT *, p - row_number() OVER (PARTITION BY r, other ORDER BY p) AS island FROM hits)
SELECT DISTINCT doc_id, min(p) AS start, max(p) + 50 AS "end", max(p) + 50 - min(p) AS n_words, other AS other_id FROM islands GROUP BY r, doc_id, other, island
"""
