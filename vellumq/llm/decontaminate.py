"""Benchmark decontamination by a positional inverted index.

``build_index`` turns documents into index segments, one row for a run of documents, like
the segments of a search engine: the segment's documents, its terms and, for each term, the
ascending positions of its postings; all terms have theirs, whatever is looked up. Positions count the words of the whole segment and leave
a gap between documents, so that no phrase can cross one. A segment holds about a million
words whatever the corpus holds; nothing is shuffled, a hot source or term is spread over all
segments, and a lost executor costs its own segments only.

A phrase is found by intersecting offset-adjusted posting lists, from its rarest term (by the
frequency in the whole corpus) to its commonest: the places of the rarest, less its offset, are the first candidates, and of each further
term those stay whose place, plus the offset, is in its list. ``exact`` returns the matches; ``near`` the least spans of a document that hold
all words of a phrase, repeated ones as often, in any order, within ``slop`` more words than it has.
``contamination`` looks windows of benchmark items up, ``matches`` returns phrases and near spans with their places.

The items, and the phrases, are a stated query set. They are sent to all executors in blocks of at most about
``block_bytes`` of terms; more of them make more blocks, not a larger one, and a huge item is windows of several blocks. A block
returns rows only for documents that it hits.

Defined results: a null or empty text has no words, is not contaminated, and stays as a row;
items without words have no windows; repeated rows give repeated rows; rows with a null doc_id
are kept; the windows of an item with a null item_id count as hits, but it isn't listed among the items; empty tables give empty results; extra columns
are not read by the search and kept by ``cleaned``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumq.llm import shared, words

SEGMENT = T.StructType([
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("n_words", T.ArrayType(T.IntegerType())),
    T.StructField("terms", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.IntegerType())),
    T.StructField("positions", T.ArrayType(T.IntegerType())),
])


def tokens(text: str | None) -> list[int]:
    """Term ids of a text: signed 64-bit hashes of its words, A-Z lower-cased."""
    return words.word_hashes(pa.array([text or ""]), words.ALNUM)[0].view(np.int64).tolist()


def build_index(documents: DataFrame, segment_bytes: int = 8 << 20) -> DataFrame:
    """Index segments of documents(doc_id, text), with the postings of all terms."""

    def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.pieces(batches, "text", segment_bytes):
            found, docs, lengths, base = [], [], [], 0
            for part in words.pieces([batch], "text"):
                terms, first = words.word_hashes(part.column("text"), words.ALNUM)
                n = np.diff(first)
                at = np.arange(len(terms)) + np.repeat(np.arange(len(n)), n) + base
                base += len(terms) + len(n)
                found.append((terms.view(np.int64), at.astype(np.int32)))
                docs.append(part.column("doc_id"))
                lengths.append(n)
            terms, at = (np.concatenate(x) for x in zip(*found, strict=True))
            found.clear()
            order = np.argsort(terms, kind="stable")
            terms, at = terms[order], at[order]
            new = np.flatnonzero(np.concatenate((np.ones(min(1, len(terms)), bool), terms[1:] != terms[:-1])))
            counts = np.diff(np.append(new, len(terms)))
            rows = [pa.concat_arrays(docs).cast(pa.int64()), pa.array(np.concatenate(lengths), pa.int32()), pa.array(terms[new], pa.int64()), pa.array(counts, pa.int32()), pa.array(at, pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in rows], names=SEGMENT.names)

    return documents.select("doc_id", "text").mapInArrow(segments, SEGMENT)


class Segment:
    """A segment's postings for lookup: one ascending array of (term, position), terms by their place in a vocabulary."""

    def __init__(self, row: dict, vocabulary: np.ndarray):
        self.n_words = row["n_words"].astype(np.int64)
        self.base = np.concatenate(([0], np.cumsum(self.n_words + 1)))  # where documents begin
        terms, counts = row["terms"], row["counts"].astype(np.int64)
        known = np.flatnonzero(np.isin(terms, vocabulary)) if len(terms) else np.zeros(0, np.int64)
        starts = np.cumsum(counts) - counts
        each = counts[known]
        inner = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        number = np.searchsorted(vocabulary, terms[known])
        self.places = row["positions"][np.repeat(starts[known], each) + inner].astype(np.int64)
        self.keys = np.repeat(number, each) << 32 | self.places
        self.first = np.searchsorted(self.keys, np.arange(len(vocabulary) + 1) << 32)  # of each term's list

    def holds(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether each place is in the term's list."""
        key = term << 32 | place
        at = np.searchsorted(self.keys, key)
        return (self.keys[np.minimum(at, len(self.keys) - 1)] == key) if len(self.keys) else np.zeros(len(key), bool)

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, place, "right") - 1


class Phrases:
    """A block of phrases, each a list of term ids, laid out for lookup in segments."""

    def __init__(self, phrases: dict[tuple[int, ...], list[int]], frequency: dict[int, int]):
        """phrases: for each phrase the numbers of the items that hold it."""
        self.vocabulary = np.array(sorted({t for p in phrases for t in p}), np.int64)
        number = {t: i for i, t in enumerate(self.vocabulary.tolist())}
        keys = list(phrases)
        self.length = np.array([len(p) for p in keys], np.int64)
        self.term = np.full((len(keys), max(map(len, phrases), default=1)), -1, np.int64)  # from the rarest to the commonest
        self.shift = np.zeros(self.term.shape, np.int64)
        for i, p in enumerate(keys):
            order = sorted(range(len(p)), key=lambda j: (frequency.get(p[j], 0), j))
            self.term[i, : len(p)] = [number[p[j]] for j in order]
            self.shift[i, : len(p)] = order
        self.item_start = np.cumsum([0, *(len(phrases[p]) for p in keys)])
        self.item = np.array([x for p in keys for x in phrases[p]], np.int64)

    def items(self, phrase: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each phrase its items: (row of phrase, item)."""
        n = self.item_start[phrase + 1] - self.item_start[phrase]
        return np.repeat(np.arange(len(phrase)), n), self.item[np.repeat(self.item_start[phrase], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]

    def rarest(self, segment: Segment, block: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrase, place of its rarest term), about so many at a time."""
        n = np.diff(segment.first)[self.term[:, 0]] if len(self.length) else self.length
        live = np.flatnonzero(n)
        sums, cut = np.cumsum(n[live]), 0
        while cut < len(live):
            stop = max(cut + 1, int(np.searchsorted(sums, (sums[cut - 1] if cut else 0) + block, "right")))
            own = live[cut:stop]
            phrase = np.repeat(own, n[own])
            inner = np.arange(len(phrase)) - np.repeat(np.cumsum(n[own]) - n[own], n[own])
            for a in range(0, len(phrase), block):  # a term of more places than that comes in several
                yield phrase[a : a + block], segment.places[segment.first[self.term[phrase[a : a + block], 0]] + inner[a : a + block]]
            cut = stop

    def exact(self, segment: Segment) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrase, place of its first word) of all matches."""
        for phrase, place in self.rarest(segment):
            start = place - self.shift[phrase, 0]
            ok = start >= 0
            phrase, start = phrase[ok], start[ok]
            for j in range(1, self.term.shape[1]):
                if not len(phrase):
                    break
                ok = j >= self.length[phrase]
                more = np.flatnonzero(~ok)
                ok[more] = segment.holds(self.term[phrase[more], j], start[more] + self.shift[phrase[more], j])
                phrase, start = phrase[ok], start[ok]
            yield phrase, start

    def near(self, segment: Segment, slop: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(phrase, first and last place of each least span that holds all its words within its length and slop words)."""
        for i in range(len(self.length)):
            n = int(self.length[i])
            terms, times = np.unique(self.term[i, :n], return_counts=True)
            lists = [segment.places[segment.first[t] : segment.first[t + 1]] for t in terms]
            if any(len(x) < k for x, k in zip(lists, times.tolist(), strict=True)):
                continue
            reach = n + slop - 1
            middle = lists[int(np.flatnonzero(terms == self.term[i, 0])[0])]  # the rarest term's places with all others around
            for x in lists:
                at = np.searchsorted(x, middle - reach)
                middle = middle[(at < len(x)) & (x[np.minimum(at, len(x) - 1)] <= middle + reach)]
            if not len(middle):
                continue
            begins = [x[(at := np.searchsorted(middle, x)) < len(middle)] for x in lists]
            begins = [x[middle[np.searchsorted(middle, x)] <= x + reach] for x in begins]
            a = np.unique(np.concatenate(begins))
            b = a.copy()
            for x, k in zip(lists, times.tolist(), strict=True):
                at = np.searchsorted(x, a) + k - 1
                b = np.maximum(b, np.where(at < len(x), x[np.minimum(at, len(x) - 1)], np.iinfo(np.int64).max))
            ok = b - a <= reach
            ok[ok] = segment.document(a[ok]) == segment.document(b[ok])
            ok &= np.append(b[1:] != b[:-1], True)  # none within it
            if ok.any():
                yield i, a[ok], b[ok]


def _segment_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {k: batch.column(k)[i] for k in batch.schema.names}
            yield {"doc_ids": row["doc_ids"].values, "segment": row["segment"].as_py()} | {k: row[k].values.to_numpy(zero_copy_only=False) for k in SEGMENT.names[1:]}


def windows(texts: Iterable[tuple[object, str]], size: int, block_bytes: int) -> Iterator[tuple[dict[tuple[int, ...], list[int]], list]]:
    """Blocks of all runs of size words of the items; an item of fewer words, but not none, is one. Values: numbers of items in the block's list of ids."""
    out: dict[tuple[int, ...], list[int]] = {}
    ids: list = []
    held = 0
    for item, text in texts:
        terms = tokens(text)
        if not terms:
            continue
        ids.append(item)
        for i in range(max(1, len(terms) - size + 1)):
            own = out.setdefault(tuple(terms[i : i + size]), [])
            if not own or own[-1] != len(ids) - 1:
                own.append(len(ids) - 1)
            held += 40 * size + 120  # a window in Python, about
            if held >= block_bytes:
                yield out, ids
                out, ids, held = {}, [item], 0
    if out:
        yield out, ids


#: A segment is a row of some MB. Parquet's writer looks at its size after a hundred rows only, and a reader takes thousands of rows of a group at once; so groups are small and looked at row by row, and a task holds few segments, however many it has.
GROUPS = {"parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}


def indexed(documents: DataFrame) -> DataFrame:
    """The index as a table in the shared folder, segments numbered."""
    return shared.written(build_index(documents).withColumn("segment", F.monotonically_increasing_id()), "postings", **GROUPS)


def frequencies(index: DataFrame, vocabulary: list[int]) -> dict[int, int]:
    """Postings in the whole corpus of each term of the vocabulary that has any."""
    wanted = index.sparkSession.sparkContext.broadcast(np.array(sorted(vocabulary), np.int64))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                terms, counts = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("terms", "counts"))
                known = np.isin(terms, wanted.value)
                yield pa.RecordBatch.from_arrays([pa.array(terms[known]), pa.array(counts[known].astype(np.int64))], names=["term", "n"])

    counted = index.select("terms", "counts").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    return dict(counted.collect())  # at most a row for each term of the block


def contamination(documents: DataFrame, benchmark: DataFrame, size: int = 10, block_bytes: int = 64 << 20) -> DataFrame:
    """A row for each document: doc_id, n_words, n_hit (words inside matched windows of size words), hits (their runs), items (ids of matched items, as sorted strings)."""
    spark = documents.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    index, found = None, None
    for held, ids in windows(((r[0], r[1]) for r in items.toLocalIterator()), size, block_bytes):
        index = index or indexed(documents)
        sent = spark.sparkContext.broadcast((Phrases(held, frequencies(index, sorted({t for p in held for t in p}))), ids))

        def look(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            phrases, names = sent.value
            for row in _segment_rows(batches):
                yield _matches(phrases, names, Segment(row, phrases.vocabulary), row["segment"])

        part = index.mapInArrow(look, "segment bigint, at int, hits array<int>, items array<string>")
        found = part if found is None else found.unionByName(part)
    index = index or indexed(documents)
    whole = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("at", "x")).select("segment", "at", F.col("x.doc_ids").alias("doc_id"), F.col("x.n_words").cast("long").alias("n_words"))
    none = (F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<int>").alias("hits"), F.array().cast("array<string>").alias("items"))
    if found is None:
        return whole.select("doc_id", "n_words", *none)
    found = found.groupBy("segment", "at").agg(F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def united(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [_union(x) for x in batch.column("hits").to_pylist()]
            columns = [batch.column("segment"), batch.column("at"), pa.array([sum(x[1::2]) - sum(x[::2]) for x in hits], pa.int64()), pa.array(hits, pa.list_(pa.int32())), batch.column("items")]
            yield pa.RecordBatch.from_arrays(columns, names=["segment", "at", "n_hit", "hits", "items"])

    hit = found.mapInArrow(united, "segment bigint, at int, n_hit bigint, hits array<int>, items array<string>")
    filled = [F.coalesce(c, empty).alias(c) for c, empty in zip(("n_hit", "hits", "items"), none, strict=True)]
    return whole.join(hit.hint("merge"), ["segment", "at"], "left").select("doc_id", "n_words", *filled)


def _union(flat: list[int]) -> list[int]:
    """Runs (begin, end, begin, end, ...) in any order, as runs that don't meet."""
    out: list[int] = []
    for a, b in sorted(zip(flat[::2], flat[1::2], strict=True)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _matches(phrases: Phrases, names: list, segment: Segment, number: int) -> pa.RecordBatch:
    """Of each document with a match: the runs of hit words and the ids of matched items."""
    hits: dict[int, list[int]] = {}
    items: dict[int, set[str]] = {}
    found = list(phrases.exact(segment))
    phrase, start = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
    if len(phrase):
        change = np.zeros(int(segment.base[-1]) + 1, np.int64)
        np.add.at(change, start, 1)
        np.add.at(change, start + phrases.length[phrase], -1)
        runs = np.flatnonzero(np.diff(np.concatenate(([0], (np.cumsum(change) > 0).astype(np.int8), [0])))).reshape(-1, 2)
        for d, (a, b) in zip(segment.document(runs[:, 0]).tolist(), runs.tolist(), strict=True):
            hits.setdefault(d, []).extend((a - int(segment.base[d]), b - int(segment.base[d])))
        row, item = phrases.items(phrase)
        for d, i in np.unique(np.stack((segment.document(start)[row], item)), axis=1).T.tolist():
            if names[i] is not None:
                items.setdefault(d, set()).add(names[i])
    docs = sorted(hits)
    columns = [pa.array([number] * len(docs), pa.int64()), pa.array(docs, pa.int32()), pa.array([hits[d] for d in docs], pa.list_(pa.int32())), pa.array([sorted(items.get(d, ())) for d in docs], pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays(columns, names=["segment", "at", "hits", "items"])


def matches(documents: DataFrame, phrases: list[str], slop: int | None = None, index: DataFrame | None = None) -> DataFrame:
    """doc_id, phrase, start, end (words, end exclusive): exact matches; with slop, the least spans that hold all words of the phrase within so many more words than it has.

    The phrases are one block; each is looked up by its words, and equal ones are listed by each of their texts.
    """
    spark = documents.sparkSession
    texts = sorted(set(phrases))
    held: dict[tuple[int, ...], list[int]] = {}
    for i, text in enumerate(texts):
        if terms := tokens(text):
            held.setdefault(tuple(terms), []).append(i)
    index = index or indexed(documents)
    sent = spark.sparkContext.broadcast(Phrases(held, frequencies(index, sorted({t for p in held for t in p}))))

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for row in _segment_rows(batches):
            segment = Segment(row, own.vocabulary)
            if slop is None:
                rows = [(p, a, a + own.length[p] - 1) for p, a in own.exact(segment)]
            else:
                rows = [(np.full(len(a), i), a, b) for i, a, b in own.near(segment, slop)]
            for p, a, b in rows:
                d, (each, text) = segment.document(a), own.items(p)
                begin = (a - segment.base[d])[each]
                columns = [row["doc_ids"].take(pa.array(d[each])), pa.array(texts, pa.string()).take(pa.array(text)), pa.array(begin), pa.array(begin + (b - a)[each] + 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "phrase", "start", "end"])

    return index.mapInArrow(look, "doc_id bigint, phrase string, start bigint, end bigint")


def cleaned(documents: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The rows, with all their columns, that hold no window of the items. Rows are known by a hash of doc_id and text."""
    name = shared.unused("key", documents)
    key = F.xxhash64("doc_id", "text")
    hit = contamination(documents.select(key.alias("doc_id"), "text"), benchmark, size).filter("n_hit > 0").select(F.col("doc_id").alias(name)).distinct()
    return documents.withColumn(name, key).join(hit.hint("merge"), name, "left_anti").select(*documents.columns)


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    """Words of whole documents inside windows of 10 benchmark words. Odd rows as in the module's text."""
    found = contamination(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


#: The first words of each benchmark item are its phrase.
PHRASE_WORDS, SLOP = 4, 3


def index_matches(spark, sf_dir: str) -> DataFrame:
    """Places in documents of the first four words of each benchmark item: the phrase itself (exact), and its words in any order within seven words (near)."""
    documents, benchmark = (shared.table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    first = F.array_join(F.slice(F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1)), 1, PHRASE_WORDS), " ")
    phrases = [r[0] for r in benchmark.select(first.alias("p")).filter("p <> ''").distinct().collect()]  # the stated query set
    index = indexed(documents)
    exact = matches(documents, phrases, None, index).withColumn("kind", F.lit("exact"))
    return exact.unionByName(matches(documents, phrases, SLOP, index).withColumn("kind", F.lit("near")))


MATCHES_SQL = """
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
phrases AS (
  SELECT DISTINCT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')[1:4] AS p FROM benchmark),
asked AS (SELECT array_to_string(p, ' ') AS phrase, p, len(p) AS n FROM phrases WHERE len(p) > 0),
terms AS (SELECT phrase, n, t, count(*) AS k FROM (SELECT phrase, n, unnest(p) AS t FROM asked) GROUP BY ALL),
places AS (SELECT r, doc_id, unnest(w) AS t, generate_subscripts(w, 1) - 1 AS pos FROM words),
wanted AS (SELECT * FROM places WHERE t IN (SELECT t FROM terms)),
lists AS (SELECT r, any_value(doc_id) AS doc_id, t, list(pos ORDER BY pos) AS ats FROM wanted GROUP BY r, t),
holding AS (SELECT r, phrase FROM lists JOIN terms USING (t) WHERE len(ats) >= k GROUP BY r, phrase HAVING count(*) = (SELECT count(*) FROM terms x WHERE x.phrase = terms.phrase)),
begins AS (SELECT DISTINCT h.r, h.phrase, unnest(l.ats) AS a FROM holding h JOIN terms USING (phrase) JOIN lists l ON l.r = h.r AND l.t = terms.t),
ends AS (
  SELECT b.r, b.phrase, b.a, any_value(l.doc_id) AS doc_id, any_value(terms.n) AS n, max(list_filter(l.ats, lambda x: x >= b.a)[terms.k]) AS e, count(list_filter(l.ats, lambda x: x >= b.a)[terms.k]) AS n_some, count(*) AS n_every
  FROM begins b JOIN terms USING (phrase) JOIN lists l ON l.r = b.r AND l.t = terms.t GROUP BY ALL),
near AS (SELECT r, doc_id, phrase, max(a) AS a, e FROM ends WHERE n_some = n_every AND e - a + 1 <= n + 3 GROUP BY r, doc_id, phrase, e),
exact AS (
  SELECT words.r, words.doc_id, b.phrase, b.a, b.a + asked.n - 1 AS e FROM begins b JOIN asked USING (phrase) JOIN words ON words.r = b.r
  WHERE words.w[b.a + 1:b.a + asked.n] = asked.p)
SELECT doc_id, phrase, a AS start, e + 1 AS "end", 'near' AS kind FROM near
UNION ALL SELECT doc_id, phrase, a, e + 1, 'exact' FROM exact
"""


ORACLE_SQL = """
WITH lowered AS (
  SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
docs AS (SELECT r, doc_id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM lowered),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  , row_number() OVER () AS k FROM benchmark),
grams AS (SELECT DISTINCT item, k, w[i:i + least(10, len(w)) - 1] AS g FROM items, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(g) AS n FROM grams),
places AS (SELECT r, i, n, w[i:i + n - 1] AS g FROM docs, sizes, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n),
found AS (SELECT p.r, p.i, p.n, g.item FROM places p JOIN grams g ON p.g = g.g),
hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM found, unnest(range(i, i + n)) AS u(j) GROUP BY r),
held AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN held USING (r)
"""
