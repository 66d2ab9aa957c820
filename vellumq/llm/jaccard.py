"""Jaccard join of shingle sets by prefix trees.

Documents link when 100 * intersection >= percent * union of their sets of k-word shingles.
The result is each document's class: the component of the links, named by its least doc_id.

1. ``described`` gives each document the size and a digest of its set. Equal sets are one node
   from here on, however many copies there are.
2. A set that links has at most n - percent/100 * n shingles that no other set has (``spare``). ``thinned`` gives the
   shingles with the least hashes, twice as many as may be alone; a set of which fewer than ``met`` are among those of other sets goes.
   This loses no link, and few sets are left. Shingles are compared within each task first, so that one of a third of all documents is a row a task.
3. ``common`` gives of the sets that are left all shingles that several hold, with the number of holders: the global
   order, in which sets are stored and filtered, is from the rarest to the commonest, then by hash. ``ordered`` puts each set in that order; sets with too many lone shingles go.
4. Two sets that link share one of their first spare + 1 shingles in that order. Sets under one such shingle are
   chained in the order of their sizes, not paired (``chained``); components of these chains hold all links.
5. ``Tree`` stores the sets of a component in a prefix tree with compressed paths, in one order for the whole group: within it from the commonest
   shingle to the rarest, so that near copies share long paths. A set traverses it once: nodes share the
   partial overlap, a subtree goes when the overlap so far plus what can remain on either side is too little, and when all below
   is already in the set's class. Only spanning links leave the task.
6. A component of more than ``block`` shingles is split into blocks by digest; ``tied`` of its members stand in all of them, so that
   the blocks' classes meet. Members outside the largest class found then traverse the trees of all other blocks: a pair within the
   largest class needs no more links, and every other pair is compared.

Rows of one shingle stream through a task in order, with a bounded number held back, so that a shingle of a third of all documents needs no memory.

Defined results: empty or null texts have n_shingles 0 and their own doc_id as class; repeated rows give
repeated rows; a null doc_id is never a name if the class has another; empty tables give no rows; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumq.llm import shared, words
from vellumq.llm.components import components


def _digest(own: np.ndarray) -> int:
    total = words.mix(own).sum(dtype=np.uint64) + np.uint64(len(own))
    return int(words.mix(np.array([total]))[0].view(np.int64))


def described(documents: DataFrame, k: int) -> DataFrame:
    """doc_id, hash (of the text), n (size of the set), digest (null of an empty set) of each row."""

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in words.pieces(batches, "text"):
            sets = list(words.shingle_sets(part.column("text"), k))
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), part.column("hash"), pa.array([len(x) for x in sets], pa.int64()), pa.array([_digest(x) if len(x) else None for x in sets], pa.int64())], names=["doc_id", "hash", "n", "digest"])

    return documents.select("doc_id", F.xxhash64("text").alias("hash"), "text").mapInArrow(describe, "doc_id bigint, hash bigint, n bigint, digest bigint")


def spare(n: int, percent: int) -> int:
    """Most shingles of a set of n that a linked set lacks."""
    return n - (percent * n + 99) // 100


def drawn(n: int, percent: int) -> int:
    """How many of n shingles are looked at first."""
    return min(n, max(spare(n, percent) + 1, (2 * (100 - percent) * n + 99) // 100))


def met(n: int, percent: int) -> int:
    """Fewest drawn shingles of a set of n that a linked set has drawn too.

    Let a set of n lack b shingles of a linked set of m, which lacks a of its own: the first drawn(n) - a shingles that both hold are drawn by
    the one, the first drawn(m) - b by the other. The former are drawn(n) - spare(n) at least; the latter may be one less, by rounding,
    as b pushes out what both hold: with q = 1 - percent / 100 of 1/2 at most, b is at most q * union - a, and drawn(m) - b at least q * n.
    With more, all shingles are drawn.
    """
    return max(1, drawn(n, percent) - spare(n, percent) - 1)


def _spare_column(percent: int):
    return F.col("n") - F.expr(f"({percent} * n + 99) div 100")


def _drawn_column(percent: int):
    return F.least("n", F.greatest(_spare_column(percent) + 1, F.expr(f"({2 * (100 - percent)} * n + 99) div 100")))


def _met_column(percent: int):
    return F.greatest(F.lit(1), _drawn_column(percent) - _spare_column(percent) - 1)


ROWS = "shingle bigint, digest bigint, n int"


def _emitted(texts: Iterable[pa.RecordBatch], k: int, take, wanted: str | None = None) -> Iterator[pa.RecordBatch]:
    for part in words.pieces(texts, "text"):
        found, of, size, seen = [], [], [], set()
        wants = part.column(wanted).to_pylist() if wanted else [None] * part.num_rows
        for own, want in zip(words.shingle_sets(part.column("text"), k), wants, strict=True):
            if not len(own) or (digest := _digest(own)) in seen or want not in (None, digest):
                continue
            seen.add(digest)
            found.append(own[: take(len(own))])
            of.append(digest)
            size.append(len(own))
        if found:
            each = [len(x) for x in found]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.repeat(np.array(of, np.int64), each)), pa.array(np.repeat(np.array(size, np.int32), each))], names=["shingle", "digest", "n"])


SIEVED = "shingle bigint, digest bigint, n int, several int"


def thinned(documents: DataFrame, k: int, percent: int, together: int = 1 << 20) -> DataFrame:
    """Of each set the shingles with the least hashes, compared within the task first, about ``together`` rows at once.

    A shingle that one set of these holds is a row (shingle, digest, n, 0). One that several hold is known to be shared: it is one row, with several -1, however many
    hold it, and each of these sets has a row with the number of its shingles so known, under a shingle of its own.
    """

    def thin(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out() -> pa.RecordBatch:
            shingle, digest, n = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in range(3))
            order = np.lexsort((digest, shingle))
            shingle, digest, n = shingle[order], digest[order], n[order]
            fresh = np.concatenate(([True], (shingle[1:] != shingle[:-1]) | (digest[1:] != digest[:-1])))  # copies count once
            shingle, digest, n = shingle[fresh], digest[fresh], n[fresh]
            first = np.flatnonzero(np.concatenate(([True], shingle[1:] != shingle[:-1])))
            each = np.diff(np.append(first, len(shingle)))
            many = np.repeat(each > 1, each)
            known, at, times = np.unique(digest[many], return_index=True, return_counts=True)
            shared_once = shingle[first[each > 1]]
            lone = np.flatnonzero(~many)
            lone = lone[np.argsort(digest[lone], kind="stable")]  # rows of one set together are sent in fewer bytes
            columns = (
                np.concatenate((shingle[lone], shared_once, words.mix(known.view(np.uint64)).view(np.int64))),
                np.concatenate((digest[lone], np.zeros(len(shared_once), np.int64), known)),
                np.concatenate((n[lone], np.zeros(len(shared_once), np.int32), n[many][at])),
                np.concatenate((np.zeros(len(lone), np.int32), np.full(len(shared_once), -1, np.int32), times.astype(np.int32))),
            )
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shingle", "digest", "n", "several"])

        for batch in _emitted(batches, k, lambda n: drawn(n, percent)):
            held.append(batch)
            if sum(b.num_rows for b in held) >= together:
                yield out()
        if held:
            yield out()

    return documents.select("text").mapInArrow(thin, SIEVED)


def counted(rows: DataFrame) -> DataFrame:
    """digest, n, several: of each set how many of its drawn shingles other sets hold, or more where copies of it were counted in several tasks; rows: those of thinned()."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)]

        def out(columns: list[np.ndarray]) -> pa.RecordBatch:
            shingle, digest, n, several = columns
            told = several > 0
            rest = np.flatnonzero(~told)
            shingle, own, flag = shingle[rest], digest[rest], several[rest]
            fresh = np.concatenate((np.ones(min(1, len(rest)), bool), (shingle[1:] != shingle[:-1]) | (own[1:] != own[:-1]) | (flag[1:] != flag[:-1])))
            rest, shingle, flag = rest[fresh], shingle[fresh], flag[fresh]
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(rest)), bool), shingle[1:] != shingle[:-1])))
            each = np.diff(np.append(first, len(rest)))
            common = (each > 1) | (np.minimum.reduceat(flag, first) < 0 if len(first) else each > 1)
            met_now = rest[np.repeat(common, each) & (flag == 0)]
            keep = np.concatenate((np.flatnonzero(told), met_now))
            return pa.RecordBatch.from_arrays([pa.array(digest[keep]), pa.array(n[keep]), pa.array(np.maximum(several[keep], 1))], names=["digest", "n", "several"])

        for batch in batches:
            rows = [np.concatenate((h, c.to_numpy())) for h, c in zip(held, batch.columns, strict=True)]
            if not len(rows[0]):
                continue
            last = int(np.searchsorted(rows[0], rows[0][-1]))  # the last shingle may go on: at most a few rows of each task that sent any
            yield out([x[:last] for x in rows])
            held = [x[last:] for x in rows]
        if len(held[0]):
            yield out(held)

    met_rows = rows.repartition("shingle").sortWithinPartitions("shingle", "digest", "several").mapInArrow(compare, "digest bigint, n int, several int")
    return met_rows.groupBy("digest", "n").agg(F.sum("several").alias("several"))


def whole(texts: DataFrame, k: int) -> DataFrame:
    """shingle, digest, n of all shingles of the texts whose set has the wanted digest; texts: text, digest."""
    return texts.select("text", "digest").mapInArrow(lambda batches: _emitted(batches, k, lambda n: n, "digest"), ROWS)


def common(rows: DataFrame, most: int = 1024) -> DataFrame:
    """shingle, digest, n, holders (at most ``most``) of the shingles that several sets hold."""

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
        told = None  # a shingle of ``most`` holders or more, some of whose rows are out, and the last of these holders
        for batch in batches:
            shingle, digest, n = (np.concatenate((h, c.to_numpy())) for h, c in zip(held, batch.columns, strict=True))
            fresh = np.ones(len(shingle), bool)  # equal rows, of copies, count once
            fresh[1:] = (shingle[1:] != shingle[:-1]) | (digest[1:] != digest[:-1])
            if told and len(shingle) and (shingle[0], digest[0]) == told:
                fresh[0] = False
            shingle, digest, n = shingle[fresh], digest[fresh], n[fresh]
            new = np.concatenate((np.ones(min(1, len(shingle)), bool), shingle[1:] != shingle[:-1]))
            first = np.flatnonzero(new)
            holders = np.minimum(np.diff(np.append(first, len(shingle))), most)
            if told and len(shingle) and shingle[0] == told[0]:
                holders[0] = most
            end = len(shingle)
            if len(first) and holders[-1] < most:  # may go on: held back
                end = first[-1]
            if len(shingle) and end == len(shingle):
                told = (shingle[-1], digest[-1])
            out = np.repeat(holders, np.diff(np.append(first, len(shingle))))[:end]
            several = np.flatnonzero(out > 1)
            yield pa.RecordBatch.from_arrays([pa.array(shingle[several]), pa.array(digest[several]), pa.array(n[several]), pa.array(out[several].astype(np.int32))], names=["shingle", "digest", "n", "holders"])
            held = [shingle[end:], digest[end:], n[end:]]
        shingle = held[0]
        if len(shingle) > 1:  # one shingle, of several sets
            yield pa.RecordBatch.from_arrays([*map(pa.array, held), pa.array(np.full(len(shingle), len(shingle), np.int32))], names=["shingle", "digest", "n", "holders"])

    return rows.repartition("shingle").sortWithinPartitions("shingle", "digest").mapInArrow(keep, ROWS + ", holders int")


def ordered(rows: DataFrame, percent: int) -> DataFrame:
    """digest, n, shingles: each set's shared shingles in the global order, sets with too many lone ones left out."""

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)]

        def out(columns: list[np.ndarray]) -> pa.RecordBatch:
            digest, n, shingle = columns
            first = np.flatnonzero(np.concatenate(([True], digest[1:] != digest[:-1])))
            each = np.diff(np.append(first, len(digest)))
            size = n[first].astype(np.int64)
            ok = size - each <= size - (percent * size + 99) // 100
            sets = pa.ListArray.from_arrays(pa.array(np.append(first, len(digest)).astype(np.int32)), pa.array(shingle))
            return pa.RecordBatch.from_arrays([pa.array(digest[first]), pa.array(n[first]), sets], names=["digest", "n", "shingles"]).filter(pa.array(ok))

        for batch in batches:
            rows = [np.concatenate((h, batch.column(c).to_numpy())) for h, c in zip(held, ("digest", "n", "shingle"), strict=True)]
            if not len(rows[0]):
                continue
            last = int(np.searchsorted(rows[0], rows[0][-1]))  # ascending: the last set may go on
            if last:
                yield out([x[:last] for x in rows])
            held = [x[last:] for x in rows]
        if len(held[0]):
            yield out(held)

    return rows.repartition("digest").sortWithinPartitions("digest", "holders", "shingle").mapInArrow(put, "digest bigint, n int, shingles array<bigint>")


def chained(sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between sets that follow each other, by size, under one of their first shingles and whose sizes may link."""
    first = F.slice("shingles", 1, (_spare_column(percent) + 1 - (F.col("n") - F.size("shingles"))).cast("int"))
    rows = sets.select(F.explode(first).alias("shingle"), F.col("n").cast("int").alias("n"), "digest")

    def chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            shingle, n, digest = (np.concatenate((x, c.to_numpy().astype(np.int64))) for x, c in zip(last, batch.columns, strict=True))
            link = (shingle[1:] == shingle[:-1]) & (100 * n[:-1] >= percent * n[1:])
            pairs = np.unique(np.stack((np.minimum(digest[1:], digest[:-1])[link], np.maximum(digest[1:], digest[:-1])[link])), axis=1)
            last = (shingle[-1:], n[-1:], digest[-1:])
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return rows.repartition("shingle").sortWithinPartitions("shingle", "n", "digest").mapInArrow(chain, "a bigint, b bigint")


class Node:
    __slots__ = ("segment", "kids", "least", "longest", "depth", "ends", "member", "mixed")

    def __init__(self, segment: np.ndarray, depth: int, least: int, longest: int, member: int):
        self.segment, self.depth = segment, depth  # depth: shingles from the root to the segment's end
        self.kids: dict[int, Node] = {}
        self.least, self.longest = least, longest  # least size, and most stored shingles, of the sets below
        self.ends: list[int] = []
        self.member, self.mixed = member, False


class Tree:
    """A prefix tree of ordered sets, and the classes of the members it has linked so far. Stored sets lack shingles that nobody shares; sizes count these."""

    def __init__(self, percent: int):
        self.percent = percent
        self.root: Node | None = None
        self.size: dict[int, int] = {}
        self.parent: dict[int, int] = {}

    def top(self, x: int) -> int:
        while (up := self.parent.setdefault(x, x)) != x:
            self.parent[x] = x = self.parent[up]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.top(a), self.top(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def need(self, n: int, m: int) -> int:
        """Least intersection of linked sets of these sizes."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def add(self, own: np.ndarray, size: int, member: int) -> None:
        n, self.size[member] = len(own), size
        if self.root is None:
            self.root = Node(own[:0], 0, size, n, member)
        node, at = self.root, 0
        while True:
            node.least, node.longest = min(node.least, size), max(node.longest, n)
            node.mixed = node.mixed or self.top(node.member) != self.top(member)
            if at == n:
                node.ends.append(member)
                return
            kid = node.kids.get(int(own[at]))
            if kid is None:
                leaf = node.kids[int(own[at])] = Node(own[at:], n, size, n, member)
                leaf.ends.append(member)
                return
            ahead = own[at : at + len(kid.segment)]
            differ = np.flatnonzero(ahead != kid.segment[: len(ahead)])
            same = int(differ[0]) if len(differ) else len(ahead)
            if same < len(kid.segment):  # the path forks, or ends, within the segment
                fork = Node(kid.segment[:same], kid.depth - len(kid.segment) + same, kid.least, kid.longest, kid.member)
                fork.mixed = kid.mixed
                kid.segment = kid.segment[same:]
                fork.kids[int(kid.segment[0])] = kid
                node.kids[int(fork.segment[0])] = fork
                kid = fork
            node, at = kid, at + same

    def probe(self, own: np.ndarray, size: int, member: int) -> list[tuple[int, int]]:
        """Links of the set with members of other classes, as many as connect it to each such class; joins them."""
        links: list[tuple[int, int]] = []
        n = len(own)
        stack: list[tuple[Node, int]] = [(self.root, 0)] if self.root else []
        while stack:
            node, overlap = stack.pop()
            if not node.mixed and self.top(node.member) == self.top(member):
                continue
            if len(node.segment):
                at = np.searchsorted(own, node.segment)
                overlap += int(np.count_nonzero(own[np.minimum(at, n - 1)] == node.segment))
                left = n - int(np.searchsorted(own, node.segment[-1], "right"))
                if overlap + min(left, node.longest - node.depth) < self.need(size, node.least):
                    continue
            for other in node.ends:
                if overlap >= self.need(size, self.size[other]) and self.top(other) != self.top(member):
                    links.append((member, other))
                    self.join(member, other)
            if node.kids:
                kids = list(node.kids.items())
                if len(kids) > 1:  # those that go on with a shingle of the set come first
                    firsts = np.array([k for k, _ in kids], own.dtype)
                    shared_first = own[np.minimum(np.searchsorted(own, firsts), n - 1)] == firsts
                    kids = [kids[i] for i in np.argsort(shared_first, kind="stable")]
                stack.extend((kid, overlap) for _, kid in kids)
        return links


def _joined(sets: list[np.ndarray], sizes: list[int], digests: list[int], base: list[bool], known: list[int], percent: int, met: bool) -> list[tuple[int, int]]:
    """Spanning links of a group. Members that aren't base only traverse; known: what is known to be connected; met: base members were compared before, and are only stored."""
    every = np.concatenate(sets)
    kinds, inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
    rank = np.empty(len(kinds), np.int64)
    rank[np.lexsort((kinds, -counts))] = np.arange(len(kinds))  # within a group the commonest first: near copies share long paths
    ranked = np.split(rank[inverse], np.cumsum([len(x) for x in sets])[:-1])
    tree, links = Tree(percent), []
    for d, c in zip(digests, known, strict=True):
        tree.join(d, c)
    for i in sorted(range(len(sets)), key=lambda i: (not base[i], sizes[i], digests[i])):
        own = np.sort(ranked[i])
        if not (met and base[i]):
            links += tree.probe(own, sizes[i], digests[i])
        if base[i]:
            tree.add(own, sizes[i], digests[i])
    return links


def linked(rows: DataFrame, percent: int, met: bool = False) -> DataFrame:
    """Links (a, b) within each group; rows: part, digest, n, shingles, base, class."""

    def link(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        now = None

        def out() -> pa.RecordBatch:
            sets, sizes, digests, base, known = map(list, zip(*group, strict=True))
            found = _joined(sets, sizes, digests, base, known, percent, met) if len(sets) > 1 and not (met and all(base)) else []
            return pa.RecordBatch.from_arrays([pa.array([min(x) for x in found], pa.int64()), pa.array([max(x) for x in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            sets = batch.column("shingles")
            for i, (key, *rest) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("part", "n", "digest", "base", "class")), strict=True)):
                if key != now:
                    if group:
                        yield out()
                    group, now = [], key
                group.append((sets[i].values.to_numpy(), *rest))
        if group:
            yield out()

    return rows.select("part", "digest", "n", "shingles", "base", "class").repartition("part").sortWithinPartitions("part").mapInArrow(link, "a bigint, b bigint")


def classes(documents: DataFrame, k: int = 5, percent: int = 80, block: int = 1 << 18, tied: int = 16) -> DataFrame:
    """doc_id, hash of the text, n_shingles, digest of the set, class (a digest), component_id (its least doc_id) of each row."""
    documents = documents.select("doc_id", "text")
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("key")
    rows = shared.written(described(documents, k), "sets")
    nodes = rows.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    left = counted(thinned(documents, k, percent)).filter(F.col("several") >= _met_column(percent)).select("digest")
    left = shared.written(nodes.join(left, "digest").select(key, "digest"), "left")
    # the same join at every size: a broadcast of what is left would have no bound
    texts = documents.select(key, "text").join(left.hint("merge"), "key")
    sets = shared.written(ordered(common(whole(texts, k)), percent), "ordered")
    near = components(chained(sets, percent), "near").withColumnRenamed("node", "digest")
    # who goes where is settled without the sets; they are moved once for the join and once to their part
    placed = near.join(sets.select("digest", F.size("shingles").alias("size")), "digest")
    weight = placed.groupBy("component").agg(F.ceil(F.sum("size") / block).cast("int").alias("blocks"))
    members = placed.join(weight, "component").select("digest", "component", "blocks", F.pmod(F.xxhash64("digest", F.lit(7)), F.col("blocks")).cast("int").alias("block"))
    members = shared.written(members, "members")
    of = F.xxhash64("component", "block").alias("part")

    def held(rows: DataFrame) -> DataFrame:
        return sets.join(rows.hint("merge"), "digest")

    large = members.filter("blocks > 1")
    split = not large.isEmpty()
    first = members.select("digest", of, F.lit(True).alias("base"), F.col("digest").alias("class"))
    if split:  # a few members stand in every block of their component, and tie the classes of its blocks together
        order = Window.partitionBy("component").orderBy(F.xxhash64("digest", F.lit(9)), "digest")
        ties = large.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= tied).withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("to <> block")
        first = first.unionByName(ties.select("digest", F.xxhash64("component", "to").alias("part"), F.lit(True).alias("base"), F.col("digest").alias("class")))
    links = shared.written(linked(held(first), percent), "links")
    if split:
        inside = components(links, "inside").withColumnRenamed("node", "digest").withColumnRenamed("component", "class")
        large = shared.written(large.join(inside, "digest", "left").withColumn("class", F.coalesce("class", "digest")), "large")
        top = large.groupBy("component", "class").count().groupBy("component").agg(F.max_by("class", F.struct("count", "class")).alias("top"))
        other = large.join(top, "component").filter("class <> top").withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        across = large.select("digest", of, F.lit(True).alias("base"), "class").unionByName(other.filter("to <> block").select("digest", F.xxhash64("component", "to").alias("part"), F.lit(False).alias("base"), "class"))
        links = links.unionByName(linked(held(across), percent, met=True))
    joined = components(links, "joined").withColumnRenamed("node", "digest")
    nodes = nodes.join(joined, "digest", "left").withColumn("class", F.coalesce("component", "digest"))
    named = nodes.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    named = nodes.join(named, "class").select("digest", "class", "component_id")
    name = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    return rows.join(named, "digest", "left").select("doc_id", "hash", F.col("n").alias("n_shingles"), "digest", "class", name)


def deduplicated(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows, with all their columns, without near copies: of each class the row with the least doc_id (nulls last), then the least hash of the text, stays.

    Texts without shingles are linked with nothing and stay.
    """
    k_, h_, m_ = (shared.unused(x, documents) for x in ("key", "hash", "mark"))
    key = F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1)).alias(k_)
    each = classes(documents, k, percent).filter("class is not null").groupBy("class", key, F.col("hash").alias(h_)).agg(F.count("*").alias("n"))
    order = F.struct(k_, h_)
    first = each.groupBy("class").agg(F.min(order).alias("first"))
    mark = F.when(F.col("first") != order, "drop").when(F.col("n") > 1, "once")
    marks = shared.written(each.join(first, "class").select(k_, h_, mark.alias(m_)).filter(F.col(m_).isNotNull()), "marks")
    rows = documents.select("*", key, F.xxhash64("text").alias(h_)).join(marks.hint("merge"), [k_, h_], "left")
    once = rows.filter(F.col(m_) == "once").dropDuplicates([k_, h_])
    return rows.filter(F.col(m_).isNull()).unionByName(once).select(*documents.columns)


def op8_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Classes of whole documents whose 3-word shingles agree by 90 % or more. Odd rows as in the module's text."""
    return classes(shared.table(spark, sf_dir, "documents"), 3, 90).select("doc_id", "n_shingles", "component_id")


def classes_sql(k: int, percent: int, source: str = "documents") -> str:
    """The classes, in SQL for DuckDB: shingle pairs by an inverted index, components by recursion."""
    return f"""
WITH RECURSIVE d0 AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {source}),
s0 AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k} - 1], ' ')))) END AS s FROM d0),
nodes AS (SELECT s, min(doc_id) AS node, len(s) AS n FROM s0 WHERE len(s) > 0 GROUP BY s),
tokens AS (SELECT node, n, unnest(s) AS t FROM nodes),
pairs AS (
  SELECT a.node AS a, b.node AS b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb FROM tokens a JOIN tokens b ON a.t = b.t AND a.node < b.node
  AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * i >= {percent} * (na + nb - i)),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT node AS a, node AS b FROM nodes UNION SELECT reach.a, ends.b FROM reach JOIN ends ON reach.b = ends.a),
named AS (SELECT a AS node, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s0.s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM s0 LEFT JOIN nodes ON s0.s = nodes.s LEFT JOIN named USING (node)"""


ORACLE_SQL = classes_sql(3, 90)
