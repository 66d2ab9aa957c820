"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets and verified pairs.

1. Equal vectors are one entry with their number. A hash is the nearest corner of the cross-polytope after three rounds of random signs and a Hadamard transform; a code is ``hashes`` of
   them. Every entry is filed under its own code and the next likeliest ones (``probes`` in all) of each of ``tables`` tables. As many hashes are taken as the number of entries needs
   for buckets of bounded size, and as many tables as a simulation of pairs exactly at the threshold needs for ``recall``: both follow from the method, whatever the vectors are.
2. Entries close together are collapsed first: among those of one code, leaders are found that others lie within half the threshold's angle of. A leader's followers are a class: all
   of them link with each other, which needs no pairs. An entry without leader is a class of its own.
3. In each bucket, classes are compared by their centres, in blocks if there are many. Pairs of single entries at or above the threshold are links; they are counted at the first bucket where
   the two meet, and stars tie what is linked, so no pair leaves the task. Other pairs of classes that may link go on.
4. A class lies within a radius of its centre: by the triangle inequality most pairs of classes link as a whole or not at all, most others do so for an entry and a class; what is still open is
   compared entry by entry, in blocks.
5. Counts are summed, and the stars' components found.

A hot group, near or equal, thus becomes a few classes; those and large buckets are dealt out by salts and blocks, none is cut. What is broadcast is the parameters alone.

Defined results: vectors that are null, zero or hold null or non-finite components, and rows without an id, link with nothing and have a row each; vectors of unlike length don't link; a repeated row is a vector
of its own; an empty table gives no rows; extra columns aren't read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumq.llm import shared
from vellumq.llm.components import components

SLACK = 1e-7


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Hadamard transform of each row, by butterflies."""
    n, width, half = *x.shape, 1
    while half < width:
        y = x.reshape(n, width // (2 * half), 2, half)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(n, width)
        half *= 2
    return x / math.sqrt(width)


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(1, keepdims=True)  # squares neither overflow nor vanish
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


class Hash:
    """Codes of unit vectors of one length: their likeliest corners under ``hashes`` rotations of a table."""

    def __init__(self, size: int, hashes: int, table: int, probes: int, seed: int = 11):
        self.width = max(2, 1 << (size - 1).bit_length())
        self.hashes = min(hashes, 62 // (2 * self.width - 1).bit_length())
        self.probes = probes
        self.signs = np.random.default_rng([seed, size, table]).choice([-1.0, 1.0], (self.hashes, 3, self.width))

    def codes(self, rows: np.ndarray) -> np.ndarray:
        """Of each row its own code and then the next likeliest ones."""
        n, few = len(rows), min(self.width, self.probes)
        padded = np.zeros((n, self.width))
        padded[:, : rows.shape[1]] = rows
        far, code = np.zeros((n, 1)), np.zeros((n, 1), np.int64)
        for signs in self.signs:
            x = padded
            for s in signs:
                x = hadamard(x * s)
            size = np.abs(x)
            top = np.argsort(-size, axis=1, kind="stable")[:, :few]
            high = np.take_along_axis(size, top, 1)
            corner = 2 * top + (np.take_along_axis(x, top, 1) < 0)
            cost = (far[:, :, None] + ((high[:, :1] - high) ** 2)[:, None, :]).reshape(n, -1)
            both = (code[:, :, None] * (2 * self.width) + corner[:, None, :]).reshape(n, -1)
            best = np.argsort(cost, axis=1, kind="stable")[:, : self.probes]
            far, code = np.take_along_axis(cost, best, 1), np.take_along_axis(both, best, 1)
        return code


@functools.lru_cache(64)
def hash_of(size: int, hashes: int, table: int, probes: int) -> Hash:
    return Hash(size, hashes, table, probes)


def tables_for(size: int, hashes: int, probes: int, cosine: float, recall: float, trials: int = 2000) -> int:
    """How many tables find pairs exactly at the cosine with this probability."""
    random = np.random.default_rng(5)
    a = unit(random.normal(size=(trials, size)))
    b = random.normal(size=(trials, size))
    b = unit(b - (a * b).sum(1, keepdims=True) * a) if size > 1 else a
    b = unit(cosine * a + math.sqrt(1 - cosine * cosine) * b)
    missed = np.ones(trials, bool)
    for n in range(1, 257):
        h = Hash(size, hashes, n, probes)
        p, q = h.codes(a), h.codes(b)
        missed &= ~((p == q[:, :1]).any(1) | (q == p[:, :1]).any(1))
        if missed.mean() <= 1 - recall:
            break
    return n


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def vectors(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * (rows.shape[1] if len(rows) else 0), pa.int32()), pa.array(np.ascontiguousarray(rows).reshape(-1), pa.float64()))


def by_size(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch's rows by the length of ``v``."""
    sizes = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        yield batch if (sizes == size).all() else batch.take(pa.array(np.flatnonzero(sizes == size)))


def runs(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Runs of equal keys within sorted batches, with the key."""
    for batch in batches:
        if batch.num_rows:
            own = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in keys])
            cut = [0, *(np.flatnonzero((own[:, 1:] != own[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cut, cut[1:], strict=False):
                yield tuple(own[:, a].tolist()), batch.slice(a, b - a)


def columns(types: dict[str, pa.DataType], *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(values, types.values(), strict=True)], names=list(types))


def usable(embedding):
    v = F.col(embedding).cast("array<double>")
    return v, F.coalesce(F.exists(v, lambda x: x != 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def dealt(rows: DataFrame, keys: list[str], full: int, counted: DataFrame | None = None, most: int = 100_000) -> DataFrame:
    """The rows with ``parts``: how many parts of about ``full`` rows their key has. ``counted`` has the rows' keys alone, if that is less work.

    Keys of several parts are sent to all tasks only if they are at most ``most``; beyond that they are joined.
    """
    hot = (rows if counted is None else counted).groupBy(*keys).count().filter(F.col("count") > full).select(*keys, F.ceil(F.col("count") / full).cast("int").alias("parts"))
    hot = shared.written(hot, "hot")
    hot = F.broadcast(hot) if hot.count() <= most else hot.hint("merge")
    return rows.join(hot, keys, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))


class NearVectors:
    """Links and components of the rows (vec_id, embedding) at a cosine of ``cosine`` or more."""

    def __init__(self, rows: DataFrame, cosine: float = 0.9, recall: float = 0.995, probes: int = 8, bucket: int = 512, full: int = 20_000, block: int = 4_096, leaders: int = 32):
        self.cosine, self.recall, self.probes, self.bucket, self.full, self.block, self.most = cosine, recall, probes, bucket, full, block, leaders
        self.angle = math.acos(cosine)
        v, fit = usable("embedding")
        self.rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(fit & F.col("vec_id").isNotNull(), v).alias("v"))
        counted = self.rows.filter("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
        self.entries = shared.written(counted.select(F.monotonically_increasing_id().alias("entry"), "v", "least", "copies"), "entries")
        self.settings = {size: self._fitted(size, n) for size, n in self.entries.groupBy(F.size("v")).count().collect()}  # a row for each length
        self.members = self.classes()
        self.verify()

    def _fitted(self, size: int, n: int) -> tuple[int, int]:
        """Hashes in a code, and tables, for so many entries of this length."""
        width = 2 * max(2, 1 << (size - 1).bit_length())
        hashes = max(1, math.ceil(math.log(max(1, n / self.bucket)) / math.log(width)))
        return hashes, tables_for(size, hashes, self.probes, self.cosine, self.recall)

    # -- classes

    def classes(self) -> DataFrame:
        """entry, v (of length 1), copies, least, class, led, centre, angle: each entry under the first leader of its code within half the threshold's angle, or alone."""
        settings, near = dict(self.settings), math.cos(self.angle / 2 - SLACK)

        def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in by_size(batch):
                    v = unit(matrix(part.column("v")))
                    code = hash_of(v.shape[1], settings[v.shape[1]][0], 0, 1).codes(v)[:, 0]
                    yield columns({"size": pa.int32(), "code": pa.int64(), **{f.name: f.type for f in part.schema}}, np.full(len(v), v.shape[1]), code, part.column("entry"), vectors(v), part.column("least"), part.column("copies"))

        def led(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Of each code's part: entries that lead others, and how many."""
            now, heads, ids, followers = None, [], [], []

            def out():
                keep = [i for i, n in enumerate(followers) if n]
                return columns({"size": pa.int32(), "code": pa.int64(), "entry": pa.int64(), "v": pa.list_(pa.float64()), "followers": pa.int64()}, [now[0]] * len(keep), [now[1]] * len(keep), [ids[i] for i in keep], [heads[i].tolist() for i in keep], [followers[i] for i in keep])

            for key, run in runs(batches, ("size", "code", "part")):
                if key != now:
                    if any(followers):
                        yield out()
                    now, heads, ids, followers = key, [], [], []
                own, names = matrix(run.column("v")), run.column("entry").to_pylist()
                left = np.arange(len(own))
                if heads:
                    close = own @ np.array(heads).T
                    best = close.argmax(1)
                    fits = close[left, best] >= near
                    for i, n in zip(*np.unique(best[fits], return_counts=True), strict=True):
                        followers[i] += int(n)
                    left = left[~fits]
                while len(left):
                    head = own[left[0]]
                    fits = own[left] @ head >= near
                    fits[0] = True
                    heads.append(head)
                    ids.append(names[left[0]])
                    followers.append(int(fits.sum()) - 1)
                    left = left[~fits]
            if any(followers):
                yield out()

        schema = "size int, code bigint, entry bigint, v array<double>, least bigint, copies bigint"
        filed = shared.written(self.entries.select("entry", "v", "least", "copies").mapInArrow(coded, schema), "coded")
        parted = dealt(filed, ["size", "code"], self.full).withColumn("part", F.pmod(F.xxhash64("entry"), F.col("parts")).cast("int"))
        parted = shared.written(parted, "parted")
        sent = parted.select("size", "code", "part", "entry", "v").repartition("size", "code", "part").sortWithinPartitions("size", "code", "part")
        heads = shared.written(sent.mapInArrow(led, "size int, code bigint, entry bigint, v array<double>, followers bigint"), "leaders")
        # leaders make the next step shorter: those that most follow are taken, whoever has none is a class of its own
        order = F.row_number().over(Window.partitionBy("size", "code").orderBy(F.desc("followers"), "entry"))
        chosen = heads.withColumn("rank", order).filter(F.col("rank") <= self.most)
        parts = parted.groupBy("size", "code").agg(F.max("parts").alias("parts"))
        told = chosen.join(parts, ["size", "code"]).select("size", "code", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "rank", "entry", "v", F.lit(0).cast("long").alias("least"), F.lit(0).cast("long").alias("copies"))
        asked = parted.select("size", "code", "part", F.lit(1 << 30).alias("rank"), "entry", "v", "least", "copies")

        def assigned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, heads, ids = None, [], []
            types = {"entry": pa.int64(), "v": pa.list_(pa.float64()), "least": pa.int64(), "copies": pa.int64(), "class": pa.int64(), "led": pa.bool_(), "centre": pa.list_(pa.float64()), "angle": pa.float64()}
            for key, run in runs(batches, ("size", "code", "part")):
                if key != now:
                    now, heads, ids = key, [], []
                leads = int((run.column("copies").to_numpy() == 0).sum())  # they come first
                heads += list(matrix(run.slice(0, leads).column("v")))
                ids += run.slice(0, leads).column("entry").to_pylist()
                part = run.slice(leads)
                v = matrix(part.column("v"))
                if len(v):
                    name = part.column("entry").to_numpy()
                    klass, centre, angle, found = name.copy(), v.copy(), np.zeros(len(v)), np.zeros(len(v), bool)
                    if heads:
                        close = v @ np.array(heads).T
                        fits = close >= near
                        found, first = fits.any(1), fits.argmax(1)
                        klass[found] = np.array(ids)[first[found]]
                        centre[found] = np.array(heads)[first[found]]
                        angle[found] = np.arccos(np.minimum(1.0, close[found, first[found]])) + SLACK
                    yield columns(types, part.column("entry"), part.column("v"), part.column("least"), part.column("copies"), klass, found, vectors(centre), angle)

        met = told.unionByName(asked).repartition("size", "code", "part").sortWithinPartitions("size", "code", "part", "rank")
        out = shared.written(met.mapInArrow(assigned, "entry bigint, v array<double>, least bigint, copies bigint, class bigint, led boolean, centre array<double>, angle double"), "members")
        for gone in (filed, parted, heads):
            shared.remove(gone)
        return out

    # -- links

    def buckets(self, whole: bool) -> DataFrame:
        """size, tab, code and, if whole, class, resident, led, copies, centre: the classes that each bucket holds, once a batch."""
        settings, probes = dict(self.settings), self.probes

        def file(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in by_size(batch):
                    v = matrix(part.column("v"))
                    klass = part.column("class").to_numpy()
                    hashes, tables = settings[v.shape[1]]
                    for tab in range(1, tables + 1):
                        codes = hash_of(v.shape[1], hashes, tab, probes).codes(v)
                        at, own = np.repeat(np.arange(len(v)), codes.shape[1]), np.tile(np.arange(codes.shape[1]) == 0, len(v))
                        code = codes.reshape(-1)
                        order = np.lexsort((~own, klass[at], code))  # of a class's rows the resident one first
                        new = np.ones(len(order), bool)
                        new[1:] = (code[order][1:] != code[order][:-1]) | (klass[at][order][1:] != klass[at][order][:-1])
                        order = order[new]
                        keys = [pa.array(np.full(len(order), v.shape[1]), pa.int32()), pa.array(np.full(len(order), tab), pa.int32()), pa.array(code[order])]
                        if not whole:
                            yield pa.RecordBatch.from_arrays(keys, names=["size", "tab", "code"])
                            continue
                        rows = part.take(pa.array(at[order]))
                        yield pa.RecordBatch.from_arrays([*keys, rows.column("class"), pa.array(own[order]), rows.column("led"), rows.column("copies"), rows.column("centre")], names=["size", "tab", "code", "class", "resident", "led", "copies", "centre"])

        return self.members.select("v", "class", "led", "copies", "centre").mapInArrow(file, "size int, tab int, code bigint" if not whole else "size int, tab int, code bigint, class bigint, resident boolean, led boolean, copies bigint, centre array<double>")

    def verify(self) -> None:
        cosine, angle, settings, probes, block = self.cosine, self.angle, dict(self.settings), self.probes, self.block
        # a bucket's rows hold vectors: they are dealt out once, and counted by their codes alone
        parted = dealt(self.buckets(True), ["size", "tab", "code"], self.block, self.buckets(False)).withColumn("own", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
        # blocks i <= j of a bucket are compared in one task: a row goes to all that have its own block
        sent = parted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("parts", "other")
        kinds = {"kind": pa.int32(), "a": pa.int64(), "b": pa.int64()}

        def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """kind 0: a has b more links; 1: a and b are tied; 2: the classes a and b may link."""
            now, held = None, []
            count: dict[int, int] = {}

            def flush() -> pa.RecordBatch:
                out = columns(kinds, [0] * len(count), list(count), list(count.values()))
                count.clear()
                return out

            for key, run in runs(batches, ("size", "tab", "code", "i", "j")):
                if key != now:
                    if held:
                        yield from self_pairs(now, held, count)
                    now, held = key, []
                held.append(run)
                if len(count) > 200_000:
                    yield flush()
            if held:
                yield from self_pairs(now, held, count)
            yield flush()

        def self_pairs(key: tuple, held: list[pa.RecordBatch], count: dict[int, int]) -> Iterator[pa.RecordBatch]:
            size, tab, code, i, j = key
            rows = pa.Table.from_batches(held).combine_chunks()
            klass, lives = rows["class"].to_numpy(), rows["resident"].to_numpy()
            order = np.lexsort((~lives, klass))
            order = order[np.concatenate(([True], klass[order][1:] != klass[order][:-1]))] if len(order) else order
            rows = rows.take(pa.array(order))
            klass, lives, led, copies, block_of = (rows[c].to_numpy() for c in ("class", "resident", "led", "copies", "own"))
            own = matrix(rows["centre"].combine_chunks())
            limit = [cosine, math.cos(1.5 * angle), math.cos(min(math.pi, 2 * angle))]
            for at in range(0, len(own), 1024):  # memory: a strip of the block
                one = np.arange(at, min(len(own), at + 1024))
                close = own[one] @ own.T
                need = np.array(limit)[led[one].astype(int)[:, None] + led.astype(int)[None, :]]
                fits = (close >= need) & (lives[one][:, None] | lives[None, :]) & (klass[one][:, None] < klass[None, :])
                if i != j:
                    fits &= block_of[one][:, None] != block_of[None, :]
                p, q = np.nonzero(fits)
                p = one[p]
                maybe = led[p] | led[q]
                yield columns(kinds, [2] * int(maybe.sum()), klass[p[maybe]], klass[q[maybe]])
                p, q = p[~maybe], q[~maybe]
                if not len(p):
                    continue
                first = meets_first(size, tab, code, own, p, q)
                p, q = p[first], q[first]
                for x, y in ((p, q), (q, p)):
                    n = np.zeros(len(own), np.int64)
                    np.add.at(n, x, copies[y])
                    for k in np.flatnonzero(n).tolist():
                        count[int(klass[k])] = count.get(int(klass[k]), 0) + int(n[k])
                # each is tied to the least that it links with in this strip, all else is tied through those
                yield stars(klass, p, q)

        def stars(klass: np.ndarray, p: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
            root = np.arange(len(klass))
            while True:
                low = np.minimum(root[p], root[q])
                after = root.copy()
                np.minimum.at(after, root[p], low)
                np.minimum.at(after, root[q], low)
                after = after[after]
                if (after == root).all():
                    break
                root = after
            tied = np.flatnonzero(root != np.arange(len(root)))
            return columns(kinds, [1] * len(tied), klass[root[tied]], klass[tied])

        def meets_first(size: int, tab: int, code: int, own: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
            """Whether this bucket is the first where the two meet: they meet in the own code of either, if the other is filed there too."""
            used = np.unique(np.concatenate((p, q)))
            place = np.searchsorted(used, np.arange(len(own)))
            a, b = place[p], place[q]
            hashes, _ = settings[size]
            first = np.ones(len(p), bool)
            for n in range(1, tab + 1):
                codes = hash_of(size, hashes, n, probes).codes(own[used])
                x, y = codes[a], codes[b]
                at_x, at_y = (y == x[:, :1]).any(1), (x == y[:, :1]).any(1)
                if n < tab:
                    first &= ~(at_x | at_y)
                else:
                    least = np.minimum(np.where(at_x, x[:, 0], np.iinfo(np.int64).max), np.where(at_y, y[:, 0], np.iinfo(np.int64).max))
                    first &= least == code
            return first

        order = ["size", "tab", "code", "i", "j"]
        found = sent.repartition(*order).sortWithinPartitions(*order).mapInArrow(compare, "kind int, a bigint, b bigint")
        found = shared.written(found.groupBy("kind", "a", F.when(F.col("kind") > 0, F.col("b")).alias("b")).agg(F.sum(F.when(F.col("kind") == 0, F.col("b"))).alias("n")), "found")
        self.stats = shared.written(self.members.groupBy("class").agg(F.first("centre").alias("centre"), F.max("angle").alias("radius"), F.sum("copies").alias("weight"), F.count("*").alias("entries"), F.min("least").alias("least")), "classes")

        pairs = found.filter("kind = 2").select("a", "b")
        one = self.stats.select(F.col("class").alias("a"), F.col("centre").alias("centre_a"), F.col("radius").alias("radius_a"), F.col("weight").alias("weight_a"))
        two = self.stats.select(F.col("class").alias("b"), F.col("centre").alias("centre_b"), F.col("radius").alias("radius_b"), F.col("weight").alias("weight_b"), F.col("entries").alias("entries_b"))
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        gap = between("centre_a", "centre_b")
        judged = both.join(one, "a").join(two, "b").withColumn("gap", gap)
        reach = F.col("radius_a") + F.col("radius_b")
        whole = F.col("gap") + reach <= angle - SLACK
        judged = shared.written(judged.filter(F.col("gap") - reach <= angle + SLACK).select("a", "b", whole.alias("whole"), "centre_b", "radius_b", "weight_b", "entries_b"), "judged")
        by_class = judged.filter("whole").select(F.col("a").alias("class"), "b", F.col("weight_b").alias("n"))

        single = self.members.select("entry", "v", F.col("class").alias("a")).join(judged.filter("NOT whole").hint("merge"), "a").withColumn("gap", between("v", "centre_b"))
        single = single.filter(F.col("gap") - F.col("radius_b") <= angle + SLACK).withColumn("whole", F.col("gap") + F.col("radius_b") <= angle - SLACK)
        single = shared.written(single.select("entry", "a", "b", "whole", "weight_b", "entries_b", F.when(~F.col("whole"), F.col("v")).alias("v")), "single")
        by_entry = single.filter("whole").select("entry", "a", "b", F.col("weight_b").alias("n"))

        # entries and classes that are still open: a class's entries in blocks, met by the entries that ask
        open_ = single.filter("NOT whole").withColumn("blocks", F.ceil(F.col("entries_b") / block).cast("int"))
        asks = dealt(open_.select("entry", "a", "b", "v", "blocks"), ["b"], self.full).withColumn("part", F.pmod(F.xxhash64("entry"), F.col("parts")).cast("int"))
        asks = shared.written(asks, "asks")
        wanted = asks.groupBy("b").agg(F.max("parts").alias("parts"), F.max("blocks").alias("blocks"))
        held = self.members.select(F.col("class").alias("b"), "entry", "v", "copies").join(wanted.hint("merge"), "b")
        held = held.select("b", F.pmod(F.xxhash64("entry"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("asks"), "entry", F.lit(0).cast("long").alias("a"), "v", "copies")
        sent = asks.select("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "part", F.lit(1).alias("asks"), "entry", "a", "v", F.lit(0).cast("long").alias("copies"))

        def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, own, weights = None, [], []
            for key, run in runs(batches, ("b", "block", "part", "asks")):
                if key[:3] != now:
                    now, own, weights = key[:3], [], []
                v = matrix(run.column("v"))
                if not key[3]:
                    own.append(v)
                    weights.append(run.column("copies").to_numpy())
                    continue
                if not own:
                    continue
                table, weight = np.concatenate(own), np.concatenate(weights)
                n = np.concatenate([(v[i : i + 1024] @ table.T >= cosine) @ weight for i in range(0, len(v), 1024)])
                some = np.flatnonzero(n)
                rows = run.take(pa.array(some))
                yield columns({"entry": pa.int64(), "a": pa.int64(), "b": pa.int64(), "n": pa.int64()}, rows.column("entry"), rows.column("a"), rows.column("b"), n[some])

        order = ["b", "block", "part"]
        met = held.unionByName(sent).repartition(*order).sortWithinPartitions(*order, "asks").mapInArrow(meet, "entry bigint, a bigint, b bigint, n bigint")
        by_entry = shared.written(by_entry.unionByName(met), "byentry")
        for gone in (single, asks):
            shared.remove(gone)
        ties = found.filter("kind = 1").select("a", "b").unionByName(by_class.select(F.col("class").alias("a"), "b")).unionByName(by_entry.select("a", "b"))
        self.class_links = by_class.groupBy("class").agg(F.sum("n").alias("of_class")).unionByName(found.filter("kind = 0").select(F.col("a").alias("class"), F.col("n").alias("of_class"))).groupBy("class").agg(F.sum("of_class").alias("of_class"))
        self.entry_links = by_entry.groupBy("entry").agg(F.sum("n").alias("of_entry"))
        self.tied = components(ties.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "tied")

    def result(self) -> DataFrame:
        """vec_id, n_links, component_id of every row."""
        named = self.stats.select("class", "weight", "least").join(self.tied.select(F.col("node").alias("class"), "component"), "class", "left").withColumn("component", F.coalesce("component", "class"))
        least = named.groupBy("component").agg(F.min("least").alias("component_id"))
        classes = shared.written(named.join(least, "component").join(self.class_links, "class", "left").select("class", "component_id", (F.col("weight") - 1 + F.coalesce("of_class", F.lit(0))).alias("links")), "named")
        entries = self.members.select("entry", "class").join(classes.hint("merge"), "class").join(self.entry_links, "entry", "left").join(self.entries.select("entry", "v"), "entry")
        entries = shared.written(entries.select("v", "component_id", (F.col("links") + F.coalesce("of_entry", F.lit(0))).alias("n_links")), "linked")
        fit = self.rows.filter("v IS NOT NULL").join(entries.hint("merge"), "v").select("vec_id", "n_links", "component_id")
        return fit.unionByName(self.rows.filter("v IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))


def between(a: str, b: str) -> Column:
    """The angle of two array columns of unit vectors, in Spark's own functions."""
    cosine = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, z: s + z)
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))


def op11_near_vectors(spark, sf_dir: str) -> DataFrame:
    """Links of all vectors at a cosine of 0.9 or more, and their components."""
    out = NearVectors(shared.table(spark, sf_dir, "embeddings")).result()
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
