"""Scores, budgets, samples, planted errors and what a reader caught."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumq.functions import text as T
from vellumq.operators.graph import settled
from vellumq.operators.tokens import sentences


def bigram_scores(documents: DataFrame, floor: float = -15.0) -> DataFrame:
    """doc_id, sent_no, at, word, score of each word of each sentence.

    There is no language model here: a word's log-probability is that of the corpus's bigram, ln(c(w1, w2) / c(w1)), at least ``floor``. First words have none
    and score 0. Scores are made once for each distinct pair and joined back.
    """
    w = F.transform(T.spaced_words(F.col("s")), F.lower)
    rows = sentences(documents).select("doc_id", "sent_no", w.alias("w"))
    pairs = rows.select("doc_id", "sent_no", F.posexplode(F.transform("w", lambda x, i: F.struct(F.when(i > 0, F.get(F.col("w"), i - 1)).alias("before"), x.alias("word")))).alias("at", "x")).select("doc_id", "sent_no", "at", "x.before", "x.word")
    both = pairs.filter("before is not null").groupBy("before", "word").agg(F.count("*").alias("n"))
    first = both.groupBy("before").agg(F.sum("n").alias("total"))
    bare = F.regexp_replace("word", "[^a-z]", "")
    lp = F.greatest(F.lit(floor), F.log(F.col("n") / F.col("total")))
    # only small words can score above 0, so only their pairs are joined
    scores = both.filter(bare.isin(*T.SMALL)).join(first, "before").select("before", "word", F.round(T.word_score(F.col("word"), lp, F.lit(None).cast("string"), F.lit(floor)), 6).alias("score"))
    return pairs.join(scores, ["before", "word"], "left").select("doc_id", "sent_no", "at", "word", (F.coalesce("score", F.lit(0.0)) + 0.0).alias("score"))


def sentence_scores(scores: DataFrame) -> DataFrame:
    """doc_id, sent_no, words, score, strongest (its first place), strength (scores, strongest first)."""
    rows = scores.groupBy("doc_id", "sent_no").agg(F.count("*").alias("words"), F.max("score").alias("score"), F.max_by("at", F.struct("score", -F.col("at"))).alias("at"), F.sort_array(F.collect_list("score"), asc=False).alias("strength"))
    return rows.select("doc_id", "sent_no", "words", "score", F.when(F.col("score") > 0, F.col("at")).alias("strongest"), "strength")


def small_words(documents: DataFrame) -> DataFrame:
    """doc_id, sents (words, small: at, before, word), firsts (before, n): of each sentence how many words it has and its small words but a first one; and, with one of some hundred texts, how often these have each word with one behind it.

    Cut in Arrow batches: white space is ASCII's, as in the pattern of spaced words, which bytes.split() has too. What is a small word is worked out once for each form.
    """
    import re
    from collections import Counter
    from itertools import accumulate

    import pyarrow as pa

    letters, small = re.compile(rb"[^a-z]+"), frozenset(x.encode() for x in T.SMALL)

    class Known(dict):
        def __missing__(self, word: bytes) -> bool:
            if len(self) > 1 << 18:
                self.clear()
            self[word] = out = letters.sub(b"", word) in small
            return out

    def listed(sizes: list[int], values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, *accumulate(sizes)], pa.int32()), values)

    def told(texts: list[bytes], known: Known) -> list[pa.Array]:
        sents, words, found, at, before, word, own = ([] for _ in range(7))
        for text in texts:
            n = len(words)
            for sentence in text.split(b"\x01"):
                if sentence.strip(b" "):
                    w = sentence.split()
                    places = [i for i, x in enumerate(w) if known[x] and i]
                    words.append(len(w))
                    found.append(len(places))
                    at += places
                    before += [w[i - 1] for i in places]
                    word += [w[i] for i in places]
                    own += w[:-1]
            sents.append(len(words) - n)
        count = Counter(own)
        firsts = [len(count), *[0] * (len(texts) - 1)]
        each = pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(before, pa.string()), pa.array(word, pa.string())], ["at", "before", "word"])
        both = pa.StructArray.from_arrays([pa.array(words, pa.int64()), listed(found, each)], ["words", "small"])
        return [listed(sents, both), listed(firsts, pa.StructArray.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["before", "n"]))]

    def cut(batches):
        known = Known()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), *told(part.column(1).cast(pa.binary()).to_pylist(), known)], names=["doc_id", "sents", "firsts"])

    marked = F.lower(T.ends_marked(F.col("text")))
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", marked.alias("text")).mapInArrow(cut, f"doc_id {kind}, sents array<struct<words:bigint,small:array<struct<at:int,before:string,word:string>>>>, firsts array<struct<before:string,n:bigint>>")


def small_scores(documents: DataFrame, floor: float = -15.0) -> tuple[DataFrame, DataFrame]:
    """doc_id, sent_no, words of each sentence that has words; and doc_id, sent_no, at, score of each small word that isn't a sentence's first, scored as in bigram_scores.

    Only small words can score, so only they are exploded and joined with the scores of their pairs; a sentence's other words are its number of words.
    """
    rows = settled(small_words(documents))
    each = rows.select("doc_id", F.posexplode("sents").alias("sent_no", "x"))
    found = each.select("doc_id", "sent_no", F.explode("x.small").alias("x")).select("doc_id", "sent_no", "x.at", "x.before", "x.word")
    both = found.groupBy("before", "word").agg(F.count("*").alias("n"))
    total = rows.select(F.inline("firsts")).groupBy("before").agg(F.sum("n").alias("total"))
    lp = F.greatest(F.lit(floor), F.log(F.col("n") / F.col("total")))
    scores = both.join(total, "before").select("before", "word", F.round(T.word_score(F.col("word"), lp, F.lit(None).cast("string"), F.lit(floor)), 6).alias("score"))
    return each.select("doc_id", "sent_no", "x.words").filter("words > 0"), found.join(scores, ["before", "word"]).select("doc_id", "sent_no", "at", "score")


def scored_sentences(documents: DataFrame, floor: float = -15.0) -> DataFrame:
    """doc_id, sent_no, words, score, strongest, strength: as sentence_scores of bigram_scores, but strength has scores above 0 only."""
    rows, told = small_scores(documents, floor)
    told = told.select("doc_id", "sent_no", F.lit(None).cast("long").alias("words"), "at", "score")
    bare = rows.select("doc_id", "sent_no", "words", F.lit(None).cast("int").alias("at"), F.lit(None).cast("double").alias("score"))
    each = told.unionByName(bare).groupBy("doc_id", "sent_no").agg(F.max("words").alias("words"), F.coalesce(F.max("score"), F.lit(0.0)).alias("score"), F.max_by("at", F.when(F.col("score") > 0, F.struct("score", -F.col("at")))).alias("at"), _strength())
    return each.select("doc_id", "sent_no", "words", (F.col("score") + 0.0).alias("score"), F.when(F.col("score") > 0, F.col("at")).alias("strongest"), "strength")


def _strength() -> Column:
    return F.sort_array(F.collect_list(F.when(F.col("score") > 0, F.col("score"))), asc=False).alias("strength")


def taken(rows: DataFrame, order: list[Column], weight: str, budget: Column | None = None, share: float | None = None) -> DataFrame:
    """Rows in order while the weight of those before is under the budget, or under a share of all rows' weight; the last may overshoot.

    The running sum is made in two steps, so no task sees all rows: rows are ranged into partitions in order, each partition's
    weight is summed, and the sums before a partition (one row each, as many as there are partitions) are added to the running sum within it. The ranged rows are written, so
    that both steps see one division of the rows.
    """
    part, inner, before, total = (unused(x, rows) for x in ("part", "inner", "before", "total"))
    ranged = settled(rows.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    sums = ranged.groupBy(part).agg(F.sum(weight).alias(total))
    upto = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(part, F.coalesce(F.sum(total).over(upto), F.lit(0)).alias(before), F.sum(total).over(Window.partitionBy()).alias(total))
    limit = budget if share is None else share * F.col(total)
    running = F.coalesce(F.sum(weight).over(Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return ranged.withColumn(inner, running).join(F.broadcast(sums), part).filter(F.col(inner) + F.col(before) < limit).drop(part, inner, before, total)


def unused(name: str, rows: DataFrame) -> str:
    """A column name like this that the rows don't have."""
    while name.lower() in {c.lower() for c in rows.columns}:
        name += "_"
    return name


def strength_order() -> list[Column]:
    """Strongest first, by all words' scores; of two vectors equal up to the shorter's end the shorter first; ties by reading order.

    Words that score 0 come last in a vector, so one of them, if there is any, and the number of words say all that they do.
    """
    some = F.filter("strength", lambda x: x > 0)
    vector = F.concat(F.transform(some, lambda x: -x), F.when(F.col("words") > F.size(some), F.array(F.lit(0.0))).otherwise(F.array().cast("array<double>")))
    return [vector.asc(), F.col("words").asc(), F.col("doc_id").asc(), F.col("sent_no").asc()]


def _ending(sums: list[tuple[int, int]], share: float) -> tuple[int, float]:
    """In which of the buckets (number, weight), the highest first, a share of all weight ends (-1: in none), and what is left of it there."""
    left = share * sum(w for _, w in sums)
    for b, w in sorted(sums, reverse=True):
        if w >= left:
            return b, left
        left -= w
    return -1, left


def budget_top(sentences: DataFrame, share: float = 0.15, told: DataFrame | None = None) -> DataFrame:
    """The sentences (with score, words, strength) in strength_order while the words of those before are under a share of all; the last may overshoot.

    Sentences fall into buckets by their greatest score. The buckets' words (a row each, BUCKETS and one at most) say in which the budget ends: those above are taken whole, and that one alone is put in order.
    told (doc_id, sent_no, score): the words' scores, where the sentences have no strength; only those of that bucket are given one then. Sentences without a score have it in their strength.
    """
    bucket = unused("bucket", sentences)
    score = F.col("score") if "score" in sentences.columns else F.greatest(F.coalesce(F.array_max("strength"), F.lit(0.0)), F.lit(0.0))
    none = (F.col("words") == 0) & (score <= 0)  # a vector without an entry comes first
    at = F.when(none, BUCKETS).otherwise(F.least(F.floor(score * 1000), F.lit(BUCKETS - 1))).cast("int")
    rows = settled(sentences.withColumn(bucket, at))
    last, left = _ending([(b, w or 0) for b, w in rows.groupBy(bucket).agg(F.sum("words")).collect()], share)
    end = rows.filter(F.col(bucket) == last)
    if told is not None:
        keys = ["doc_id", "sent_no"]
        end = end.join(told.join(end.select(*keys), keys, "left_semi").groupBy(*keys).agg(_strength()), keys, "left").withColumn("strength", F.coalesce("strength", F.array().cast("array<double>")))
    end = taken(end, strength_order(), "words", budget=F.lit(left))
    return rows.filter(F.col(bucket) > last).select(*sentences.columns).unionByName(end.select(*sentences.columns))


def strongest_sentences(documents: DataFrame, share: float = 0.15) -> DataFrame:
    """doc_id, sent_no, words, score: budget_top of scored_sentences, but no vector of scores is made for sentences whose greatest score decides."""
    rows, told = small_scores(documents)
    told = settled(told)
    both = told.select("doc_id", "sent_no", F.lit(None).cast("long").alias("words"), "score").unionByName(rows.select("doc_id", "sent_no", "words", F.lit(None).cast("double").alias("score")))
    each = both.groupBy("doc_id", "sent_no").agg(F.max("words").alias("words"), (F.coalesce(F.max("score"), F.lit(0.0)) + 0.0).alias("score"))
    return budget_top(each, share, told)


BUCKETS = 1 << 16


def hash_sample(rows: DataFrame, seed: int, share: float, weight: str, *keys: str) -> DataFrame:
    """Rows in the order of a digest of the seed and their keys, a reproducible shuffle, up to a share of all weight; the last may overshoot.

    Rows fall into buckets by their digest's beginning. The buckets' weights (a row each, BUCKETS at most) say in which the budget ends: those before are taken whole, and
    that one alone is put in order.
    """
    digest, bucket, inner = (unused(x, rows) for x in ("digest", "bucket", "inner"))
    rows = settled(rows)
    marked = rows.withColumn(digest, F.sha2(F.concat_ws(":", F.lit(str(seed)), *keys), 256)).withColumn(bucket, F.conv(F.substring(digest, 1, 4), 16, 10).cast("int"))
    sums = sorted((b, w or 0) for b, w in marked.groupBy(bucket).agg(F.sum(weight)).collect())
    budget, before, last = share * sum(w for _, w in sums), 0, BUCKETS
    for b, w in sums:
        if before + w >= budget:
            last = b
            break
        before += w
    order = [F.col(digest).asc(), *[F.col(k).asc() for k in keys]]
    within = F.coalesce(F.sum(weight).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    end = marked.filter(F.col(bucket) == last).withColumn(inner, within).filter(F.col(inner) + F.lit(before) < F.lit(budget))
    return marked.filter(F.col(bucket) < last).select(*rows.columns).unionByName(end.select(*rows.columns))


def marked_line(words: Column, mark: Column, score: Column, number: Column, guess: Column | None = None) -> Column:
    """'NN score words', the strongest word in double brackets, and behind it the likelier word, if there is one."""
    behind = F.lit("") if guess is None else F.coalesce(F.concat(F.lit("("), guess, F.lit("?)")), F.lit(""))
    shown = F.transform(words, lambda w, i: F.when(i == mark, F.concat(F.lit("[["), w, F.lit("]]"), behind)).otherwise(w))
    return F.concat_ws(" ", F.lpad(number.cast("string"), 2, "0"), F.format_string("%4.1f", score), F.array_join(shown, " "))


def plant_doubles(documents: DataFrame, seed: int = 1, apart: int = 40) -> DataFrame:
    """doc_id, at, word, text: in each text of 40 words or more one word said twice, at a place that a hash chooses (``apart`` words from either end at least where the text allows)."""
    w = T.spaced_words(F.col("text"))
    rows = documents.select("doc_id", w.alias("w")).filter(F.size("w") >= 40)
    room = F.greatest(F.size("w") - 2 * apart, F.lit(1))
    at = F.least(F.lit(apart), F.expr("size(w) div 2")) + F.pmod(F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), "doc_id"), 256), 1, 8), 16, 10).cast("bigint"), room.cast("bigint"))
    rows = rows.withColumn("at", F.least(at, F.size("w") - 1).cast("int"))
    return rows.select("doc_id", "at", F.get(F.col("w"), F.col("at")).alias("word"), F.array_join(F.concat(F.slice("w", 1, F.col("at") + 1), F.slice("w", F.col("at") + 1, F.size("w"))), " ").alias("text"))


def spans_hit(targets: DataFrame, flags: DataFrame, near: int = 3) -> DataFrame:
    """Targets (file, w1, w2) that a flag (file, a, b) meets within ``near`` words. Spans are met in buckets of their position, a range join by equality."""
    size = 256
    t = targets.withColumn("__b", F.explode(F.sequence(F.floor((F.col("w1") - near) / size), F.floor((F.col("w2") + near) / size))))
    f = flags.select(F.col("file").alias("__f"), F.col("a").alias("__x"), F.col("b").alias("__y")).withColumn("__c", F.explode(F.sequence(F.floor(F.col("__x") / size), F.floor(F.col("__y") / size))))
    on = (t["file"] == f["__f"]) & (t["__b"] == f["__c"]) & (f["__x"] - near <= t["w2"]) & (t["w1"] <= f["__y"] + near)
    return t.join(f, on, "left_semi").drop("__b").distinct()


def caught(targets: DataFrame, flags: DataFrame, near: int = 3) -> DataFrame:
    """planted, caught, flags, false_alarms in one row."""
    hit = spans_hit(targets, flags, near).agg(F.count("*").alias("caught"))
    good = spans_hit(flags.select("file", F.col("a").alias("w1"), F.col("b").alias("w2")), targets.select("file", F.col("w1").alias("a"), F.col("w2").alias("b")), near).agg(F.count("*").alias("good"))
    n = targets.agg(F.count("*").alias("planted"))
    m = flags.select("file", "a", "b").distinct().agg(F.count("*").alias("flags"))
    return n.crossJoin(hit).crossJoin(m).crossJoin(good).select("planted", "caught", "flags", (F.col("flags") - F.col("good")).alias("false_alarms"))  # one row each


def covered_by(targets: DataFrame, sentences: DataFrame) -> DataFrame:
    """Targets (file, w1) inside a chosen sentence (file, a, b), a word more on either side."""
    s = sentences.select(F.col("file").alias("__f"), "a", "b")
    return targets.join(s, (F.col("file") == F.col("__f")) & (F.col("w1") >= F.col("a") - 1) & (F.col("w1") <= F.col("b") + 1), "left_semi")


def chunks(documents: DataFrame, size: int = 100) -> DataFrame:
    """doc_id, chunk, first_line, lines, words: lines put together while they have ``size`` words at most; a longer line is a chunk by itself. A fold within the row: the state is the words so far and the chunk's number."""
    rows = documents.filter("text is not null").select("doc_id", F.transform(T.lines(F.col("text")), lambda s: F.size(T.spaced_words(s))).alias("n"))
    import pyarrow as pa

    def fold(batches):
        for batch in batches:
            out = []
            for doc, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                first = used = number = 0
                for i, k in enumerate(n):
                    if i > first and used + k > size:
                        out.append((doc, number, first, i - first, used))
                        first, used, number = i, 0, number + 1
                    used += k
                out.append((doc, number, first, len(n) - first, used))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [()] * 5, kinds, strict=True)], names=["doc_id", "chunk", "first_line", "lines", "words"])

    return rows.mapInArrow(fold, "doc_id bigint, chunk int, first_line int, lines int, words bigint")
