"""Operators over documents against brute force, and the defined results for odd rows."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vellumq.llm import chat, decontaminate, jaccard, packing, private, repeats, secrets, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, label string, key long, hash long"
SPACE = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def rows(spark, texts, ids=None):
    ids = ids if ids is not None else range(len(texts))
    return spark.createDataFrame([(i, t, "en", "s1", None, None, None, None, None) for i, t in zip(ids, texts, strict=True)], SCHEMA).repartition(3)


ODD = [None, "", " \n\t", "one", "Ünï çödé 😀 test", "a " * 3000, "x" * 20000, "same text of some words here", "same text of some words here"]


def odd(spark):
    return rows(spark, ODD, [1, 2, 3, 4, None, 6, 7, 8, 8])


def test_word_hashes():
    texts = ["Ab cd", None, "ab", "éa_b 1", "cd ab"]
    for kind, pattern in ((words.ALNUM, ALNUM), (words.SOLID, SPACE)):
        own, first = words.word_hashes(pa.array(texts), kind)
        found = [pattern.findall(lowered(t)) for t in texts]
        assert np.diff(first).tolist() == [len(x) for x in found]
        by = {}
        for w, h in zip([w for x in found for w in x], own.tolist(), strict=True):
            assert by.setdefault(w, h) == h
        assert len(set(by.values())) == len(by)


def test_slices_of_batches():
    batch = pa.RecordBatch.from_arrays([pa.array(["a b", "c", None, "d e f"] * 50)], names=["text"])
    parts = list(words.pieces([batch.slice(3, 150)], "text", 20))
    assert sum(p.num_rows for p in parts) == 150 and len(parts) > 5
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.slice(3, 150).column("text").to_pylist()


# -- packing


def test_cuts():
    for n in range(1, 3000, 7):
        c = packing.cuts(n, 1024)
        assert sum(c) == n and all(x & (x - 1) == 0 and x <= 1024 for x in c) and c == sorted(c, reverse=True)


def test_packing_round_trip(spark):
    texts = [*ODD, "The quick brown fox <|endoftext|> jumps", "日本語のテキスト", "word " * 5000]
    got = packing.pack_documents(rows(spark, texts)).collect()
    from tokenizers import Tokenizer

    import public_tokenizers

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert len({r.sequence_id for r in got}) == len(got)
    for i, t in enumerate(texts):
        own = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        ids = [*exact.encode(t or "", add_special_tokens=False).ids, 0]
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in own]).tolist() == ids
        assert all(r.doc_tokens == len(ids) and r.length in (1 << b for b in range(11)) for r in own)
    assert packing.pack_documents(rows(spark, texts).limit(0)).count() == 0
    digest = {(r.doc_id, r.start): r for r in packing.digests(packing.pack_documents(rows(spark, texts))).collect()}
    assert all(digest[r.doc_id, r.start].ids_crc32 == zlib.crc32(r.ids) and digest[r.doc_id, r.start].bucket == r.length for r in got)
    sizes = Counter(r.length for r in got)
    assert {r.bucket: (r.sequences, r.tokens) for r in packing.buckets(packing.pack_documents(rows(spark, texts))).collect()} == {b: (n, b * n) for b, n in sizes.items()}


def test_pieces_of_equal_length_lie_together(spark, tmp_path):
    packing.bucketed(packing.pack_documents(rows(spark, ["word " * n for n in range(1, 9)])), str(tmp_path / "pieces"))
    read = spark.read.parquet(str(tmp_path / "pieces"))
    assert {r.bucket for r in read.collect()} == {1, 2, 4, 8} and read.filter("bucket <> length").isEmpty()
    assert {p.name for p in (tmp_path / "pieces").iterdir() if p.is_dir()} == {f"bucket={1 << b}" for b in range(4)}


def test_both_tokenizers_give_one_result_for_random_texts():
    import public_tokenizers

    names = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    slow, fast = packing.encoder(names[0], None), packing.encoder(*names)
    r = random.Random(11)
    signs = [*map(chr, range(0x250)), *"日本語😀и\u2028\u200d", "'s", "'LL", "  ", "\r\n", "<|endoftext|>", "the ", "123"]
    for _ in range(20_000):
        t = "".join(r.choice(signs if r.random() < 0.5 else "ab 1.'\n") for _ in range(r.randint(1, 25)))
        assert slow(t).tolist() == fast(t).tolist(), repr(t)


def test_both_tokenizers_split_alike():
    import public_tokenizers

    names = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    slow, fast = packing.encoder(names[0], None), packing.encoder(*names)
    for c in map(chr, range(0x250)):
        for t in (c, c + c, f"a{c}b", f"a {c} b", f" {c}{c} \n{c}1", f"'{c}s 12{c}3", f"{c}\n\n {c}"):
            assert slow(t).tolist() == fast(t).tolist(), repr(t)


# -- personal data


def base_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and private.luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in private.PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_spans_by_brute_force():
    r = random.Random(3)
    for _ in range(5000):
        t = "".join(r.choice("a@@.-_ b1%+4") for _ in range(r.randint(1, 30)))
        assert private.base(t) == base_spans(t), t
    for _ in range(1000):
        t = " ".join(r.choice(["4111 1111 1111 1111", "10.0.0.256", "1.2.3.4.5", "+1 (555) 010-9999", "a.b@c.de", "+12 34", "é"]) for _ in range(6))
        assert private.base(t) == base_spans(t), t


def test_parts_of_many_zeros():
    for n in (1, 300, 399, 401, 3000):
        t = "0" * n + ".1.1.1 and " + "0" * n + "256.1.1.1"
        assert [x for x in private.base(t) if x[1] == 1] == [(0, 1, n + 6)] == [x for x in base_spans(t) if x[1] == 1]


@pytest.fixture(scope="module")
def boosted():
    return private.Model([])


def brute_candidates(text):
    """Every span from digit to digit, from group border to group border, and every address, one by one."""
    out = set()
    for s in range(len(text)):
        if not text[s].isascii() or not text[s].isdigit() or s and text[s - 1] in "0123456789":
            continue
        for e in range(s + 1, len(text) + 1):
            span = text[s:e]
            if not re.fullmatch(r"[0-9]+([ ().\-/\[\]]{1,3}[0-9]+)*", span):
                continue
            if e < len(text) and text[e] in "0123456789":
                continue
            n, groups = len(re.sub("[^0-9]", "", span)), len(re.findall("[0-9]+", span))
            begin = s - (text[s - 1 : s] == "(")
            begin -= text[begin - 1 : begin] == "+" if begin else 0
            out |= {(begin, k, e) for k, ok in ((1, groups == 4 and n <= 19), (2, 12 <= n <= 19), (3, 7 <= n <= 15)) if ok}
    return out


def brute_score(boosted, values):
    """The trees walked one by one, in plain Python."""
    row = [sum(v > c for c in cuts) for v, cuts in zip(values.tolist(), boosted.trees.cuts, strict=True)]
    margin = boosted.trees.first
    for column, cut, below, above, value in boosted.trees.trees:
        node = 0
        while below[node] != node:
            node = int(below[node] if row[column[node]] <= cut[node] else above[node])
        margin += boosted.trees.rate * value[node]
    return 1 / (1 + math.exp(-(boosted.slope * margin + boosted.constant)))


def brute_spans(boosted, text):
    kept, own = base_spans(text), private.proposals(text)
    scores = {(int(s), int(k), int(e)): brute_score(boosted, v) for s, k, e, v in zip(own.start, own.kind, own.end, own.values, strict=True)}
    out = [(*x, True) for x in kept]
    for s, k, e in sorted(scores, key=lambda x: (-scores[x], x)):
        if scores[s, k, e] >= boosted.threshold[k] and not any(s < f and b < e for b, _, f, _ in out):
            out.append((s, k, e, False))
    return sorted(out), scores


PARTS = ["4111 1111 1111 1111", "12/26", "123", "(415) 555-0134", "555-123-4567", "call ", "visa ", "+1 415 555 0134", "10.0.0[.]1", "bob [at] corp [dot] com", "a.b@c.de", "2004-01-12", "version ", "é", "1.2.3.4", "ip ", "x @ y.org", "\n", ", "]


def test_candidates_and_added_spans_by_brute_force(boosted):
    r = random.Random(8)
    for _ in range(60):
        t = " ".join(r.choice(PARTS) for _ in range(r.randint(1, 7)))
        own = private.proposals(t)
        assert {(s, k, e) for s, k, e in zip(own.start.tolist(), own.kind.tolist(), own.end.tolist(), strict=True) if k} == brute_candidates(t), t
        want, scores = brute_spans(boosted, t)
        got = boosted.spans(t)
        assert [(s, k, e, b) for s, k, e, _, b, _ in got] == want, t
        assert all(abs(p - scores.get((s, k, e), 0)) < 1e-9 and a == (p >= boosted.threshold[k]) for s, k, e, p, _, a in got)


def test_texts_are_scanned_apart(boosted):
    r = random.Random(5)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 4))) for _ in range(80)] + [None, ""]
    assert list(private.spans_of(texts, boosted)) == [boosted.spans(t or "") for t in texts]


@pytest.mark.parametrize(("text", "found"), [
    ("call (415) 555-0134 now, bob [at] corp [dot] com; License, Version 2.0 of 2004-01-12, page 120 and 3.14159", ["(415) 555-0134", "bob [at] corp [dot] com"]),
    ("Visa 4111 1111 1111 1111 12/26", ["4111 1111 1111 1111"]), ("card 4111111111111111 123", ["4111111111111111"]), ("phone 555-123-4567 555-987-6543", ["555-123-4567", "555-987-6543"]),
    ("from 2004-01-12 to 2005, 1234567 of them, isbn 978-1-2345-6789-0", []),
])
def test_added_spans(boosted, text, found):
    assert [text[s:e] for s, _, e, *_ in boosted.spans(text)] == found


def test_redaction():
    assert private.redacted("a x@y.zz b", [(2, 0, 8)]) == "a [EMAIL] b"
    assert private.redacted("abcdef", [(1, 3, 4), (2, 2, 5)]) == "a[PHONE]f"


def test_digits_alone_take_linear_time(boosted):
    for text in ("7" * 2_000_000, "1 2 3 4 " * 20_000, "1.2.3.4." * 20_000, "a@" * 200_000, "+1" * 200_000, "a@b.c" * 50_000):
        began = time.perf_counter()
        boosted.spans(text)
        assert time.perf_counter() - began < 30


def test_personal_data_of_odd_rows(spark, boosted):
    got = {(r.doc_id): r for r in private.digests(private.find(odd(spark), boosted)).collect()}
    assert len(got) == 8 and all(r.n_email == r.n_card == 0 and r.spans == r.scores == r.accepted == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got.values())
    kept = private.redact(rows(spark, [None, "mail a@b.cc 1"]), boosted).orderBy("doc_id").collect()
    assert [r.text for r in kept] == [None, "mail [EMAIL] 1"] and kept[0].asDict().keys() == odd(spark).first().asDict().keys()
    assert private.find(odd(spark).limit(0)).count() == 0


def test_contexts_of_the_documents(spark):
    texts = [f"some words before card {'4111 1111 1111 1111' if i % 2 else '2004-01-12 of 1234567'} and after" for i in range(40)]
    held = private.contexts(rows(spark, texts), fit_spans=10)
    assert [k for _, _, k, _ in held] == [2] * 10 + [-1] * 10
    assert {t[s:e] for t, s, k, e in held if k == 2} == {"4111 1111 1111 1111"} and all(t in texts or any(t in x for x in texts) for t, *_ in held)
    assert held == private.contexts(rows(spark, texts), fit_spans=10)


# -- repeated passages


def brute_passages(texts, size):
    held, out = {}, set()
    texts = [(i, SPACE.findall(lowered(t))) for i, t in texts]
    for i, w in texts:
        for p in range(len(w) - size + 1):
            held.setdefault(tuple(w[p : p + size]), set()).add(i)
    for i, w in texts:
        run = None
        for p in range(len(w) - size + 2):
            others = held[tuple(w[p : p + size])] - {i} if p <= len(w) - size else set()
            if run and others and min(others) == run[1]:
                continue
            if run:
                out.add((i, run[0], p - 1 + size, run[1]))
            run = (p, min(others)) if others else None
    return out


def test_passages_link_all_holders(spark):
    """Passages that stand side by side, each shared with another document."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "xyz")
    texts = [three, one, f"{one} {two}", f"{two} {three}"]
    got = {(x.doc_id, x.start, x.end, x.other_id) for x in repeats.passages(rows(spark, texts, [0, 1, 2, 9])).collect()}
    assert got == {(0, 0, 60, 9), (1, 0, 60, 2), (2, 0, 60, 1), (2, 60, 120, 9), (9, 0, 60, 2), (9, 60, 120, 0)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_passages_by_brute_force(spark, seed):
    r = random.Random(seed)
    word = lambda: r.choice("abcdefghijklmnop") * r.randint(1, 3)
    shared = [" ".join(word() for _ in range(r.randint(5, 25))) for _ in range(8)]
    texts = []
    for _ in range(60):
        parts = [r.choice(shared) if r.random() < 0.4 else " ".join(word() for _ in range(r.randint(1, 12))) for _ in range(r.randint(1, 6))]
        texts.append(" ".join([*parts, "zz " * r.choice([0, 0, 30])]))
    for size, anchor, crowd in ((8, 3, 4096), (8, 3, 4), (12, 12, 4096), (6, 1, 4096), (6, 1, 1)):  # the last ones: all anchors are crowds'
        got = {(x.doc_id, x.start, x.end, x.other_id) for x in repeats.passages(rows(spark, texts), size, anchor, crowd).collect()}
        assert got == brute_passages(list(enumerate(texts)), size)


def test_passages_of_odd_rows(spark):
    got = repeats.passages(odd(spark).unionByName(rows(spark, ["a " * 3000], [60])), 50).collect()
    assert {(r.doc_id, r.start, r.end, r.other_id) for r in got} == {(6, 0, 3000, 60), (60, 0, 3000, 6)}
    nameless = repeats.passages(rows(spark, ["q w e r t y"] * 2, [None, 5]), 4, 2).collect()
    assert {(r.doc_id, r.other_id) for r in nameless} == {(None, 5), (5, None)}
    assert repeats.passages(odd(spark).limit(0)).count() == 0


# -- decontamination


def brute_contamination(text, items, size=10):
    w = ALNUM.findall(lowered(text))
    hit, ids = set(), set()
    for item, t in items:
        v = ALNUM.findall(lowered(t))
        for i in range(max(1, len(v) - size + 1)) if v else ():
            g = v[i : i + size]
            for p in range(len(w) - len(g) + 1):
                if w[p : p + len(g)] == g:
                    hit |= set(range(p, p + len(g)))
                    ids |= {str(item)} if item is not None else set()
    return len(w), len(hit), sorted(ids)


@pytest.mark.parametrize("block_bytes", [64 << 20, 20_000])
def test_contamination_by_brute_force(spark, block_bytes):
    r = random.Random(5)
    word = lambda: r.choice(["a", "b", "the", "Ä", "x1", "C"])
    items = [(i, " ".join(word() for _ in range(r.randint(0, 18)))) for i in range(25)] + [(7, "a b"), (None, "a the"), (30, None)]
    texts = [" ".join([*(word() for _ in range(r.randint(0, 30))), r.choice(items)[1] or "", *(word() for _ in range(9))]) for _ in range(40)] + ODD
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = {x.doc_id: (x.n_words, x.n_hit, list(x["items"])) for x in decontaminate.contamination(rows(spark, texts), bench, 10, block_bytes).collect()}
    assert got == {i: brute_contamination(t, items) for i, t in enumerate(texts)}


def test_contamination_of_odd_tables(spark):
    bench = spark.createDataFrame([(1, "same text of some words")], "item_id long, text string")
    got = decontaminate.contamination(odd(spark), bench).collect()
    assert len(got) == len(ODD) and sorted(r.doc_id for r in got if r.n_hit) == [8, 8]
    assert decontaminate.contamination(odd(spark).limit(0), bench).count() == 0
    assert all(r.n_hit == 0 for r in decontaminate.contamination(odd(spark), bench.limit(0)).collect())
    assert decontaminate.cleaned(odd(spark), bench).count() == len(ODD) - 2


def brute_near(text, phrase, slop):
    w, p = ALNUM.findall(lowered(text)), ALNUM.findall(lowered(phrase))
    spans = {(a, b) for a in range(len(w)) for b in range(a, min(len(w), a + len(p) + slop)) if not Counter(p) - Counter(w[a : b + 1])} if p else set()
    return {(a, b + 1) for a, b in spans if not any((c, d) != (a, b) and a <= c and d <= b for c, d in spans)}


def brute_exact(text, phrase):
    w, p = ALNUM.findall(lowered(text)), ALNUM.findall(lowered(phrase))
    return {(a, a + len(p)) for a in range(len(w) - len(p) + 1) if w[a : a + len(p)] == p} if p else set()


def test_matches_by_brute_force(spark):
    r = random.Random(9)
    texts = [" ".join(r.choice(["a", "b", "c", "d", "E", "é"]) for _ in range(r.randint(0, 40))) for _ in range(60)] + ODD
    phrases = ["a b c", "A B C", "a a", "d é e", "c", "q a", "", "b a b a", "same text of", "words same"]
    docs = rows(spark, texts)
    for slop in (None, 0, 2, 5):
        got = {}
        for x in decontaminate.matches(docs, phrases, slop).collect():
            assert (x.start, x.end) not in got.setdefault((x.doc_id, x.phrase), set())
            got[x.doc_id, x.phrase].add((x.start, x.end))
        want = {(i, p): found for i, t in enumerate(texts) for p in phrases if (found := brute_exact(t, p) if slop is None else brute_near(t, p, slop))}
        assert got == want
    assert decontaminate.matches(docs, [], 2).count() == 0 and decontaminate.matches(docs.limit(0), phrases).count() == 0


def test_near_on_either_side(spark):
    texts = ["x x x x x red x green blue", "green x red x x x x x blue", "green x x x x red x x x blue"]
    assert {(x.doc_id, x.start, x.end) for x in decontaminate.matches(rows(spark, texts), ["red green blue"], 2).collect()} == {(0, 5, 9)}


# -- secrets


def brute_secrets(text):
    out = [(m.start(), "assign", m.end()) for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m.group(1)) >= 6]
    out += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    rank = ["assign", "access", "hex"]
    return sorted(out, key=lambda x: (x[0], rank.index(x[1])))


def test_secrets_by_brute_force(spark):
    r = random.Random(2)
    bits = ["secret=", "token : ", "API_KEY='", "abc", "abcdef12", "AKIA", "Q" * 16, "AKIA" + "X9" * 9, "f" * 24, "0a" * 11, " ", "😀", "é", "password", "=", "\n", "k9" * 12]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(1, 14))) for _ in range(200)] + ["secret=token : abcdefgh"]
    found, spans = secrets.spans(rows(spark, texts))
    got = {}
    for x in found.join(spans, "row").filter("kind < 3").collect():
        got.setdefault(x.doc_id, []).append((x.start, secrets.KINDS[x.kind], x.end))
    for i, t in enumerate(texts):
        assert sorted(got.get(i, [])) == sorted(brute_secrets(t)), t


def test_ownership(spark):
    wide, own = "token=" + "abcd1234" * 3, "token=" + "live9876" * 3
    data = spark.createDataFrame([(i, wide, f"s{i}") for i in range(4)] + [(9, own, "s1"), (10, own, "s1"), (11, None, None), (None, "", None)], "doc_id long, text string, source string")
    found, spans = secrets.spans(data)
    assert found.count() == 8
    got = found.join(spans, "row").filter("kind = 0").collect()
    assert {(r.doc_id, r.n_docs, r.n_owners, r.live) for r in got} == {(i, 4, 4, False) for i in range(4)} | {(9, 2, 1, True), (10, 2, 1, True)}
    assert secrets.spans(data.limit(0))[0].count() == 0


# -- chat


def test_chat_round_trip(spark):
    r = random.Random(1)
    bits = ["\\", "#", "### ", "</turn>", " </turn>\n", ": ", "<", "a", "\n", "😀", "### assistant: "]
    data, want = [], {}
    for c in range(40):
        turns = [(r.choice(["user", "assistant", "system", "x:y#"]), "".join(r.choice(bits) for _ in range(r.randint(0, 8)))) for _ in range(r.choice([1, 2, 150]))]
        want[c] = turns
        data += [(c, i, role, text) for i, (role, text) in enumerate(turns)]
    r.shuffle(data)
    got = chat.conversations_digest(spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(3)).collect()
    for x in got:
        turns = want[x.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert x.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (x.n_turns, x.loss_chars, x.loss_sha256) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert len(got) == 40


def test_chat_machine(spark):
    good = [["user", "assistant"], ["system", "user", "assistant", "user", "assistant"], ["user", "assistant"] * 100]
    bad = [(["assistant"], 0), (["user"], None), (["user", "user", "assistant"], 1), (["user", None], 1), (["user", "assistant", "system"], 2), (["user", "assistant"] * 40 + ["tool", "user"], 80), (["system", "assistant"] + ["user", "assistant"] * 70, 1), (["user", "assistant"] * 64 + ["assistant"], 128)]
    data = [(c, i, role, None) for c, roles in enumerate(good + [r for r, _ in bad]) for i, role in enumerate(roles)]
    got = {r.conv_id: (r.valid, r.first_bad) for r in chat.conversations_digest(spark.createDataFrame(data, "conv_id long, turn long, role string, text string")).collect()}
    assert [got[c] for c in range(len(got))] == [(True, None)] * 3 + [(False, at) for _, at in bad]
    assert chat.conversations_digest(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# -- Jaccard join


def brute_classes(texts, k, percent):
    sets = []
    for t in texts:
        w = SPACE.findall(lowered(t))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)]) if w else frozenset())
    top = list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


@pytest.mark.parametrize(("k", "percent", "block"), [(3, 90, 1 << 18), (5, 80, 1 << 18), (2, 50, 60), (1, 60, 40), (3, 70, 100)])
def test_classes_by_brute_force(spark, k, percent, block):
    r = random.Random(k * percent)
    word = lambda: r.choice("abcdefghijklmnopqrstuvw") * r.randint(1, 2)
    seeds = [[word() for _ in range(r.randint(1, 60))] for _ in range(12)]
    texts = []
    for _ in range(150):
        w = list(r.choice(seeds))
        for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
            at = r.randrange(len(w))
            w[at : at + r.choice([0, 1])] = [word()]
        texts.append(" ".join(w))
    texts += [t or "" for t in ODD[:4]]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.classes(rows(spark, texts), k, percent, block).collect()}
    assert got == brute_classes(texts, k, percent)


@pytest.mark.parametrize(("k", "percent", "sizes"), [(5, 80, (4, 8, 12)), (3, 90, (9, 18, 27, 36))])
def test_sets_within_larger_ones(spark, k, percent, sizes):
    """A set and the same with as many more shingles as a link allows, under many hashes."""
    texts, want = [], {}
    for n in sizes:
        for s in range(40):
            m = n * 100 // percent
            w = [f"w{n}x{s}x{i}" for i in range(m + k - 1)]
            want |= {len(texts): (n, len(texts)), len(texts) + 1: (m, len(texts))}
            texts += [" ".join(w[: n + k - 1]), " ".join(w)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.classes(rows(spark, texts), k, percent).collect()}
    assert got == want


@pytest.mark.parametrize("percent", [30, 50, 60, 70, 80, 90, 95])
def test_least_met_of_all_sizes(percent):
    for n in range(1, 400):
        for m in range(-(-percent * n // 100), 100 * n // percent + 1):
            i = -(-percent * (n + m) // (100 + percent))  # the least intersection
            if 0 < i <= min(n, m):
                assert 1 <= jaccard.met(n, percent) <= min(jaccard.drawn(n, percent) - n + i, jaccard.drawn(m, percent) - m + i)


@pytest.mark.parametrize("together", [1, 40, 1 << 20])
def test_sieve_counts_no_less(spark, together):
    """Of each set at least as many drawn shingles as other sets draw too; exactly so many where a set is seen once."""
    r = random.Random(together)
    texts = [" ".join(r.choice("abcdefgh") for _ in range(r.randint(3, 30))) for _ in range(80)] + ["a b c d e f g h a b"] * 20
    got = {(x.digest, x.n): x.several for x in jaccard.counted(jaccard.thinned(rows(spark, texts), 3, 70, together)).collect()}
    sets = {}
    for own in words.shingle_sets(pa.array(texts), 3):
        sets[jaccard._digest(own)] = (len(own), frozenset(own[: jaccard.drawn(len(own), 70)].tolist()))
    held = Counter(x for _, own in sets.values() for x in own)
    want = {(d, n): sum(held[x] > 1 for x in own) for d, (n, own) in sets.items()}
    assert {k for k, v in want.items() if v} == set(got) and all(got[k] >= want[k] for k in got)


def test_classes_of_odd_rows(spark):
    got = jaccard.classes(odd(spark), 3, 90).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in got}
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[4] == (1, 4) and by[8] == (4, 8) and by[None] == (2, None)
    kept = jaccard.deduplicated(odd(spark), 3, 90)
    assert kept.count() == len(ODD) - 1 and kept.columns == odd(spark).columns
    assert jaccard.classes(odd(spark).limit(0), 3, 90).count() == 0 and jaccard.deduplicated(odd(spark).limit(0)).count() == 0


def test_streams_of_rows_across_batches(spark):
    """Groups that span Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        texts = ["a b c d e f g h"] * 9 + ["a b c d e f g x", "q r s t u v w x"] * 2
        got = {(x.doc_id, x.start, x.end, x.other_id) for x in repeats.passages(rows(spark, texts), 4, 2).collect()}
        assert got == brute_passages(list(enumerate(texts)), 4)
        data = [(s, d, 5) for s in range(4) for d in range(s * 4)]
        out = jaccard.common(spark.createDataFrame(data + data, jaccard.ROWS).repartition(2), 6).collect()
        assert sorted((x.shingle, x.digest, x.holders) for x in out) == sorted((s, d, min(6, s * 4)) for s, d, _ in data if s * 4 > 1)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_components(spark):
    from vellumq.llm.components import components

    r = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100 + r.randrange(50), 100 + r.randrange(50)) for _ in range(30)] + [(500, x) for x in range(501, 540)]
    edges = [(a, b) for a, b in edges if a != b]
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).collect()}
    top = {}

    def find(x):
        while top.get(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    assert got == {x: find(x) for e in edges for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- very long texts


LONG = 5_000_000


def test_very_long_texts(spark, boosted):
    """Texts of 5 MB, alike but for a word, and one of digits."""
    base = " ".join(f"w{i}" for i in range(640_000))[:LONG]
    texts = [base, base.replace(" w77 ", " other "), "1" * LONG, "tail"]
    docs = rows(spark, texts).repartition(2)
    assert {(x.doc_id, x.start, x.end) for x in repeats.passages(docs).collect()} == {(0, 0, 77), (1, 0, 77), (0, 78, len(base.split())), (1, 78, len(base.split()))}
    bench = spark.createDataFrame([(1, " ".join(base.split()[-30:]))], "item_id long, text string")
    assert {(x.doc_id, x.n_hit) for x in decontaminate.contamination(docs, bench).collect()} == {(0, 30), (1, 30), (2, 0), (3, 0)}
    assert {x.doc_id: x.component_id for x in jaccard.classes(docs, 5, 80).collect()} == {0: 0, 1: 0, 2: 2, 3: 3}
    assert all(len(x.spans) == 0 for x in private.find(docs, boosted).collect())
    found, spans = secrets.spans(docs)
    assert {(x.kind, x.end) for x in spans.filter("kind < 3").collect()} == {(2, LONG)} and found.count() == 4
    conv = spark.createDataFrame([(1, 0, "user", base), (1, 1, "assistant", texts[2])], "conv_id long, turn long, role string, text string")
    assert [(x.loss_chars, x.valid) for x in chat.conversations_digest(conv).collect()] == [(LONG, True)]


def test_very_long_texts_are_packed(spark):
    text = "some plain words of a long text, " * (LONG // 33)
    got = packing.pack_documents(rows(spark, [text])).collect()
    assert sum(x.length for x in got) == got[0].doc_tokens and [x.length for x in sorted(got, key=lambda x: x.start)] == packing.cuts(got[0].doc_tokens, 1024)


def test_names_that_clash(spark):
    texts = ["some text that two of them have in full here"] * 2 + ["lead some text that two", None]
    extra = [F.lit(1).alias(n) for n in ("class", "digest", "mark", "KEY_", "hash_", "row", "doc", "segment", "at", "n", "items", "order", "owner", "other")]
    docs = rows(spark, texts).select("*", *extra)
    bench = spark.createDataFrame([(1, "lead some text", 5)], "item_id long, text string, key int")
    clean = decontaminate.cleaned(docs, bench)
    assert clean.columns == docs.columns and sorted(x.doc_id for x in clean.collect()) == [0, 1, 3]
    kept = jaccard.deduplicated(docs, 3, 90)
    assert kept.columns == docs.columns and sorted(x.doc_id for x in kept.collect()) == [0, 2, 3]
    assert repeats.passages(docs, 4, 2).count() > 0 and packing.pack_documents(docs).count() > 3 and private.redact(docs, private.Model([])).columns == docs.columns
    assert secrets.spans(docs.withColumn("end", F.lit(1)))[0].count() == 4


def test_groups_of_the_index_hold_few_segments(spark):
    """A reader takes a whole group of rows at once, so a group holds a segment or two, however many the task wrote."""
    from urllib.parse import urlparse

    import pyarrow.parquet as pq

    from vellumq.llm import decontaminate

    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(400_000)), lambda i: F.conv(F.xxhash64(i, "doc_id").cast("string"), 10, 36)), " ")
    index = decontaminate.indexed(spark.range(1, 7, 1, 1).select(F.col("id").alias("doc_id")).withColumn("text", text))
    files = [pq.ParquetFile(urlparse(f).path).metadata for f in index.inputFiles()]
    assert index.count() == 6
    assert max(m.row_group(k).num_rows for m in files for k in range(m.num_row_groups)) <= 2
