import random

from vellumq.operators import sync as Z

XML = '<div><head>A Title</head><p>I loue the Iustice of <hi>God</hi>,<note>a note</note> and vpon this &amp; that I stand in to it.</p></div>'


def test_decisions():
    out, found = Z.synced(XML, "= T\n\nA Title\n\nI love the justice of God, and upon this \\& those I stand into it.")
    assert all(Z.checks(XML, "= T\n\nA Title\n\nI love the justice of God, and upon this \\& those I stand into it.", out).values())
    kinds = {d.orig: (d.auto, d.editor, d.type) for d in found}
    assert kinds["loue"] == ("love", None, "spelling") and kinds["Iustice"] == ("Justice", "justice", "spelling") and kinds["vpon"] == ("upon", None, "spelling")
    assert kinds["that"][1] == "those" and "a note" in out and "&amp;" in out


def test_any_pair_passes_its_checks(spark):
    r = random.Random(7)
    words = ["loue", "love", "God", "god", "vnto", "unto", "a", "the", "The", "iudge", "xii", "12", "self", "him", "himself"]
    rows = []
    for i in range(300):
        a = [r.choice(words) for _ in range(r.randint(1, 12))]
        b = list(a)
        for _ in range(r.randint(0, 5)):
            at = r.randrange(len(b) + 1)
            b[at : at + r.randint(0, 2)] = [r.choice(words) for _ in range(r.randint(0, 2))]
        rows.append((i, i, Z.as_xml(" ".join(a)), " ".join(b)))
    rows += [(900, 900, "<p>", "x"), (901, 901, "<p>a</p>", None)]
    got = {x.a: x for x in Z.sync(spark.createDataFrame(rows, "a long, b long, xml string, review string")).collect()}
    assert [i for i, x in got.items() if x.failed] == [900]
    assert len(got) == 302 and got[900].failed == ["well formed"] and got[901].decisions[0].editor == ""


def test_structure_and_facets(spark):
    pair = spark.createDataFrame([(1, 2, "one two three\n\nfour five", "one two\n\nthree\n\n+ four five")], "a long, b long, text_a string, text_b string")
    assert {(x["at"], x.kind) for x in Z.structure(pair).collect()} == {(2, "split"), (3, "list")}
    same = {x.facet: x.same for x in Z.facets(spark.createDataFrame([(1, 2, "a #emph[b]", "a b")], "a long, b long, text_a string, text_b string")).collect()}
    assert same == {"words": True, "italics": False, "notes": True, "headings": True, "lists": True}


def test_small_ones(spark):
    texts = spark.createDataFrame([(1, "the holy\n word. the holy word"), (2, None)], "doc_id long, text string")
    assert {x.phrase: x.n for x in Z.once(texts, ["the holy word", "word.", "none"]).collect()} == {"the holy word": 2, "word.": 1, "none": 0}
    assert Z.signature("Your servant, J. O.") == ("Your servant,", "J. O.") and Z.signature("plain") == ("plain", "")
    rows = Z.partners(spark.createDataFrame([("g", 1, "a"), ("g", 2, "b")], "g string, n int, k string"), "g", "n", "k")
    assert {(x.k, x.before, x.after) for x in rows.collect()} == {("a", None, "b"), ("b", "a", None)}


def test_spread_by_brute_force():
    from vellumq.operators import align as A

    def plain(source, target):
        owner, at = [0] * len(target), 0
        for j, word in enumerate(target):
            likeness = [A.ratio(source[i].lower(), word.lower()) for i in range(at, len(source))]
            if likeness and max(likeness) >= 0.5:
                at += likeness.index(max(likeness))
            owner[j] = min(at, len(source) - 1)
        return [" ".join(w for w, o in zip(target, owner, strict=True) if o == i) for i in range(len(source))]

    r = random.Random(9)
    word = lambda: r.choice(["", "A", "né"]) + "".join(r.choice("abcde") for _ in range(r.randint(1, 7)))
    for _ in range(300):
        source, target = ([word() for _ in range(r.randint(1, 9))] for _ in range(2))
        target += r.sample(source, r.randint(0, len(source)))
        assert Z.spread(source, target) == plain(source, target)
    long = ["a" * 300, "a" * 250, "ab" * 150]
    assert Z.spread(long, long[::-1]) == plain(long, long[::-1])


def test_texts_are_parsed_once(monkeypatch):
    """A source and its outcome are read once each, and no word is parsed by itself."""
    seen, own = [], Z.E.fromstring
    monkeypatch.setattr(Z.E, "fromstring", lambda text: seen.append(text) or own(text))
    xml, review = Z.as_xml(" ".join(f"w{i} loue a &amp; b" for i in range(99)).replace("&amp;", "&")), " ".join(f"w{i} love a \\& b" for i in range(99))
    out, found = Z.synced(xml, review)
    assert all(Z.checks(xml, review, out).values()) and len(found) == 99
    assert len(seen) <= 3
