"""Edits of pages' trees: literal cases, and pages that come back when edits are undone."""

import random

from vellumq.operators import edits as E
from vellumq.operators import intervals as I


def edited(spark, pages, asked):
    cut = I.pieces(spark.createDataFrame(pages, "page_id bigint, html string")).cache()
    tree = I.elements(cut).cache()
    verdicts = E.judged(cut, I.reading(cut, tree), E.blocks(cut, tree), spark.createDataFrame(asked, E.EDITS)).cache()
    return cut, verdicts, E.applied(cut, tree, verdicts).cache()


def test_literal_cases(spark):
    page = "<div><p>one <b>two<br>three</b> four</p><p>five</p><p>six</p><h2>seven</h2></div>"
    # positions: div 0, p 1, one 2, b 3, two 4, br 5, three 6, /b 7, four 8, /p 9, p 10, five 11, /p 12, p 13, six 14, /p 15, h2 16, seven 17
    wanted = {
        ("split", 6, None, None): ("<div><p>one <b>two<br></b></p><p><b>three</b> four</p><p>five</p><p>six</p><h2>seven</h2></div>", None),
        ("split", 2, None, None): (page, "first"),
        ("split", 3, None, None): (page, "no text"),
        ("heading", 11, None, 3): (page.replace("<p>five</p>", "<h3>five</h3>"), None),
        ("heading", 17, None, 3): (page, "no paragraph"),
        ("quote", 11, 14, None): (page.replace("<p>five", "<blockquote><p>five").replace("six</p>", "six</p></blockquote>"), None),
        ("quote", 14, 11, None): (page, "crosses"),
        ("merge", 8, None, None): (page.replace("four</p><p>five", "four five"), None),
        ("merge", 14, None, None): (page, "other name"),
        ("merge", 17, None, None): (page, "nothing next"),
    }
    cases = list(wanted)
    cut, verdicts, rows = edited(spark, [(i, page) for i in range(len(cases))], [(i, 1, *c) for i, c in enumerate(cases)])
    html = {r.page_id: r.html for r in E.rewritten(rows).collect()}
    why = {r.page_id: r.why for r in verdicts.collect()}
    for i, c in enumerate(cases):
        assert (html[i], why[i]) == wanted[c], c


def test_overlaps_and_clashes(spark):
    page = "<div><p>a b<br>c<br>d</p><p>e</p></div><p>f</p>"
    # div 0, p 1, a b 2, br 3, c 4, br 5, d 6, /p 7, p 8, e 9, /p 10, /div 11, p 12, f 13
    asked = [(1, 1, "split", 4, None, None), (1, 2, "split", 6, None, None), (1, 3, "split", 6, None, None), (1, 4, "heading", 4, None, 2), (1, 5, "heading", 13, None, 2), (2, 1, "merge", 2, None, None), (2, 2, "split", 4, None, None), (2, 3, "heading", 9, None, 1)]
    _, verdicts, rows = edited(spark, [(1, page), (2, page), (3, None), (4, "")], asked)
    why = {(r.page_id, r.edit_id): r.why for r in verdicts.collect()}
    assert why == {(1, 1): None, (1, 2): None, (1, 3): "clashes", (1, 4): "clashes", (1, 5): None, (2, 1): None, (2, 2): "overlaps", (2, 3): "overlaps"}
    html = {r.page_id: r.html for r in E.rewritten(rows).collect()}
    assert html == {1: "<div><p>a b<br></p><p>c<br></p><p>d</p><p>e</p></div><h2>f</h2>", 2: "<div><p>a b<br>c<br>d e</p></div><p>f</p>"}


def tree_of(r, depth=0):
    out = ""
    for _ in range(r.randrange(1, 5)):
        kind = r.random()
        out += r.choice(["w x ", "y. ", "z<br>q "]) if depth and kind < 0.4 else "<i>k</i>" if kind < 0.5 else f"<{(n := r.choice(['p', 'div', 'li', 'h2']))}>{tree_of(r, depth + 1) if depth < 4 else 't'}</{n}>"
    return out


def test_undoing_gives_the_pages_back_and_edits_leave_trees_whole(spark):
    r = random.Random(3)
    pages = [(i, tree_of(r)) for i in range(60)]
    spots = {}
    for x in I.pieces(spark.createDataFrame(pages, "page_id bigint, html string")).filter("kind = 'text'").select("page_id", "pos").collect():
        spots.setdefault(x.page_id, []).append(x.pos)
    asked = [(i, n, r.choice(["split", "merge", "heading", "quote"]), r.choice(at), r.choice(at), 2) for i, at in spots.items() for n in range(3)]
    cut, verdicts, rows = edited(spark, pages, asked)
    made = {x.kind for x in verdicts.filter("why IS NULL").select("kind").distinct().collect()}
    assert made == {"split", "merge", "heading", "quote"} and verdicts.count() == len(asked)
    back = {x.page_id: x.html for x in E.rewritten(E.undone(rows)).collect()}
    assert back == dict(pages)
    new = I.pieces(E.rewritten(rows)).cache()
    words = lambda c: {x.page_id: "".join("".join(y[1] for y in sorted(x.t)).split()) for x in c.filter("kind = 'text'").selectExpr("page_id", "struct(pos, piece) AS s").groupBy("page_id").agg({"s": "collect_list"}).toDF("page_id", "t").collect()}
    assert words(new) == words(cut)
    tags = new.filter("kind IN ('open', 'close')").groupBy("page_id").pivot("kind", ["open", "close"]).count().collect()
    assert all(x.open == x.close for x in tags)
    own = I.matched(new).select("page_id", "first", "close")
    assert own.join(I.elements(new), ["page_id", "first"]).filter("close IS NULL OR close <> last").count() == 0
