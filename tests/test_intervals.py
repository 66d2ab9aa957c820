"""Pages as nested intervals: literal cases, and random markup against brute force."""

import random
import re

import pytest

from vellumq.operators import intervals as I


def tree_of(spark, pages):
    cut = I.pieces(spark.createDataFrame(pages, "page_id bigint, html string").repartition(3)).cache()
    return cut, I.elements(cut).cache()


CASES = {
    1: "<div>a<p>b<i>c</i></p>d</div>",
    2: "<div><p>open<p>still</div>out",
    3: "<b>x<div>y</b>z</div>w",
    4: "</p>lone<br><img src='x'/>end",
    5: None,
    6: "<ul><li>1<ul><li>2</li></ul></li></ul>",
}


def test_elements(spark):
    _, tree = tree_of(spark, list(CASES.items()))
    rows = {}
    for r in I.nodes(tree).collect():
        rows.setdefault(r.page_id, set()).add((r.name, r.first, r.last, r.depth, r.parent))
    assert rows[1] == {("div", 0, 9, 1, None), ("p", 2, 7, 2, 0), ("i", 4, 6, 3, 2)}
    assert rows[2] == {("div", 0, 5, 1, None), ("p", 1, 5, 2, 0), ("p", 3, 5, 3, 1)}  # unclosed: they end with what holds them
    assert rows[3] == {("b", 0, 4, 1, None), ("div", 2, 4, 2, 0)}  # crossing: cut where the outer one ends
    assert 4 not in rows and 5 not in rows
    assert {(n, d) for n, _, _, d, _ in rows[6]} == {("ul", 1), ("li", 2), ("ul", 3), ("li", 4)}


def test_reading(spark):
    cut, tree = tree_of(spark, [(1, "<h1>A <em>b</em></h1><table><tr><td>c<b>d</b>e</td><th>f</th></tr></table>\n<p>g<br>h</p>i"), (2, "w<span>or</span>d &amp; <p> </p>")])
    rows = [(r.path, r.opens, r.closes, r.joins, r.words, r.head is not None, r.cell is not None) for r in I.reading(cut, tree).orderBy("page_id", "pos").collect()]
    assert rows == [
        ("h1", True, False, False, 1, True, False), ("h1/em", False, True, False, 1, True, False), ("table/tr/td", True, False, False, 1, False, True), ("table/tr/td/b", False, False, True, 1, False, True), ("table/tr/td", False, True, True, 1, False, True),
        ("table/tr/th", True, True, False, 1, False, True), ("p", True, False, False, 1, False, False), ("p", False, True, False, 1, False, False), ("", True, True, False, 1, False, False),
        ("", True, False, False, 1, False, False), ("span", False, False, True, 1, False, False), ("", False, True, True, 1, False, False),
    ]


def brute(html):
    """The same definition, comparing all positions."""
    parts = re.findall(r"<[^>]+>|[^<]+", html)
    tags = [(i, m.group(2), "close" if m.group(1) else "open") for i, p in enumerate(parts) if (m := re.match(r"<(/?)([a-z]+)", p)) and m.group(2) not in I.VOID]
    pairs = []
    for i, name, kind in tags:
        if kind == "open":
            deep, close = 0, None
            for j, other, k in tags:
                if j > i and other == name:
                    deep += 1 if k == "open" else -1
                    if deep < 0:
                        close = j
                        break
            pairs.append((i, name, close))
    out = []
    for i, name, close in pairs:
        around = [q for p, _, q in pairs if q is not None and p < i < q]
        out.append((i, min([len(parts) if close is None else close, *around]), name))
    return out


def test_random_markup(spark):
    r = random.Random(2)
    pages = [(n, "".join(r.choice(["<p>", "</p>", "<b>", "</b>", "<div>", "</div>", "text", "<br>", "w "]) for _ in range(r.choice([3, 10, 40, 400])))) for n in range(60)]
    _, tree = tree_of(spark, pages)
    got = {}
    for x in tree.collect():
        got.setdefault(x.page_id, []).append((x.first, x.last, x.name))
    for n, html in pages:
        own = sorted(got.get(n, []))
        assert own == brute(html), html
        for i, (p, q, _) in enumerate(own):  # nested, whatever the markup is
            assert all(not (p < u < q < v) for u, v, _ in own[i + 1 :])


@pytest.mark.parametrize("html", ["", "plain", "<<>>", "<p", "<!DOCTYPE html>", "< p>x</ p>"])
def test_odd_markup(spark, html):
    cut, tree = tree_of(spark, [(1, html), (2, None)])
    assert tree.count() == 0 and I.nodes(tree).count() == 0
    assert I.reading(cut, tree).filter("path <> ''").count() == 0
