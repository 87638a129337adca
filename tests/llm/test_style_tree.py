"""Style tree: its sums against a plain program, and what is left of pages."""

import math
from collections import Counter, defaultdict

import pytest

from ledgerfold.llm import style_tree
from ledgerfold.llm.dom import read_page
from tests.llm.plain import near

SKELETON = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p>";</script></head><body class="has-sidebar">
<header><a href=/>Site</a></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article><header><h1>Title &amp; {0}</h1></header><p>First <b>bold</b>
   text {0}.<br>More<p>Second&nbsp;block &lt;{0}&gt;</p><ul><li>item {0}</li></ul><div class="share">Share this</div></article>
<aside>Side</aside><section id="comments"><article class="comment"><p>Nice {0}</p></article></section>
<form><label>Mail</label><input value=x><button>Go</button></form><!-- note --><footer>&copy; us</footer>"""

CASES = [
    (SKELETON.format("x"), "Title & x\nFirst bold text x. More\nSecond block <x>\nitem x"),
    ("", ""), (None, ""), ("plain &am text", "plain &am text"), ("<p>a<p>b", "a\nb"), ("<p></p><div> </div>", ""),
    ("<div>one<div>two</div>three</div>", "one\ntwo\nthree"), ("<script>x</script><p>y</p><style>z", "y"),
    ("<main><h1>T</h1><p>x</p><div class=sidebar>s</div></main><p>out</p>", "T\nx"),
    ("<p>unclosed <b>bold", "unclosed bold"), ("a < b and c > d", "a < b and c > d"),
    ("<div style='display: none'>h</div><div hidden-x=1>v</div>", "v"),
    ("<div>" * 300 + "deep" + "</div>" * 300 + "<p>after</p>", "deep\nafter"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<p>" + "long " * 40_000 + "</p>", ("long " * 40_000).strip()),
]


@pytest.mark.parametrize("html,want", CASES)
def test_main_text_of_one_page(html, want):
    assert style_tree.main_text(html or "", set()) == want


def test_contract_rows(spark):
    pages = spark.createDataFrame(
        [(i, "http://h.example/1" if i % 2 else None, h, "x") for i, (h, _) in enumerate(CASES)] + [(0, "odd url", CASES[0][0], "x"), (None, "", "<p>n</p>", "y")],
        "page_id bigint, url string, html string, text string")
    got = style_tree.extract(pages).collect()
    assert len(got) == len(CASES) + 2
    for r in got:
        want = "n" if r.page_id is None else CASES[r.page_id][1]
        assert r.text == want and r.n_chars == len(want)
    assert style_tree.extract(pages.limit(0)).count() == 0


def site(n):
    """Pages without telling names: a bar and a box that repeat, and a body that differs."""
    return [(i, f"https://S.example:80/p/{i}", f"""<body><div class="x1"><p>Home and away</p><p>All about us</p></div>
        <div class="x2"><h2>Story {i}</h2><p>Words of page {i} alone.</p><p>Also {i * 7}</p></div><div class="x3-{1000 + i}"><p>Best of the week</p></div>""")
            for i in range(n)]


def test_the_tree_finds_what_repeats(spark):
    frame = spark.createDataFrame([*site(20), (99, "http://other.example/", site(1)[0][2])], "page_id bigint, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in style_tree.extract(frame).collect()}
    assert all(got[i] == f"Story {i}\nWords of page {i} alone.\nAlso {i * 7}" for i in range(20))
    assert got[99] == "Home and away\nAll about us\nStory 0\nWords of page 0 alone.\nAlso 0\nBest of the week"


def test_importance_is_the_plain_one(spark):
    rows = site(9) + [(50, "https://s.example:80/q", "<body><div class=x1><p>Home and away</p></div><ul><li>z<li>y</ul>")]
    tree = {r.path: r for r in style_tree.style_tree(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    pages, texts, shapes = defaultdict(set), defaultdict(lambda: defaultdict(Counter)), defaultdict(Counter)
    fans = defaultdict(list)
    for i, _, html in rows:
        nodes, blocks = read_page(html)
        for node in nodes[1:]:
            pages[node.path].add(i)
            kinds = [t for k, t in enumerate(node.children) if k == 0 or node.children[k - 1] != t]
            if kinds:
                shapes[node.path][tuple(kinds)] += 1
                fans[node.path].append(len(set(kinds)))
        for at, text, _ in blocks:
            texts[nodes[at].path][text][i] += 1
    assert set(tree) == set(pages)
    for path, r in tree.items():
        m = len(pages[path])
        assert r.pages == m
        scale = math.log(max(m, 2))
        alike = [-sum(c / sum(by.values()) * math.log(c / sum(by.values())) for c in by.values()) / math.log(max(2, len(pages[p])))
                 for p in texts if (p + "/").startswith(path + "/") for by in texts[p].values()]
        if m < 5 or not alike:
            assert r.importance is None
            continue
        total = sum(shapes[path].values())
        shape = -sum(c / total * math.log(c / total) for c in shapes[path].values()) / scale if total else 0
        keep = 0.9 ** (sum(fans[path]) / len(fans[path]) if fans[path] else 0)
        assert near(r.importance, min(1, (1 - keep) * shape + keep * (1 - sum(alike) / len(alike))))


def test_copies_and_wrappers_keep_their_text(spark):
    plain, held = site(1)[0][2], """<article><h1>Head</h1><div class="body"><p>One line.</p><ul><li>Item</li></ul><table><tr><td>Cell</td></tr></table></div>
        <div class="links"><a href=/a>More of it</a></div></article>"""
    copies = [(i, f"http://c.example/p?utm={i}", plain) for i in range(8)] + [(100 + i, f"http://d.example/p#{i}", held) for i in range(8)]
    alike = [(200 + i, f"http://e.example/{i}", held + f"<!-- {i} -->") for i in range(8)]
    frame = spark.createDataFrame(copies + alike, "page_id bigint, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in style_tree.extract(frame).collect()}
    assert all(got[i] == style_tree.main_text(plain, set()) for i in range(8))
    assert all(got[100 + i] == "Head\nOne line.\nItem\nCell\nMore of it" for i in range(8))
    assert all(got[200 + i] == "Head\nOne line.\nItem\nCell" for i in range(8))
