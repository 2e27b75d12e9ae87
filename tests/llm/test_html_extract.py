import html
import json
import random
import re

import pytest

from tessera.llm import html_extract as hx

PAGE = (
    '<html><head><title>T</title><style>p{}</style></head><body><header>H</header><nav><ul><li>m1<li>m2</ul></nav>'
    '<div id="cookie-notice">c</div><div class="content"><h1>T&amp;T &lt;x&gt;</h1><p>a  b<br>c&nbsp;d<p>e <b>f</b>'
    "<ul><li>x<li>y</ul><script>var t='<p>no</p>'</script><div class=\"comments\"><p>no</p></div><form><p>no</p></form></div>"
    "<aside>s</aside><footer>f</footer>"
)
TEXT = "T&T <x>\n\na b c d\n\ne f\n\nx\n\ny"


def texts(spark, rows):
    pages = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, host string, expression int")
    return [tuple(r) for r in hx.extract(pages).collect()]


def test_boilerplate_goes(spark):
    assert texts(spark, [(1, "http://a.b/x", PAGE)]) == [(1, "http://a.b/x", TEXT, len(TEXT))]


def test_odd_pages(spark):
    rows = [
        (1, None, None), (None, "x", ""), (2, "http://a/1", "plain &amp; <i>x</i> <!-- open"), (2, "http://a/1", "plain &amp; <i>x</i> <!-- open"),
        (3, "http://a/2", "<p>" * 3000 + "deep" + "<div>" * 3000 + "er"), (4, "http://a/3", "<article>" + "w " * 50_000),
        (5, "http://a/4", "<div class='ad'>buy</div>"), (6, "http://a/5", "<article><p>in</article>out<p class=x<y>z"),
    ]
    got = {(i, u): t for i, u, t, n in texts(spark, rows)}
    assert got[1, None] == "" and got[None, "x"] == "" and got[2, "http://a/1"] == "plain & x"
    assert got[3, "http://a/2"] == "deep\n\ner"
    assert got[4, "http://a/3"] == " ".join(["w"] * 50_000)
    assert got[5, "http://a/4"] == "" and got[6, "http://a/5"] == "in"
    assert texts(spark, []) == []


def test_kinds_hold_at_any_depth(spark):
    for n in (10, 63, 64, 65, 300):
        deep = "<div>" * n
        rows = [
            (1, "http://a/1", deep + "<p>x</p><footer>f</footer><div class=comments><p>c</p></div>"),
            (2, "http://b/1", "<p>out</p>" + deep + "<article><p>in</p><nav>n</nav></article><p>out</p>"),
            (3, "http://c/1", "<p>out</p>" + deep + "<aside><article>no</article></aside><main>in</main>"),
        ]
        assert {i: t for i, _, t, _ in texts(spark, rows)} == {1: "x", 2: "in", 3: "in"}, n


def test_wrappers_have_repeats_and_options(spark):
    pages = [
        (i, "http://h.com/%d" % i, "<body><nav>n</nav>" + ("<aside>s</aside>" if i % 2 else "") + "<article><h1>t</h1>" + "<p>x</p>" * (i % 4) + "</article>")
        for i in range(20)
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    (row,) = hx.wrappers(df).collect()
    assert (row.host, row.n) == ("h.com", 20)
    (body,) = json.loads(row.expression)[2]
    assert body[3] == 20
    nav, aside, article = body[2]
    assert [nav[:2], aside[:2], article[:2]] == [["nav:-", ""], ["aside:-", "?"], ["article:0", ""]]
    assert aside[3] == 10
    assert [c[:2] for c in article[2]] == [["h1", ""], ["p", "+?"]]
    assert all(t.startswith("t") and "s" not in t for _, _, t, _ in texts(spark, pages))


def test_table_of_pages(spark):
    """The tables' pages are article pages: compare with their markup."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in hx.digest(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = re.split(r"</?h1>|</?p>", inside)
        words = [" ".join(html.unescape(re.sub(r"</?b>", "", p).replace("<br>", " ")).split()) for p in parts]
        assert got[r.page_id] == "\n\n".join(w for w in words if w)


BODY = "<h1>Title</h1><p>Body one.</p><p>Body two.</p>"
WHOLE = "Title\n\nBody one.\n\nBody two."


@pytest.mark.parametrize("page", [
    "<form><article>%s</article><input></form>",
    "<div class='has-sidebar'><main>%s</main><div class=sidebar>s</div></div>",
    "<div class='no-sidebar content'>%s</div><div class=widget>w</div>",
    "<div class='social-science'>%s</div><ul class='social share'><li>s</ul>",
    "<div class='post related-content'>%s</div>",
    "<div class='related-content'><p>r</p></div><div class=post-body>%s</div>",
    "<main>%s<section id=reader-responses><article><p>first!</p></article></section></main>",
    "<main><h1>Title</h1><article><p>Body one.</p><p>Body two.</p></article></main><article>teaser of another</article>",
    "<body class='has-nav'><article>%s<div hidden>h</div><div style='display: none'>h</div><div aria-hidden=true>h</div></article>",
    "<article><h1>Title <span class=ad>buy <b>now</b></span></h1><p>Body one.</p><p>Body two.<a class=share-button>s</a></p></article>",
    "<div class=header>site</div><article>%s</article><div class='legal copyright'>(c)</div>",
    "<div>%s</div><div class=site-header>h</div><div id=cookie-notice>c</div><form><p>f</p></form>",
    "<form><div>%s</div><select><option>o</select></form>",
    "<div class=widget><article>%s</article></div>",
    "<p><span hidden>h</p>%s",
])
def test_ordinary_pages_give_their_body(page):
    made = page % BODY if "%s" in page else page
    found = hx.blocks(made)
    rank, template = hx.rules(hx.expression(found))
    assert hx.main_text(found, rank, frozenset(template)) == WHOLE


def test_template_without_names_goes(spark):
    """A menu in a table and a copyright line that every page of a host has."""
    def page(i, host):
        menu = "<table><tr><td>Home<td>About us<td>Contact</table>" if host == "a" else ""
        old = "<p>On every page too.</p>" if i % 2 else ""
        return f"<body>{menu}<div><h2>Title {i}</h2><p>Text of page {i}.</p><p>More {i}.</p>{old}</div><div>Copyright {host}</div>"

    rows = [(i, f"http://{h}.com/{i}", page(i, h)) for h in "ab" for i in range(8)]
    rows += [(100, "http://single.com/", page(1, "a")), (101, "http://same.com/1", page(2, "b")), (102, "http://same.com/2", page(2, "b")),
             (103, "http://same.com/3", page(2, "b"))]
    got = {i: t for i, u, t, n in texts(spark, rows) if "//a." in u}
    assert got == {i: f"Title {i}\n\nText of page {i}.\n\nMore {i}." + ("\n\nOn every page too." if i % 2 else "") for i in range(8)}
    rest = {i: t for i, u, t, n in texts(spark, rows) if i >= 100}
    assert rest[100].startswith("Home\n\nAbout us") and rest[101] == rest[103] == "Title 2\n\nText of page 2.\n\nMore 2.\n\nCopyright b"


def _random_tree(rng, depth=0):
    if depth == 3 or rng.random() < 0.3:
        return ("#", ())
    return (rng.choice("abc"), tuple(_random_tree(rng, depth + 1) for _ in range(rng.randint(1, 4))))


def _found(tree):
    """The blocks of a tree, as ``blocks`` gives them."""
    out, count = [], [0]

    def walk(node, path, numbers):
        if node[0] == "#":
            out.append((path, numbers, f"text {len(out) % 2}", ""))
            return
        count[0] += 1
        mine = count[0]
        for child in node[1]:
            walk(child, (*path, node[0]), (*numbers, mine))

    for child in tree:
        walk(child, (), ())
    return out


def _accepts(node, tree):
    """Whether the expression describes the page's tree, by trying all ways."""
    if node[0].startswith("#") or tree[0] == "#":
        return node[0].startswith("#") and tree[0] == "#"
    return node[0] == tree[0] and _accepts_all(node[2], tree[1])


def _accepts_all(nodes, trees):
    if not nodes:
        return not trees
    first, rest = nodes[0], nodes[1:]
    if "?" in first[1] and _accepts_all(rest, trees):
        return True
    for n in range(1, len(trees) + 1):
        if not _accepts(first, trees[n - 1]):
            return False
        if (n == 1 or "+" in first[1]) and _accepts_all(rest, trees[n:]):
            return True
    return False


def test_a_wrapper_describes_every_page_it_was_made_of():
    rng = random.Random(11)
    for _ in range(150):
        pages = [tuple(_random_tree(rng) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 5))]
        made = [hx.expression(_found(p)) for p in pages]
        wrapper = made[0]
        for m in made[1:]:
            wrapper = hx.align(wrapper, json.loads(json.dumps(m)))
        assert wrapper[3] == len(pages)
        assert all(_accepts_all(wrapper[2], p) for p in pages)


def test_the_tree_of_parts_gives_all_pages_a_wrapper(spark, monkeypatch):
    rows = [(i, "http://h.com/%d" % (i % 60), f"<div><p>Text {i}</p><ul>{'<li>x' * (i % 3)}</ul><p>Footer line</p></div>") for i in range(61)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = {r.page_id: r.text for r in hx.extract(df).collect()}
    monkeypatch.setattr(hx, "PART", 7)
    assert [(r.host, r.n) for r in hx.wrappers(df).collect()] == [("h.com", 61)]
    assert {r.page_id: r.text for r in hx.extract(df).collect()} == whole
    assert all("Footer line" not in t and "Text" in t for t in whole.values())
