from __future__ import annotations

import pytest

from txlake.llm import sitetree

ROWS = "page_id long, url string, html string, host string, key long"


def text_of(page, site=None):
    return sitetree.main_text(*sitetree.parse(page), site or {})


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("", ""),
        ("plain &amp; simple\n text", "plain & simple text"),
        ("<body><nav>Menu</nav><article><h1>A&nbsp;b</h1><p>One<br>two <b>bo</b>ld</p></article><footer>f</footer>", "A b One two bold"),
        ("<article><p><b>X.<br><p>Y</p>&amp;amp;</article>tail", "X. Y &amp;"),
        ("<main><p>a<script>var t='</p>';x<1</script>b</p><style>p{}</style><!-- no --> c</main>", "ab c"),
        ("<div class='ad'>buy</div><p>text</p><div id=cookie-banner>ok?</div><form><input> name</form>", "text"),
        ("<article>a<div class='user comments'><p>first!</p></div><aside>side</aside>b</article>", "a b"),
        ("<header>site</header><article><header><h1>T</h1></header>body</article>", "T body"),
        ('<article><p title="a>b" data-x=\'c>\'>in</p></ARTICLE><DIV CLASS="Sidebar">out</DIV>', "in"),
        ("<article><ul><li>1<li>2</ul><table><tr><td>x<td>y</table></article>", "1 2 x y"),
        ("<article>a < b &lt;c&gt; <<p>d</article", "a < b <c> < d"),
        ("<p>unclosed <a href=x>link</a>, <span class=ad>ad</span>rest", "unclosed link, rest"),
        ("<article>one</article><div>mid</div><article>two</article>", "one two"),
        ("<script>never closed <p>x</p>", ""),
        ("<body class='has-sidebar'><article>in</article></body>", "in"),
        ("<div id='page' class='no-sidebar menu-open'><nav>m</nav><main>in</main></div>", "in"),
        ("<form><p>out</p><article>in <div class='share-buttons'>s</div></article><input></form>", "in"),
        ("<div class='widget'><p>out</p><div class=main><p class=search>in</p></div></div>", "in"),
        ("<div class='sidebar'><article>teaser</article></div><article>in</article>", "in"),
        ("<aside><article>teaser</article></aside><p>text</p>", "text"),
        ("<article><p class='search related'>in</p><div class='related-posts'>out</div></article>", "in"),
        ("<body class='menu'><div class='is-popup'><p>text</p></div></body>", "text"),
    ],
)
def test_blocks_of_one_page(page, expected):
    assert text_of(page) == expected


def test_deep_and_long_pages():
    assert text_of("<div>" * 30_000 + "deep") == "deep"
    long = " ".join(f"w{i}" for i in range(100_000))
    assert text_of(f"<article><p>{long}</p></article>") == long


@pytest.mark.parametrize("begin", ["<p ", "<script ", "</p ", "<!-- ", "<!x ", "<p a"])
def test_a_page_that_ends_inside_a_tag_ends_at_once(begin):
    text_of(f"<p>a</p>{begin}" + ' a="b>" c=\'d\'' * 2000)
    text_of(f"<p>a</p>{begin}" + ' a="b' * 2001)


def site(n):
    """Pages without any named part: a box that stays the same, a menu, and a text of each page's own."""
    pages = []
    for i in range(n):
        own = "".join(f"<p>page {i} line {k}</p>" for k in range(i % 4 + 2))
        pages.append((i, f"http://Site.example/{i}", f"<div class=top><p>Welcome</p><p>to us</p></div><div class=text>{own}</div><div class=low><p>All rights</p></div>"))
    return pages


def test_what_all_pages_share_goes(spark):
    rows = site(12) + [(100, "http://other.example/", "<div class=top><p>Welcome</p></div>"), (101, None, None), (102, "no url", ""), (None, None, "<p>x"), (3, *site(4)[3][1:])]
    pages = spark.createDataFrame([(*r, "h", 1) for r in rows], ROWS).repartition(3)
    found = sitetree.extract(pages)
    assert found.columns == ["page_id", "url", "text"]
    text = {}
    for r in found.collect():
        text.setdefault(r.page_id, []).append(r.text)
    for i in range(12):
        own = " ".join(f"page {i} line {k}" for k in range(i % 4 + 2))
        assert text[i] == [own] * (2 if i == 3 else 1)
    assert text[100] == ["Welcome"]  # one page tells nothing about its site
    assert text[101] == text[102] == [""] and text[None] == ["x"]
    assert sitetree.extract(pages.limit(0)).count() == 0


def test_importance_is_the_entropy_over_pages(spark):
    pages = spark.createDataFrame(
        [(i, "http://a/", f"<div><p>same</p></div><div class=b>{'<p>x</p>' * (i % 2)}<h2>t{i}</h2></div>", "h", 1) for i in range(8)], ROWS
    ).withColumn("host", sitetree.F.lit("a"))
    tree = {e.key: (round(e.shown, 6), round(e.told, 6)) for r in sitetree.site_tree(pages).collect() for e in r.elements}
    key = lambda *labels: sitetree.parse("")[0].key if not labels else sitetree._hash(f"{key(*labels[:-1])}/{labels[-1]}")
    assert tree[key("div.", "p.")] == (0.0, 0.0)  # one style and one text on all eight pages
    assert tree[key("div.b")][0] == round(1 / 3, 6)  # two styles, four pages each: log 2 / log 8
    assert tree[key("div.b", "h2.")] == (0.0, 1.0)  # a text of each page's own


def test_copies_of_a_page_are_one_page(spark):
    page = "<div class=text><p>the same words</p></div>"
    other = [(100 + i, f"http://b/{i}", f"<div class=text><p>own words {i}</p></div>") for i in range(4)]
    rows = [(i, f"http://a/{i}", page) for i in range(8)] + [(20 + i, f"http://b/x{i}", page) for i in range(30)] + other
    found = sitetree.extract(spark.createDataFrame([(*r, "h", 1) for r in rows], ROWS).repartition(3))
    text = {r.page_id: r.text for r in found.collect()}
    assert all(text[i] == "the same words" for i in (*range(8), *range(20, 50)))
    assert all(text[100 + i] == f"own words {i}" for i in range(4))


def test_a_page_of_shared_text_alone_is_not_empty():
    page = "<nav>menu</nav><div class=a><p>shared</p></div>"
    root, blocks = sitetree.parse(page)
    todo, site = [root], {}
    for node in todo:
        todo += [p for p in node.parts if isinstance(p, sitetree.Node)]
        site[node.key] = (0.0, 0.0)
    assert sitetree.main_text(root, blocks, site) == "shared"
