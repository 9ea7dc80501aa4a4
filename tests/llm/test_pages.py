import math
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandloom.llm import pages as P

SCHEMA = "page_id long, url string, html string, host string, node long, low string, text string, n_chars int"


def frame(spark, *rows):
    return spark.createDataFrame([(i, u, h, "h", 1, "l", "t", 2) for i, (u, h) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize(
    "html, text",
    [
        ("<article><h1>T</h1><p><b>One<br>two<p>Three &amp; &lt;b&gt; &amp four</article><footer>f</footer>", "T\nOne two\nThree & <b> & four"),
        ("<nav>n</nav><article>x<nav>n</nav> y<aside>a</aside></article><div>z</div>", "x\ny"),
        ("<body><div class='ad'>a</div><p>b</p><div class=\"cookie-notice\">c</div></body>", "b"),
        ("<main><p>a</p><form>f<input></form><ul><li>1<li>2</ul><div id=comments>c</div></main>", "a\n1\n2"),
        ("<script>var t='</p>';</script><style>p{}</style><p>\n a\t b </p><!-- c --><p>c", "a b\nc"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("just text", "just text"), ("", ""), (None, ""),
        ("<p>a<p", "a"), ("<article><p>a &am", "a &am"), ("</p></div><p>x</b></i>", "x"), ("<div>" * 3000 + "deep", "deep"),
        ("<article><header>h</header><p>a</p></article>", "a"), ("&copy; &#65;&#x42;", "© AB"),
    ],
)
def test_main_text(spark, html, text):
    row = P.extract(frame(spark, ("http://x.com/a", html))).first()
    assert (row.text, row.n_chars) == (text, len(text))


def site(n, same="<div class='box'>Our site since 1999</div>"):
    return [("http://x.com/%d" % k, f"<body>{same}<div class='body'><p>Text number {k} tells of {k * 7}.</p></div></body>") for k in range(n)]


def test_template_of_a_host_is_removed(spark):
    rows = P.extract(frame(spark, *site(6), ("http://y.com/", site(1)[0][1]))).collect()
    texts = {r.page_id: r.text for r in rows}
    assert texts[3] == "Text number 3 tells of 21."
    assert texts[6].startswith("Our site")  # the only page of its host


def test_copies_of_an_article_are_no_template(spark):
    rows = [("http://x.com/%d" % k, "<article><h1>T</h1><p>Same text.</p></article>") for k in range(8)]
    assert {r.text for r in P.extract(frame(spark, *rows)).collect()} == {"T\nSame text."}


def test_copies_of_a_page_count_once(spark):
    page = ("http://x.com/", "<div class='box'><p>All there is.</p></div>")
    assert {r.text for r in P.extract(frame(spark, *[page] * 9)).collect()} == {"All there is."}


def test_importance(spark):
    pages = frame(spark, *site(4)).select(F.lit("h").alias("host"), "html", F.lit(1.0).alias("weight"))
    tree = {r.node: r for r in P.style_tree(pages).collect()}
    def key(*labels):
        above = 0
        for label in labels:
            above = P.key_below(above, label)
        return above

    box, text = key("body..", "div.box.."), key("body..", "div.body..", "p..")
    body = key("body..")
    assert (tree[box].m, tree[box].importance) == (4, pytest.approx(0.0))
    assert tree[text].importance == pytest.approx(1.0)
    assert tree[body].importance == pytest.approx(0.0)
    mixed = pages.union(frame(spark, ("", "<body><p>a</p></body>")).select(F.lit("h"), "html", F.lit(1.0)))
    got = {r.node: r.importance for r in P.style_tree(mixed).collect()}
    want = -(0.8 * math.log(0.8) + 0.2 * math.log(0.2)) / math.log(5)
    assert got[body] == pytest.approx(want)


def test_odd_tables(spark):
    df = frame(spark, (None, None), ("", ""), ("nonsense", "<p>a"), ("http://x.com", "<p>a"))
    rows = P.extract(df.union(df)).collect()
    assert len(rows) == 8 and sorted(r.text for r in rows) == ["", "", "", "", "a", "a", "a", "a"]
    assert P.extract(df.limit(0)).count() == 0


def test_template_within_the_main_text_is_removed(spark):
    rows = [
        (f"http://x.com/{k}", f"<article><h1>Title {k}</h1><p>Text number {k}, <b>Note</b> {k * 7}.</p><p>Subscribe to us.</p><div><p>All rights</p></div></article>")
        for k in range(6)
    ]
    copies = [(f"http://y.com/{k}", f"<p>{k}</p><article><h1>T</h1><p>Same text.</p></article>") for k in range(6)]
    got = {r.url: r.text for r in P.extract(frame(spark, *rows, *copies)).collect()}
    assert {got[f"http://x.com/{k}"] for k in range(6)} == {f"Title {k}\nText number {k}, Note {k * 7}." for k in range(6)}
    assert {got[f"http://y.com/{k}"] for k in range(6)} == {"T\nSame text."}


@pytest.mark.parametrize(
    "html, text",
    [
        ("<div class='content has-sidebar'><article><p>a b c</p></article><div class=sidebar>s</div></div>", "a b c"),
        ("<main class='no-sidebar'><p>a</p></main>", "a"),
        ("<p>out</p><article class='post share-enabled'>a</article>", "a"),
        ("<div id='header-main'><main>a</main></div><div>a longer text outside</div>", "a"),
        ("<form><input><div><p>The whole page is a form.</p></div><div>end</div></form>", "The whole page is a form.\nend"),
        ("<article>the main text</article><div class=related><article>teaser</article></div>", "the main text"),
    ],
)
def test_names_do_not_drop_the_main_text(spark, html, text):
    assert P.extract(frame(spark, ("http://x.com/a", html))).first().text == text


@pytest.mark.parametrize(
    "html, text",
    [
        ("<![foo[ <p>z", "z"), ("a<![endif]-->b", "ab"), ("<p>x</p><!-- unclosed <p>z", "x"), ("<?php echo 1", ""),
        ("<p>a<a href=\"foo>bar", "a"), ("<p>a</p", "a"), ("x<!", "x"), ("x<![", "x"), ("x<!doctype", "x"),
        ("<p>1 < 2 & 3 &amp; x</p>", "1 < 2 & 3 & x"), ("a < b", "a < b"),
        ("<script>var a='<!--'; x</script><p>after", "after"), ("<![if IE]><p>a<![endif]>", "a"),
    ],
)
def test_markup_that_is_cut_off_or_odd(html, text):
    assert P.main_text(P.Page(html).order, set()) == text


PARTS = (
    "< > ! -- [ ] / a p div \" ' = & &# x ? <!-- --> <![ ]]> <script </script> <p> </p> </ é <article> </article> <li> "
    "<b> </i> <td> <form class=ad> <body> <br/> <p/>"
).split() + [" ", "\x00"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join))
def test_any_text_is_a_page(html):
    order = P.Page(html).order
    P.observations(order)
    assert P.main_text(order, {1}) is not None
    assert [n.at for n in order] == [*range(len(order))] and all(n.up < n.at for n in order)


def test_deep_nesting_takes_little():
    import tracemalloc

    tracemalloc.start()
    order = P.Page("<b>" * 20_000 + "x" + "</i>" * 20_000).order
    P.observations(order)
    assert P.main_text(order, set()) == "x"
    assert tracemalloc.get_traced_memory()[1] < 60e6
    tracemalloc.stop()
    assert P.main_text(P.Page("<div>" * 100_000 + "deep").order, set()) == "deep"


def plain_low(pages, threshold=P.THRESHOLD):
    """Low nodes and texts of one host, from all features of all pages."""
    pages_of, styles, texts = defaultdict(set), defaultdict(lambda: defaultdict(int)), defaultdict(lambda: defaultdict(int))
    blocks, holders = defaultdict(lambda: defaultdict(set)), defaultdict(set)
    for k, html in enumerate(sorted(set(pages))):
        for node, kind, feature, main in P.observations(P.Page(html).order):
            if kind == 0:
                pages_of[node].add(k)
            elif kind in (1, 2):
                (styles if kind == 1 else texts)[node][feature] += 1
            elif kind == 3:
                blocks[node][feature].add(main)
            else:
                holders[node].add(main)
    low = set()
    for node, on in pages_of.items():
        m = len(on)
        if m == 1:
            continue
        if texts[node]:
            worth = 1 - sum(math.log(n, m) for n in texts[node].values()) / len(texts[node])
        else:
            worth = -sum(n / m * math.log(n / m, m) for n in styles[node].values())
        low |= {node} if worth < threshold else set()
    for node, found in blocks.items():
        for feature, mains in found.items():
            if len(mains) >= P.LEAST_TEXTS and 1 - math.log(len(mains), len(holders[node])) < threshold:
                low.add(feature)
    return low


def planted(n):
    """Pages without marks, pages with marks, and pages whose template differs a little."""
    out = []
    for k in range(n):
        body = f"<div><p>Story {k} begins here.</p><p>It has {k * 3} parts and ends {k * 5}.</p></div>"
        want = f"Story {k} begins here.\nIt has {k * 3} parts and ends {k * 5}."
        out.append((f"http://plain.com/{k}", f"<body><div class=top><p>Our paper</p></div>{body}<div class=end><p>Since 1900</p></div></body>", want))
        out.append((f"http://marked.com/{k}", f"<body><p>Top</p><article>{body}<div><p>Read our other stories.</p></div></article></body>", want))
        box = "<div class=box><p>Join us today.</p></div>" if k % 2 else "<div class=box><p>Join us now.</p></div>"
        out.append((f"http://mixed.com/{k}", f"<body>{box}{body}</body>", want))
    return out


def test_tree_decides_on_planted_pages(spark):
    pages = planted(40)
    got = {r.url: r.text for r in P.extract(frame(spark, *(p[:2] for p in pages))).collect()}
    alone = {u: P.main_text(P.Page(h).order, set()) for u, h, _ in pages}
    words = lambda t: set(t.split("\n"))
    kept = sum(len(words(got[u]) & words(w)) for u, _, w in pages)
    assert kept == sum(len(words(w)) for _, _, w in pages)  # recall
    assert kept / sum(len(words(t)) for t in got.values()) == 1.0  # precision
    assert kept / sum(len(words(t)) for t in alone.values()) < 0.7  # without the tree
    for host in ("plain", "marked", "mixed"):
        of_host = [(u, h) for u, h, _ in pages if host in u]
        low = plain_low([h for _, h in of_host])
        assert all(got[u] == P.main_text(P.Page(h).order, low) for u, h in of_host)
