"""Main text of pages: wrappers, templates, and broken markup."""

import html
import re

from fleetlife.llm import pages


def plain(page):
    article = re.search(r"<article>(.*)</article>", page, re.DOTALL).group(1)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))]
    return "\n\n".join(p for p in parts if p)


def test_given_pages(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").withColumnRenamed("html", "h").selectExpr("url", "h as html", "page_id", "1 as host", "2 as wrapper")
    got = {r.page_id: r for r in pages.extract_text(table).collect()}
    rows = table.collect()
    assert len(got) == len(rows)
    assert all(got[r.page_id].text == plain(r.html) and got[r.page_id].url == r.url for r in rows)


def extract(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in pages.extract_text(frame).collect()}


def test_asides_templates_and_varying_slots(spark):
    rows = []
    for i in range(12):
        rows.append((i, f"http://h.example/{i}", f"""<html><head><title>t {i}</title><style>p{{}}</style></head><body>
            <header>Site</header><nav><a href=x>Menu {i}</a></nav><div class="cookie-notice">Accept {i}</div>
            <div id=main><h2>Head {i}</h2><p>First {i} <b>bold</b> &amp; more<p>Second&nbsp;{i}<br>line <i>x</i></p><p>Share this page</p></div>
            <aside>side {i}</aside><form>Name {i}<input></form><script>if (a < b) "<p>no {i}</p>"</script>
            <section class="comments"><p>Reader {i} says</p></section><footer>end {i}</footer></body></html>"""))
    got = extract(spark, rows)
    assert all(got[i] == f"Head {i}\n\nFirst {i} bold & more\n\nSecond {i} line x" for i in range(12))


def test_article_wins_over_what_stands_outside(spark):
    page = "<body><p>outside</p><article><header>by line</header><ul><li>one<li>two</ul><blockquote>q <em>e</em></blockquote><table><tr><td>c1<td>c2</table></article><p>after</body>"
    assert extract(spark, [(1, "http://x/1", page)]) == {1: "one\n\ntwo\n\nq e\n\nc1\n\nc2"}


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "x", ""), (3, "http://a/", "no markup &lt;b&gt; at  all"), (4, "http://a/", "<p>open <b>ended"), (5, "http://a/", "<div" * 3), (6, "http://a/", "</p></div>x"), (7, "http://a/", "<!-- never ended <p>x"), (8, "http://b/", "<div>" * 3000 + "deep" + "</div>" * 3000), (8, "http://b/", "<p>again</p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.text) for r in pages.extract_text(frame).collect())
    assert got == [(1, ""), (2, ""), (3, "no markup <b> at all"), (4, "open ended"), (5, "<div<div<div"), (6, "x"), (7, ""), (8, "again"), (8, "deep")]
    assert pages.extract_text(frame.limit(0)).collect() == []


def test_tree_matching_counts_like_the_full_recursion():
    import random

    pick = random.Random(1)

    def grown(depth):
        node = pages.Merged(pick.choice("ab"))
        if depth:
            node.children = [grown(depth - 1) for _ in range(pick.randrange(4))]
        return node

    def plain_match(a, b):
        if a.label != b.label:
            return 0
        table = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
        for i, x in enumerate(a.children):
            for j, y in enumerate(b.children):
                table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + plain_match(x, y))
        return 1 + table[-1][-1]

    for _ in range(200):
        a, b = grown(3), grown(3)
        n, pairs = pages.match(a, b)
        assert n == plain_match(a, b)
        assert len(pairs) == n


def test_classes_that_only_mention_asides(spark):
    rows = [
        (1, "http://a/1", '<body class="has-sidebar comments-open"><article class="related-article"><p>Hello world</p></article>'),
        (2, "http://b/1", '<body class="page-with-menu"><div id="main"><p>Text</p><div class="cookie-notice">no</div><ul class="site-menu"><li>no</ul><p class="advertising-law">Kept</p></div>'),
    ]
    assert extract(spark, rows) == {1: "Hello world", 2: "Text\n\nKept"}


def test_constant_text_of_marked_articles_stays(spark):
    rows = [(i, f"http://same.example/{i}", f"<article><p>The same paragraph.</p></article><footer>end {i}</footer>") for i in range(6)]
    assert set(extract(spark, rows).values()) == {"The same paragraph."}


def test_broken_markup_takes_linear_time():
    import time

    n = 40_000
    for page in ("<a " * n, '<a "' * n, "<a b='>" * n, "<div>" * n + "</p>" * n, "<p><x>" * n, "<li><x>" * n, "<!-- " * n, "<b>x " * n, "<b>x<hr>" * n, "<p>a<h1>b" * n):
        start = time.process_time()
        root = pages.tree(page)
        pages.blocks(root)
        pages.slotted(page, pages.written(pages.merged(root)))
        assert time.process_time() - start < 12, page[:10]


def test_quoted_ends_of_tags():
    assert [t for _, t, *_ in pages.blocks(pages.tree("""<p title="a > b" data='>'>one</p><p>1 < 2 > 0</p><p x=">two"""))] == ["one", "1 < 2 > 0", 'two']
