"""Template removal on planted hosts, whose class names say nothing, against the texts that were planted."""

import time

import pytest

from curblake.llm import op7_html

SCHEMA = "page_id long, url string, html string"
PAGE = "<html><head><title>t</title></head><body><nav>menu</nav><div class='ad'>buy</div><article><h1>Head &amp; line</h1><p>One  <i>two</i><br>three<p>Four &lt; five</article><div class='comments'><article><p>me first</p></article></div><footer>c</footer></body>"


def names(source):
    return op7_html.Page(source).by_names()


def test_html_without_counts():
    assert names(PAGE) == "Head & line\n\nOne two three\n\nFour < five"
    assert names("<p title='a>b'>x</p><script>if (a<b) '</p>'</script>y<ul><li>1<li>2</ul>") == "x\n\ny\n\n1\n\n2"
    assert names("") == "" and names("<<< a < b <") == "<<< a < b <"
    assert names("<p class=\"x>a &#233;&nbsp;b</p>") != "" and names("</p></div>a") == "a"


def planted(i, host="h.com", menu=None):
    """A page of unnamed or meaninglessly named elements, and its main text."""
    blocks = [f"Heading of page {i}", *[f"Paragraph {j} of page {i} with {'some more ' * (j + i % 4)}words" for j in range(2 + i % 5)]]
    links = "".join(f"<li><a href='/{w}'>{w}</a>" for w in menu or "alpha beta gamma delta".split())
    body = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b}</p>" for b in blocks[1:])
    page = f"<body><div class=q1><ul>{links}</ul></div><div class='k{i}'>Buy offer {i * 7 % 5} now</div><div class=z9>{body}<div class=z7><p>Write to our letter</p></div></div><div class=x2>(c) {host} {i}</div></body>"
    return page, "\n\n".join(blocks)


def extracted(spark, rows, **kw):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' AS text", "'h' AS host", "1 AS many", "2 AS n_chars")
    return {r.page_id: r for r in op7_html.extract(frame, **kw).collect()}


def test_html_recurrence_decides_on_meaningless_names(spark):
    rows = [(i, f"http://H.com/{i}", planted(i)[0]) for i in range(40)]
    # every page with another menu: the skeleton recurs
    rows += [(100 + i, f"http://v.com/{i}", planted(i, "v.com", [f"w{i}{j}" for j in range(3 + i % 3)])[0]) for i in range(12)]
    got = extracted(spark, rows)
    for i in range(40):
        assert got[i].text == planted(i)[1] and got[i].n_chars == len(got[i].text)
    for i in range(12):
        assert got[100 + i].text == planted(i)[1]
    # without counts, names that say nothing leave all of it
    assert "alpha" in extracted(spark, rows, least=1000)[3].text


@pytest.mark.parametrize("pages", [op7_html.PAGES - 1, op7_html.PAGES])
def test_html_both_sides_of_the_least_number_of_pages(spark, pages):
    got = extracted(spark, [(i, f"http://h.com/{i}", planted(i)[0]) for i in range(pages)])
    assert all((r.text == planted(i)[1]) == (pages >= op7_html.PAGES) for i, r in got.items())


def test_html_share_of_pages_bounds_what_recurs(spark):
    notice = "<section class=z3><p>Only in these</p></section>"
    rows = [(i, f"http://h.com/{i}", planted(i)[0].replace("<h1>", notice + "<h1>") if i < 8 else planted(i)[0]) for i in range(40)]
    assert extracted(spark, rows)[2].text == planted(2)[1]  # 8 of 40 pages
    assert extracted(spark, rows, share=0.5)[2].text.startswith("Only in these")


def test_html_copies_of_an_article_stay_whole(spark):
    article = "<article><section><p>First part here</p></section><section><p>Second part here</p></section><section><p>Third part here</p></section></article>"
    rows = [(i, f"http://h.com/{i}", planted(i)[0].replace("<div class=z9>", "<article>").replace("</p></div><div class=x2>", "</p></article><div class=x2>")) for i in range(20)]
    rows += [(100 + i, f"http://h.com/a{i}", f"<body>{article}</body>") for i in range(9)]
    got = extracted(spark, rows)
    assert all(got[100 + i].text == "First part here\n\nSecond part here\n\nThird part here" for i in range(9))


def test_html_comments_and_declared_elements_go(spark):
    page = lambda i: f"<body><article><h2>Title {i}</h2><p>Text {i} {'long ' * 20}</p><div class='comment-list'><p>I, reader {i * 17}, think so</p></div><aside>{i} aside</aside><form>{i}</form></article><nav>{i}</nav></body>"
    got = extracted(spark, [(i, f"http://h.com/{i}", page(i)) for i in range(9)])
    assert all(r.text == f"Title {i}\n\nText {i} {'long ' * 20}".strip() for i, r in got.items())


def test_html_awkward_pages(spark):
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000
    quotes = "<p a='" * 30_000 + "x"
    rows = [(1, None, None), (2, "x", ""), (3, "http://one.com/", planted(1)[0]), (None, "http://one.com/", "<p>a"), (4, "http://d.com", deep), (5, "http://q.com", quotes), (6, "http://l.com", "<article>" + "<p>word word</p>" * 30_000)]
    rows += [(7, "http://r.com", "<article><p>same page</article>")] * 6  # repeated rows
    start = time.time()
    frame = spark.createDataFrame(rows, SCHEMA)
    got = [(r.page_id, r.text) for r in op7_html.extract(frame).collect()]
    assert time.time() - start < 60
    assert len(got) == len(rows) and (1, "") in got and (2, "") in got and (None, "a") in got and (4, "deep") in got
    assert got.count((7, "same page")) == 6 and ("\n\n".join(["word word"] * 30_000)) in dict(got).values()
    assert op7_html.extract(spark.createDataFrame([], SCHEMA)).count() == 0
