import json

from tidegate.llm.html import aligned, extract, folded, main_texts, parse, shape

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="<p>no</p>";</script></head><body>
<nav><ul><li><a href=/>Home</a><li><a>About</a></ul></nav><!-- note --><div class="ad">Buy</div>
<div class="cookie-notice">We use cookies</div><aside>Side</aside>
<article class="post post-{i}"><h1>Title {i} &amp; more</h1><p><b>One<br>two  &lt;three&gt;<p>Next&nbsp;part{more}</p>
<form><input><label>Mail</label></form><div class="comments"><p>First!</p></div></article>
<footer>&copy; F</footer></body></html>"""


def rows(spark, pages):
    return spark.createDataFrame(pages, "page_id long, url string, html string")


def test_article_only(spark):
    pages = [
        (1, "http://a.example/1", PAGE.format(i=1, more="")),
        (2, "http://A.example/2", PAGE.format(i=2, more="</p><ul><li>x<li>y</ul><p>z")),
        (3, None, None),
        (4, "not a url", ""),
        (5, "http://b.example/", "<main><p>Plain <i>main</i> text</p></main><div>other</div>"),
        (5, "http://b.example/", "<main><p>Plain <i>main</i> text</p></main><div>other</div>"),
        (6, "http://c.example/", "<div id=menu>m</div><div><p>Longest text of the page by far</p><p>and more</p></div>"),
        (7, "http://d.example/", "no markup & &amp; <3"),
        (8, "http://e.example/", "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after</p>"),
        (9, "http://f.example/", "<article><p>cut off &am"),
    ]
    got = {r.page_id: r for r in main_texts(rows(spark, pages)).collect()}
    assert got[1].text == "Title 1 & more\n\nOne two <three>\n\nNext part"
    assert got[2].text == "Title 2 & more\n\nOne two <three>\n\nNext part\n\nx\n\ny\n\nz"
    assert got[3].text == "" and got[4].text == "" and got[5].text == "Plain main text"
    assert got[6].text == "Longest text of the page by far\n\nand more"
    assert got[7].text == "no markup & & <3" and got[8].text == "deep\n\nafter" and got[9].text == "cut off &am"
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert main_texts(rows(spark, pages)).count() == len(pages)
    assert main_texts(rows(spark, [])).count() == 0


def test_one_host_with_most_pages(spark):
    pages = [(i, "http://hot.example/x" if i % 3 else f"http://h{i}.example/", PAGE.format(i=i, more=" p" * (i % 5))) for i in range(300)]
    got = main_texts(rows(spark, pages)).collect()
    assert len(got) == 300
    assert all(r.text.startswith(f"Title {r.page_id} & more\n\nOne two <three>\n\nNext part") for r in got)


def test_all_blocks_without_a_region():
    long = "<p>" + "long text " * 50 + "</p>"
    page = f"<body><div id=menu>m</div><h1>Title</h1><p>Lead</p><div class=content>{long}</div><p>Closing</p></body>"
    nested = f"<div><p>A</p><div><p>B</p><div>{long}</div><p>C</p></div></div><p>D</p>"
    body = ("long text " * 50).strip()
    other = shape(parse("<article><p>x</p></article>"))
    for wrapper in (None, json.dumps(shape(parse(page))), json.dumps(other)):
        assert extract(page, wrapper) == f"Title\n\nLead\n\n{body}\n\nClosing"
        assert extract(nested, wrapper) == f"A\n\nB\n\n{body}\n\nC\n\nD"


def test_text_that_all_pages_share_is_template(spark):
    page = "<body><div class=x1>Our site</div><h1>Title {i}</h1><div class=text><p>Text {i}</p><p>Printed here</p></div></body>"
    pages = [(i, "http://plain.example/", page.format(i=i)) for i in range(4)]
    pages += [(10 + i, "http://two.example/", page.format(i=i)) for i in range(2)]
    pages += [(20 + i, "http://copies.example/", page.format(i=0)) for i in range(5)]
    pages += [(30 + i, "http://marked.example/", "<article>" + page.format(i=i) + "</article>") for i in range(4)]
    pages += [(40 + i, "http://same.example/", f"<body data-i={i}><p>All the same</p></body>") for i in range(4)]
    got = {r.page_id: r.text for r in main_texts(rows(spark, pages)).collect()}
    assert len(got) == len(pages)
    for i in range(4):
        assert got[i] == f"Title {i}\n\nText {i}"
        assert got[30 + i] == f"Our site\n\nTitle {i}\n\nText {i}\n\nPrinted here"
        assert got[40 + i] == "All the same"
    for i in range(2):
        assert got[10 + i] == f"Our site\n\nTitle {i}\n\nText {i}\n\nPrinted here"
    for i in range(5):
        assert got[20 + i] == "Our site\n\nTitle 0\n\nText 0\n\nPrinted here"


def test_alignment():
    def of(html):
        return shape(parse(html))

    assert of("<ul><li>a<li>b<li>c</ul>") == of("<ul><li>a<li>b</ul>")
    one, two = of("<h1>a</h1><p>b</p>"), of("<h1>a</h1><div>c</div><p>b</p>")
    whole = aligned(one, two)
    assert [(i[0], i[1]) for i in whole] == [("h1", False), ("div", True), ("p", False)]
    assert aligned(whole, one) == whole and aligned(whole, two) == whole
    pairs = of("<dt>a</dt><dd>b</dd><dt>a</dt><dd>b</dd><dt>a</dt><dd>b</dd>")
    assert len(pairs) == 1 and pairs[0][0] == "(" and pairs[0][2]
    assert folded([]) == []


def test_hostile_markup():
    for html in ("<" * 50_000, "<a href='" * 5_000, "<p class=\"" + "x" * 50_000, "<!--" * 5_000, "</p>" * 20_000, "&" * 50_000):
        extract(html, None)


def test_nothing_of_the_article_is_lost(spark):
    """Foreign elements that end at once, unlucky names, formulas; what is beside the article still goes."""
    body = (
        '<article class="social policy"><h1>T</h1><p>a <svg width="1"/> b</p><svg><text>no</text></svg>'
        '<div class="search-trees"><p>trees</p></div><section id="related-work"><p>earlier work</p></section>'
        '<div class="related-posts"><p>other posts</p></div><div class="share"><p>share me</p></div>'
        "<p>x <math><mi>y</mi><mo>=</mo><mn>2</mn></math> z</p><p>end</p></article>"
    )
    teaser = '<article class="post related"><p>Read this too</p></article>'
    pages = [(i, f"http://n{i % 2}.example/{i}", f"<html><body>{body}{teaser}</body></html>") for i in range(6)]
    texts = {r.text for r in main_texts(rows(spark, pages)).collect()}
    assert texts == {"T\n\na b\n\ntrees\n\nearlier work\n\nx y=2 z\n\nend"}
