"""Inputs of a megabyte that used to end the JVM, and rules at their edges."""

import pytest
from pyspark.sql import functions as F

from tarifold.functions import markup, wording
from tarifold.operators import extract, fitment, offers


@pytest.fixture
def read(spark):
    """Apply a function of the page to pages."""

    def run(function, *pages):
        df = markup.with_page(spark.createDataFrame(list(enumerate(pages)), "n int, html string"))
        return [r["r"] for r in df.select("n", function(F.col("_page")).alias("r")).orderBy("n").collect()]

    return run


def test_long_runs(one, read):
    page = lambda body: f"<h1>a{body}c</h1>"
    spaced = lambda p: markup.text_of(p, markup.first(markup.elements(p, markup.by_name("h1"))), " ")
    assert read(spaced, page("<b></b> " * 120_000), "<h1>a<i>b</i> <b>c</b>d</h1>") == ["a c", "a b c d"]
    assert one(wording.clean_description, "a" + "\n" * 1_000_000 + "b", "a<br>\n<br />b", "a\n\nb") == ["a<br>b", "a<br>b", "a\n\nb"]
    assert read(extract.dom_title, "<h1 title='" + "x" * 1_000_000 + "'>t</h1>", "<h1 " + "a=b " * 100_000 + ">u</h1>", "<h1 =" + "= " * 100_000 + ">v") == ["t", "u", "v"]


def test_long_gallery_value(read):
    script = '<script type="text/x-magento-init">{"a": [{"full": "data:image/png;base64,%s"}, {"img": "https:\\/\\/x.org\\/media\\/catalog\\/product\\/a.jpg"}]}</script>'
    long = read(extract.gallery_images, script % ("Ab\\/" * 250_000))[0]
    assert long == read(extract.gallery_images, script % "Ab")[0] == ["https://x.org/media/catalog/product/a.jpg"]


def test_failed_page_ends_paging(spark):
    rows = [("a", 1, 200), ("a", 2, 500), ("a", 3, 200), ("b", 1, None), ("b", 2, None)]
    df = spark.createDataFrame(rows, "domain string, page_no int, status int")
    got = {(r["domain"], r["page_no"]) for r in offers.usable_pages(df, F.lit(3)).collect()}
    assert got == {("a", 1), ("b", 1), ("b", 2)}


def test_makes_are_plain_text(spark):
    df = spark.createDataFrame([("kit a.b x",), ("kit acb x",)], "t string")
    assert [r[0] for r in df.select(fitment.title_make(F.col("t"), ["a.b"])).collect()] == ["a.b", ""]


def test_elements_end_at_their_own_closing_tag(read):
    """Each holder nests another element of its own name before what is looked for."""
    deep = "<div>" * 30 + "x" + "</div>" * 30
    page = f'<div class="description"><div>first</div>{deep}<p>last</p></div><div>other</div>'
    assert read(extract.dom_description, page) == [page.removesuffix("<div>other</div>")]
    value = '<div class="value"><div>a</div><div/>b</div>'
    assert read(extract.dom_description, f'<div class="description"><div>h</div>{value}</div>', '<img class="description">') == [value, '<img class="description">']
    old = '<span class="old-price"><span>was</span><span class="price">€ 1,00</span></span>'
    box = '<span class="price"><span>now</span><ins><span class="amount">€ 20,00</span></ins></span>'
    assert read(extract.dom_prices, old + box, old) == [[20.0, 20.0, 20.0], []]
    menu = '<nav><nav><a href="/a">Een</a></nav><a href="/b">Twee</a></nav>'
    crumbs = '<div class="breadcrumbs"><div><a>Een</a></div><div><a>Twee</a></div></div>'
    assert read(extract.breadcrumbs, menu, crumbs) == [["Een", "Twee"], ["Een", "Twee"]]
    assert read(extract.dom_description, '<div class="description"><div>open</div><div>a</div>') == ['<div class="description"><div>open</div><div>a</div>']


def test_character_references(read):
    """All names of the standard, decimal and hexadecimal numbers, in texts and attributes."""
    assert read(extract.dom_title, "<h1>Akrapovi&#269; R&eacute;my &#x1F3CD; &Nopf;</h1>", "<h1>&copy2024 &notit; &unknown; a&b &#0; &#150;&nbsp;</h1>") == [
        "Akrapovič Rémy 🏍 ℕ", "©2024 ¬it; &unknown; a&b \ufffd –"]
    assert read(extract.dom_prices, '<span class="price">&#8364;&nbsp;649,95</span>', '<b class=price>&euro;&#xA0;1&#46;299,00</b>') == [[649.95], [1299.0]]
    assert read(lambda p: extract.og_value(extract.open_graph(p), "og:title"), '<meta property="og:title" content="A &quot;b&quot; &#39;c&#39; &eacute;">') == ["A \"b\" 'c' é"]
    assert read(extract.breadcrumbs, "<nav><a>Slip&ndash;on</a><a>&nbsp;</a></nav>") == [["Slip–on"]]


def test_attributes_without_quotes(read):
    assert read(lambda p: extract.og_value(extract.open_graph(p), "og:title"), "<meta property=og:title content=Foo>", "<META content='F o' PROPERTY=og:title />") == ["Foo", "F o"]
    page = '<img src=/media/catalog/product/a.jpg><img data-src="/media/catalog/product/b.png" title="src=x"><a title="<h1>no</h1>">x</a>'
    assert read(lambda p: extract.dom_images(p, F.lit("https://s.nl/x")), page) == [["https://s.nl/media/catalog/product/a.jpg", "https://s.nl/media/catalog/product/b.png"]]
    assert read(extract.dom_title, page) == [""]
    assert read(extract.dom_sku, "<p itemprop=sku>A1", "<p class='x sku y'>A2</p>", "<p data-class=sku>A3</p>") == ["A1", "A2", ""]


def test_links_without_quotes(spark):
    rows = [(1, "https://s.nl/list", "<a href=/some-demper>x</a><!-- <a href='/gone-demper'> --><a href='https://s.nl/other-demper'>y</a><script>'<a href=\"/js-demper\">'</script>")]
    got = extract.product_links(spark.createDataFrame(rows, "ord int, url string, html string")).collect()
    assert {r["link"] for r in got} == {"https://s.nl/some-demper", "https://s.nl/other-demper"}


def test_comments_and_scripts_are_no_markup(read):
    page = '<div class="description">x<!-- <div> -->y<script>document.write("<div>")</script></div><div class="footer">not mine</div>'
    assert read(extract.dom_description, page) == [page.removesuffix('<div class="footer">not mine</div>')]
    assert read(extract.dom_title, "<!-- <h1>old</h1> --><h1>a<script>b</script><style>c</style>d<!-- e --></h1>", "<script>'<h1>x</h1>'</script>") == ["ad", ""]
    assert read(extract.gallery_images, '<!-- <script type="text/x-magento-init">{"img":"https://a/b.jpg"}</script> -->') == [[]]


def test_elements_that_are_never_closed(read):
    cells = "<table><caption>Geschikt voor</caption><tr><td>Merk<td>Yamaha<tr><th>Model<td>MT-<b>09</b></table><p>after"
    assert [tuple(r) for r in read(fitment.from_captioned_tables, cells)] == [("Yamaha", "MT-09", "")]
    assert read(extract.breadcrumbs, "<nav><ul><li><a>Een</a><li><a>Twee</a><ul><li><a>Drie</a></ul><li><a>Vier</nav><a>nee</a>") == [["Een", "Twee", "Drie", "Vier"]]
    assert read(extract.dom_title, "<h1>a<br>b<img src=x>c</h1>d", "</h1></p><h1>e</div>f", None, "") == ["abc", "ef", "", ""]
    deep = "<div>" * 3_000 + "<h1>x</h1>" + "</p>" * 3_000
    assert read(extract.dom_title, deep) == ["x"]


def test_work_grows_with_the_page():
    """Twenty times the links take no more than about twenty times the work (four hundred times it was)."""
    import time

    def seconds(links):
        page = "<nav>" + '<li><a href="/x">a &amp; b</a></li>' * links + "</nav>"
        start = time.process_time()
        tokens, _ = markup._cut(page)
        assert len(markup._walk(tokens)) == 2 * links + 1
        return time.process_time() - start

    seconds(500)
    assert seconds(40_000) < 80 * max(seconds(2_000), 0.004)


def test_offer_prices_by_type(one):
    offers = {
        '{"@type":"AggregateOffer","lowPrice":100.5,"offers":[{"price":"150"}]}': 100.5, '{"lowPrice":"99,95","x":{"price":7.5}}': 99.95,
        '{"price":"1.299,00"}': 1299.0, '{"price":1299}': 1299.0, '{"price":649.5}': 649.5, '{"price":6.495e2}': 649.5, '{"price":"649.5","lowPrice":1.5}': 649.5,
        '{"price":null,"lowPrice":5.5}': 0.0, '{"price":""}': 0.0, '{"price":true}': 0.0, '{"price":[1.5]}': 0.0, '{"price":-2.5}': 2.5, '{"x":1}': 0.0, '"text"': 0.0,
        '{"a":"\\"price\\": 3.5"}': 0.0, "{broken": 0.0,
    }
    assert dict(zip(offers, one(extract.ld_price, *offers))) == offers
    assert one(extract.ld_price, None) == [0.0]


def test_graph_nodes_at_any_depth(spark):
    def page(depth, key="@graph"):
        node = '{"@type":"Product","name":"deep"}'
        for _ in range(depth):
            node = f'{{"{key}":[{{"@type":"Thing"}},{node}]}}'
        return f'<script type="application/ld+json">{node}</script>'

    rows = [(i, page(d)) for i, d in enumerate([0, 1, 2, 3, 4, 12])] + [(9, page(5, "\\u0040graph"))]
    found = extract.with_json_ld(markup.with_page(spark.createDataFrame(rows, "ord int, html string"))).select("ord", "_ld.name").collect()
    assert {(r["ord"], r["name"]) for r in found} == {(i, "deep") for i, _ in rows}
