"""Elements of pages: nesting, missing end tags, attributes, what a parser would hide."""

from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from vitrine.functions import elements as E
from vitrine.functions import markup as M

PAGES = {
    "nested": "<ul><li><b>Period</b>: 1960s</li><li>A<ul><li>x<li>y</ul>tail<li>B: <i>c</ul>",
    "sections": "<div><li>k: v</li><li title='a > b'>w</div><p>one<p>two <b>bold</p>three<div>in<p>four</div>five",
    "spans": "<p><span data-cy=price-USD><span>$</span>1,234</span><SPAN Data-Cy = 'price-EUR'>€<b>9</b></SPAN> </span><span data-cy='price-GBP'>£7</p> 8",
    "hidden": "<!-- <li>no</li> --><script>'<li>no'</script><style>li{}</style><li>yes<!-- cut off",
    "stray": "</li></ul><li>",
    "links": "<a href=/x&amp;y>l <b>k</b></a><a href='z'>m",
    "deep": "<ul>" * 40 + "<li>in" + "</ul>" * 40 + "<li>out",
}


@pytest.fixture(scope="module")
def found(spark):
    h = F.col("h")
    df = spark.createDataFrame([*PAGES.items(), ("null", None), ("empty", "")], "k string, h string")
    rows = df.select("k", E.list_items(h).alias("li"), E.paragraphs(h).alias("p"), E.links(h).alias("a"), M.price_spans(h).alias("prices"), M.detail_list(h).alias("details"))
    return {r["k"]: r for r in rows.collect()}


def test_list_items(found):
    assert found["nested"]["li"] == ["Period : 1960s", "A tail", "x", "y", "B: c"]
    assert found["sections"]["li"] == ["k: v", "w"]
    assert found["hidden"]["li"] == ["yes"] and found["stray"]["li"] == [""] and found["deep"]["li"] == ["in", "out"]
    assert found["empty"]["li"] == [] and found["null"]["li"] is None


def test_details_and_prices(found):
    assert found["nested"]["details"] == {"Period": "1960s", "B": "c"}
    assert {k: float(v) for k, v in found["spans"]["prices"].items()} == {"USD": 1234.0, "EUR": 9.0, "GBP": 7.0}


def test_paragraphs_and_links(found):
    assert found["sections"]["p"] == ["one", "two bold", "four"]
    assert [tuple(a) for a in found["links"]["a"]] == [("/x&y", "l k"), ("z", "m")]


class _Items(HTMLParser):
    """Own texts of list items, with a stack of tags."""

    def __init__(self):
        super().__init__()
        self.stack, self.out = [], []

    def handle_starttag(self, tag, attrs):
        if tag == "li":
            if self.stack and self.stack[-1] == "li":
                self.stack.pop()
            self.out.append("")
        if tag in ("li", "ul", "div"):
            self.stack.append(tag)
            if tag == "li":
                self.at = len(self.out) - 1

    def handle_endtag(self, tag):
        while tag in ("ul", "div", "li") and tag in self.stack:
            if tag == "li" and self.stack[-1] != "li":
                break
            if self.stack.pop() == tag:
                break

    def handle_data(self, data):
        if self.stack and self.stack[-1] == "li":
            self.out[self.at] += data


def test_flat_lists_against_a_parser(spark):
    """Random lists without lists inside, some items unclosed, some tags inside."""
    import random

    r = random.Random(5)
    pages = ["".join("<ul>" + "".join(r.choice(["<li>a", "<li>b</li>", "<li><b>c</b> d</li>", " x ", "<li class='>'>e<i>f</i>"]) for _ in range(r.randint(0, 8))) + "</ul>"
                     for _ in range(r.randint(0, 4))) for _ in range(150)]
    want = []
    for p in pages:
        parser = _Items()
        parser.feed(p)
        want.append([" ".join(x.split()) for x in parser.out])
    got = spark.createDataFrame(list(enumerate(pages)), "i int, h string").select("i", E.list_items(F.col("h")).alias("li")).orderBy("i").collect()
    assert [[x.replace(" ", "") for x in row["li"]] for row in got] == [[x.replace(" ", "") for x in w] for w in want]


def test_details_of_nested_markup_reach_the_product(spark):
    from vitrine.operators import extraction

    html = '<h1 class="headline-3">T</h1><ul><li><b>Period</b>: 1960s</li><li><span>Condition</span>: <em>Good</em></ul><span data-cy="price-USD"><i>$</i>12<b>0</b></span>'
    (row,) = extraction.extract_products(spark.createDataFrame([("https://h/x/id-f_1/", html)], "url string, html string")).collect()
    assert (row["data"]["specifications"]["period"], row["data"]["specifications"]["condition"], row["data"]["pricing"]["price"]) == ("1960s", "Good", "120")


def test_a_page_is_cleaned_once_and_no_text_is_lost(spark):
    """Many items and deep nesting; the page without scripts is computed in one place of the expression."""
    items = "".join(f"<li>k{i}: v{i}<ul><li>in{i}</ul>after{i}" for i in range(300))
    df = spark.createDataFrame([(f"<ul>{items}</ul>" + "<span>" * 60 + "x" + "</span>" * 60,)], "h string")
    got = df.select(E.list_items(F.col("h")).alias("li"), E.spans(F.col("h")).alias("s")).first()
    assert got["li"] == [t for i in range(300) for t in (f"k{i}: v{i} after{i}", f"in{i}")]
    assert len(got["s"]) == 60 and {s["text"].split()[0] for s in got["s"]} == {"x"}
    for found in (E.list_items, E.spans, E.paragraphs, E.links):
        assert df.select(found(F.col("h")).alias("x"))._jdf.queryExecution().analyzed().toString().count("(script|style)") == 1


def test_pages_are_made_in_more_than_one_task(spark, small):
    from vitrine.plans import inputs

    pages = inputs.product_pages(spark, small)
    assert pages.rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert pages.count() == spark.read.parquet(f"{small}/part.parquet").count()
