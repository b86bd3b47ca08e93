"""Elements of pages against a plain lenient parser."""

from __future__ import annotations

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from siltstone.functions import html as h
from siltstone.plans import decisions


class Plain(HTMLParser):
    """(name, text within) of all elements; a closing tag ends the nearest open element of its name and what is open within."""

    def __init__(self, page):
        super().__init__(convert_charrefs=False)
        self.open, self.all = [], []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        element = [tag, ""]
        self.all.append(element)
        if tag not in h.VOID_TAGS:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.all.append([tag, ""])

    def handle_endtag(self, tag):
        names = [e[0] for e in self.open]
        if tag in names:
            del self.open[len(names) - 1 - names[::-1].index(tag) :]

    def handle_data(self, data):
        if self.open and self.open[-1][0] in ("script", "style"):
            return
        for element in self.open:
            element[1] += data


PARTS = ["<div>", "</div>", "<DIV class='a > b'>", "<span>", "</span>", "<td>", "</td>", "<p>", "</p>", "<br>", "<br/>", "<span/>",
         "<!-- <div> -->", "<script>if (a<b) '</div>'</script>", "x", " y\n", "<img src=\"a>b\">", "</b>"]


def found(spark, pages, names=("div", "span", "td", "p")):
    rows = spark.createDataFrame(list(enumerate(pages)), "n long, html string").repartition(3)
    each = rows.select("n", h.elements(F.col("html"), {n: rf"(?i)<{n}\b" for n in names}).alias("found"))
    each = each.select("n", F.transform("found", lambda e: F.struct(e["label"], h.inner_text(e["inner"]).alias("text"))).alias("found"))
    return {r.n: None if r.found is None else [(e.label, e.text) for e in r.found] for r in each.collect()}


def test_random_pages(spark):
    pick = random.Random(7)
    pages = ["".join(pick.choices(PARTS, k=pick.randrange(40))) for _ in range(400)]
    got = found(spark, pages)
    for n, page in enumerate(pages):
        assert got[n] == [tuple(e) for e in Plain(page).all if e[0] in ("div", "span", "td", "p")], page


def test_edges(spark):
    deep = "<div>" * 300 + "x" + "</div>" * 300
    long = "<div>" + "<td>cell</td>" * 3000 + "</div>"
    got = found(spark, [None, "", "no tags", "a < b <div", "<div>open", deep, long, "</div></td>"])
    assert got[0] is None
    assert got[1] == got[2] == got[3] == got[7] == []
    assert got[4] == [("div", "open")]
    assert got[5] == [("div", "x")] * 300
    assert got[6][0] == ("div", "cell" * 3000) and got[6][1:] == [("td", "cell")] * 3000


def test_long_attribute(spark):
    assert found(spark, [f'<div title="{"a>" * 100_000}">t</div>'])[0] == [("div", "t")]


LISTING = """<div class="spost clearfix"><div class="small"><div>note <div>deep</div></div> Putus : 15-03-2024</div>
<div><a class="x" href="/direktori/putusan/a.html"><span>Putusan Nomor</span> 1/A</a></div></div>
<div class="small">Putus : 01-01-2001</div><a href="/direktori/putusan/other.html">Nomor 9/Z</a>
<div class="spost"><div class="small">Putus : 16-03-2024</div><a href="/direktori/putusan/b.html">2/B</a></div>
<div class="spost clearfix"><div class="small">Putus : 17-03-2024<a href="/direktori/putusan/c.html">Nomor 3/C</div>"""


def test_listing_entries_end_where_they_close(spark):
    """Lines behind an entry are not its own, nested ones do not cut it, and an unclosed link still counts."""
    pages = spark.createDataFrame([(1, LISTING)], "page_id long, html string")
    rows = decisions.listing_records(pages).orderBy("position").collect()
    assert [(r.no_putusan, str(r.tgl_putusan), r.link_page_putusan) for r in rows] == [
        ("1/A", "2024-03-15", "/direktori/putusan/a.html"),
        ("3/C", "2024-03-17", "/direktori/putusan/c.html"),
    ]


DETAIL = """<span id="title_pihak"><span>Jaksa</span> Terdakwa:<br/> BUDI</span>
<table><tr><td>Nomor</td><td><table><tr><td>12/Pid</td></tr></table> B</td></tr><tr><td>Tahun<td>2024</tr></table>
<div class="card-body bg-white"><div><a href="/x">page</a></div><div><a class="pdf" href="/f?a=1&amp;b=2">file</a></div></div>"""


def test_detail_with_nested_parts(spark):
    pages = spark.createDataFrame([(1, "u", DETAIL)], "page_id long, url string, html string")
    row = decisions.detail_fields(pages).first()
    assert (row.nama_terdakwa, row.no_putusan, row.link_pdf_putusan) == ("BUDI", "12/Pid B", "/f?a=1&b=2")
