"""The text expression of a cell against the outline of the page, which reads the same text with a tree."""

import html
import random

from pyspark.sql import functions as F

from schemaward.functions.html import PageOutline
from schemaward.functions.text import cell_text, decode_references

AWKWARD = [
    "", "plain", "a < b > c", "<td>a<b>c</b> d</td>", "<script>var x = '<p>no</p>';</script>yes", "<style>p{}</style >x", "<script>never closed <b>x</b>",
    "<a title=\"x > y\" href='p>q'>link</a>", "<!-- <p>no</p> -->yes", "<!DOCTYPE html><p>x</p>", "<![CDATA[raw <b> &amp;]]>tail", "x&nbsp;y&amp;nbsp;z", "&lt;b&gt;not a tag&lt;/b&gt;",
    "&eacute;&#233;&#xE9;&#XE9;&copy2024 &notit; &notin; &unknown; &amp", "&#0;&#128;&#x1F600;&#xD800;&#1114112;&#99999999999;", "<ruby>漢<rp>(</rp><rt>kan</rt><rp>)</rp></ruby>字",
    "<template><p>hidden</p></template>shown", "line\n\tbreak x y", "<br/>a<br>b<img src=x/>c", "<p>open", "& alone && &; &#; &#x;", "<scripts>shown</scripts>", "<b title=\"open>x",
]


def _outline(text):
    page = PageOutline(text)
    return " ".join(page.text((0, len(page.texts))).split())


def test_awkward_cells(spark):
    rows = spark.createDataFrame(list(enumerate(AWKWARD)), "n int, html string").select("n", cell_text(F.col("html")).alias("t")).collect()
    assert {AWKWARD[r["n"]]: r["t"] for r in rows} == {t: _outline(t) for t in AWKWARD}


def test_null_and_long_cells(spark):
    df = spark.createDataFrame([(None,), ("<p>word</p> " * 50_000,), ("<p " + "a='1' " * 300 + ">x</p>",)], "html string")
    assert [r[0] for r in df.select(cell_text(F.col("html"))).collect()] == [None, " ".join(["word"] * 50_000), "x"]


def test_random_cells(spark):
    draw = random.Random(5)
    bits = ["<td>", "</td>", "<b class='x'>", "</b>", "word", " ", "&amp;", "&lt", "&nbsp;", "&#65;", "é", "<!--x-->", "<br>", "&hellip;", "\n", "<script>s</script>", "<p title=\">\">", "</p>", "1 < 2"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(1, 25))) for _ in range(3000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, html string").select("n", cell_text(F.col("html")).alias("t")).collect()
    assert [(texts[r["n"]], r["t"]) for r in rows if r["t"] != _outline(texts[r["n"]])] == []


def test_references_by_name_and_number(spark):
    names = sorted(html.entities.html5)[::7] + [f"#{n};" for n in range(0, 3000, 13)] + [f"#x{n:x}" for n in range(0xFD00, 0x10100, 17)]
    texts = [f"a&{n}b" for n in names]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, t string").select("n", decode_references(F.col("t")).alias("d")).collect()
    assert [(texts[r["n"]], r["d"]) for r in rows if r["d"] != html.unescape(texts[r["n"]])] == []
