"""Page fields by selectors, on pages with nested, broken and odd markup."""

import pytest

from skillweave.functions.html import Field, page_fields

PAGE = """<!DOCTYPE html><html lang="en"><head><title>A &amp; B</title><style>p > a{}</style>
<script>var t = "<p class='lead'>no</p>";</script><meta charset=utf-8></head><body>
<!-- <p class="lead">no</p> --><div id="top" class="box wide"><p class="lead">first <b>bold <i>both</i></b> end</p>
<p>second<br/>line<p>third</div><div class="boxes"><p class="lead">other</p></div>
<ul><li><a href="/x?a=1&amp;b=2" title='a > b' data-href="no">X</a></li><li><a href='/y'>Y</a></li><li><a>none</a></ul>
</span><P CLASS="Lead">upper</P><div><div class="box"><em> </em></div></div>"""


def fields(spark, spec, pages=(PAGE,)):
    good, bad = page_fields(spark.createDataFrame([(k, p) for k, p in enumerate(pages)], "id long, html string"), spec)
    return {x.id: x for x in good.collect()}, {x.id: x.reason for x in bad.collect()}


def test_selectors(spark):
    spec = {
        "title": Field("title", required=True), "lang": Field("html", attr="lang"), "lead": Field("div.box p.lead"), "child": Field("#top > p", many=True),
        "all_p": Field("p", many=True), "any": Field("div.wide *", many=True), "links": Field("ul li > a[href]", attr="href", many=True),
        "one": Field("a[href=/y]"), "tip": Field("li a[title]", attr="title"), "none": Field("table td"), "wide": Field("body > div#top.wide", attr="id"), "blank": Field("div > div.box", many=True),
        "meta": Field("meta[charset]", attr="charset"), "li": Field("li", many=True), "upper": Field("body > p.Lead"),
    }
    good, bad = fields(spark, spec)
    x = good[0]
    assert bad == {} and (x.title, x.lang, x.lead) == ("A & B", "en", "first bold both end")
    assert x.child == ["first bold both end", "secondline", "third"] and x.all_p == [*x.child, "other", "upper"]
    assert x.any == ["first bold both end", "bold both", "both", "secondline", None, "third"]
    assert x.links == ["/x?a=1&b=2", "/y"] and (x.one, x.tip, x.none, x.wide, x.meta) == ("Y", "a > b", None, "top", "utf-8")
    assert x.blank == [None] and x.li == ["X", "Y", "none"] and x.upper == "upper" and "html" not in x.__fields__


def test_what_is_not_as_declared_is_kept_apart(spark):
    spec = {"t": Field("title", required=True), "a": Field("a", attr="href")}
    pages = ["<title>x</title><a href=1>", "<a href=1>", "<title>x<a href=1></a><a href=2>", "<title>x</title><a>y</a>", None, "", "no <tags> at < all", "<title></title>"]
    good, bad = fields(spark, spec, pages)
    assert {k: (x.t, x.a) for k, x in good.items()} == {0: ("x", "1"), 7: (None, None)}
    assert bad == {1: "missing t", 2: "several a", 3: "no href of a", 4: "missing t", 5: "missing t", 6: "missing t"}
    assert fields(spark, spec, ["<title>x</title>"] * 2)[0].keys() == {0, 1}


def test_long_and_deep_pages(spark):
    deep, long = "<div>" * 300 + "<p>in</p>" + "</div>" * 300, "<p>" + "word " * 100_000 + "</p>" + "<i a='" + "x" * 50_000 + "'>y</i>"
    good, _ = fields(spark, {"p": Field("p"), "i": Field("i")}, [deep, long, "<p " + "a=b " * 3000 + ">z</p>"])
    assert good[0].p == "in" and len(good[1].p) == 499_999 and good[1].i == "y" and good[2].p == "z"


def test_selectors_are_checked():
    from skillweave.functions.html import _compiled

    with pytest.raises(ValueError):
        _compiled("p:first")
