from __future__ import annotations

import duckdb
import pytest

from blotter.llm import extraction
from blotter.llm.extraction import visible_text
from tests.conftest import SF_SMALL

CASES = {
    "": "",
    "plain": "plain",
    "<p>a  b<p>c": "a b\n\nc",
    "<div>a<div>b</div>c</div>": "a\nb\nc",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<ul><li>one<li>two<ol start=3><li>x<li>y</ol><li>three</ul>": "- one\n- two\n  3. x\n  4. y\n- three",
    "<table><tr><th>A<th>Long<tr><td>11<td>2 <b>b</b><td></table>": "A  | Long\n11 | 2 b  |",
    "<table><tr><td colspan=2>wide cell<tr><td>a<td>b</table>": "wide cell\na | b",
    "<p hidden>x</p><p style='display: none'>y</p>z": "z",
    "<div style='visibility:hidden'>x<b style='visibility: visible'>y</b></div>": "y",
    "<script>var a='</p>';</script><style>p{}</style><noscript>n</noscript>t": "t",
    "<title>t</title>x &amp; y &copy;": "x & y ©",
    "<pre>a\n  b</pre>": "a\n  b",
    "1 < 2 <b>x": "1 < 2 x",
    "<a title='a>b'>x</a><!-- no --><!DOCTYPE html>": "x",
    "x<b": "x",
    "</p></td>x</li>": "x",
    "<select><option>a<option>b</select>t": "t",
    "<dl><dt>t<dd>d<dt>u</dl>": "t\nd\nu",
    "<blockquote>a<br>b</blockquote>c": "> a\n> b\n\nc",
}


@pytest.mark.parametrize("html", CASES)
def test_layout(html):
    assert visible_text(html) == CASES[html]


def test_deep_and_broken_pages_end():
    assert visible_text("<div>" * 50_000 + "x").strip() == "x"
    assert visible_text("<" * 20_000).count("<") == 20_000
    assert visible_text("<a b='" * 5_000) == ""
    assert visible_text("<table><tr><td>" * 300 + "x").strip() == "x"


def test_query_shows_every_visible_word(spark):
    """On the generated pages, whose markup is regular, tags, head and scripts can be cut by regular expression."""
    got = {r["page_id"]: r["text"] for r in extraction.extract(spark.read.parquet(f"{SF_SMALL}/pages.parquet")).collect()}
    import html
    import re

    pages = duckdb.sql(f"SELECT page_id, html FROM read_parquet('{SF_SMALL}/pages.parquet')").fetchall()
    assert len(got) == len(pages)
    for page_id, page in pages:
        cut = re.sub(r"(?s)<head>.*?</head>|<script.*?</script>|<style.*?</style>|<!--.*?-->", " ", page)
        cut = re.sub(r"(?s)</?(b|i|a|em|strong|span)(\s[^>]*)?>", "", cut)
        words = html.unescape(re.sub(r"(?s)<[^>]*>", " ", cut)).split()
        shown = [w for w in got[page_id].split() if w not in ("-", "|")]
        assert [w for w in words if w not in ("-", "|")] == shown, page_id


def test_nulls_repeats_extra_columns_and_empty_table(spark):
    rows = [(None, "<p>a"), (1, None), (1, None), (2, "")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, html string, text string")
    out = sorted(map(tuple, extraction.extract(df).collect()), key=str)
    assert out == sorted([(None, "a"), (1, ""), (1, ""), (2, "")], key=str)
    assert extraction.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("page", ["<div>" * 200_000, "<" * 400_000, "<p><button>" + "<div>" * 100_000, "<b>" * 100_000 + "</i>" * 100_000,
                                  "<table>" + "<tr><td>" * 50_000, "x<" * 200_000])
def test_hostile_pages_take_time_in_proportion(page):
    import time

    began = time.process_time()
    extraction.build_tree(page)
    assert time.process_time() - began < 15
