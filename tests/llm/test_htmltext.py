import random
import time

import pytest

from lexledger.llm.htmltext import extract, to_text

CASES = {
    "implied ends": ("<p>one<p>two <b>bold<p>three", "one\n\ntwo bold\n\nthree"),
    "head is not shown": ("<!doctype html><html><head><title>T</title><style>p{margin:0}</style><script>var t='</p>'</script></head><body>x</body></html>", "x"),
    "implied head end": ("<title>T</title><h1>H</h1>text", "H\n\ntext"),
    "white space": ("<div>  a \n b<span> c</span>d </div><div>e</div>", "a b cd\ne"),
    "margins collapse": ("<div><h1>A</h1></div><ul><li>x<li>y</ul><p></p><p>z", "A\n\n- x\n- y\n\nz"),
    "nested lists": ("<ol><li>a<ul><li>b<li>c</ul><li>d</ol>", "1. a\n   - b\n   - c\n2. d"),
    "list start": ('<ol start="3"><li>a</li><li><p>b</p><p>c</p></li></ol>', "3. a\n\n4. b\n\n   c"),
    "list in a list item": ("<ul><li><ol><li>a<li>b</ol><li>c</ul><blockquote>q<p>r</blockquote>s", "- 1. a\n  2. b\n- c\n\n  q\n\n  r\n\ns"),
    "definition list": ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    "table": ("<table><tr><th>name<th>n<tr><td>a<td>10<tr><td>longer<td>2</table>", "name    n\na       10\nlonger  2"),
    "spans": ("<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td colspan=2>wide cell<td>f</table>", "a  b  c\n   d  e\nwide cell  f"),
    "lines in cells": ("<table><tr><td>a<br>bb<td>c</table>", "a   c\nbb"),
    "hidden": ('<p style="display:none">no</p><div hidden>no</div><p style="visibility:hidden">no<i style="visibility:visible">yes</i></p>', "yes"),
    "style sheet": ("<style>.x, #y {display:none} p{color:red}</style><div class='a x'>no</div><div id=y>no</div><p>yes", "yes"),
    "entities": ("<p>a &amp; b &lt;c&gt; &nbsp;&copy; &#233;</p>", "a & b <c>  © é"),
    "pre": ("<pre>a\n  b\n\nc</pre>", "a\n  b\n\nc"),
    "breaks": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "comments and junk": ("a<!-- <p>no -->b<![CDATA[no]]>c</nope><?php no ?>d < e", "abcd < e"),
    "attributes with >": ('<a title="x>y" href=z>link</a>', "link"),
    "details": ("<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>", "s\nt\nyes"),
    "template and noscript": ("<template>no</template><noscript>no</noscript>yes", "yes"),
    "unclosed comment": ("a<!-- b", "a"),
    "unclosed script": ("a<script>b", "a"),
    "block in inline": ("<b>x<div>y</div>z</b>", "x\ny\nz"),
    "nothing": ("", ""),
    "invisible by a class": ("<style>.x{visibility:hidden} .y{visibility:visible}</style><div class=x>no<b style='visibility:visible'>yes</b></div>", "yes"),
    "rules of print": ("<style>@media print {.x{display:none} .y{display:none}} @media screen{.z{display:none}}</style><i class=x>a</i><i class=y>b</i><i class=z>no</i>", "ab"),
    "descendants": ("<style>div p.x, html body .m i{display:none}</style><div><section><p class='x'>no</section></div><p class=x>yes<u class=m><b><i>no</i></b></u></p>", "yes"),
    "children": ("<style>div > p, .a>.b > i {display:none} ul > b{display:none}</style><div><p>no</p><section><p>yes</section></div><u class=a><u class=b><i>no</i><s><i>, too</i></s></u></u>", "yes\n\n, too"),
    "body's children": ("<style>body > div{display:none}</style><div>no</div><p><b>yes</b></p>", "yes"),
    "compounds": ("<style>.a.b, i#k.c, div .a.b.c u{display:none}</style><i class='b a'>no</i><i class=a>x</i><i id=k class=c>no</i><b id=k class=c>y</b>", "xy"),
    "child of a descendant": ("<style>.r td > i{visibility:hidden}</style><table class=r><tr><td><i>no</i><td>b<td><u><i>c</i></u></table>", "b  c"),
    "other selectors hide nothing": ("<style>p + p, p ~ i, a[x], b:hover, * , > u, u >, i > > b{display:none}</style><p>a<p>b<i>c</i><a x>d</a><b>e</b><u>f</u>", "a\n\nbcdef"),
    "a sibling's selector does not reach": ("<style>.x .y{display:none}</style><i class=x>a</i><i class=y>b</i><i class=x><b>c<u class=y>no</u></b></i>", "abc"),
    "list values": ("<ol><li>a<li value=7>b<li>c<li value=x>d</ol>", "1. a\n7. b\n8. c\n9. d"),
    "reversed lists": ("<ol reversed><li>a<li>b<li value=9>c</ol><ol reversed start=5><li>d<li>e</ol>", "3. a\n2. b\n9. c\n\n5. d\n4. e"),
    "unclosed tag": ("a<b title='x", "a"),
    "quote in a tag": ("<p don't>a<p it's>b", "a\n\nb"),
    "attribute signs": ("<p = hidden>no</p><p a=hidden>yes</p>", "yes"),
    "no tag": ("a </> b <1 </1x> c", "a b <1 c"),
    "huge reference": ("&#" + "9" * 6000 + "; &#00065;", "\ufffd A"),
    "table in a table": ("<table><tr><td>a<td><table><tr><td>b<td>c<tr><td>d<td>e</table></table>", "a  b  c\n   d  e"),
}

#: Of what hidden and shown elements nest, for the comparison with a plain recursion.
KINDS = {"div": "<div>{}</div>", "gone": "<div hidden>{}</div>", "span": "<span>{}</span>", "unseen": '<i style="visibility:hidden">{}</i>', "seen": '<b style="visibility:visible">{}</b>', "table": "<table><tr><td>{}</table>"}


def nested(rng, depth):
    """(HTML, visible words) of random nested elements, worked out beside the tree builder."""

    def make(depth, laid_out, visible):
        text, words = "", []
        for _ in range(rng.randrange(1, 4)):
            if depth == 0 or rng.random() < 0.4:
                word = f"w{rng.randrange(10**9)}"
                text += f" {word} "
                words += [word] if laid_out and visible else []
            else:
                kind = rng.choice(list(KINDS))
                inner, found = make(depth - 1, laid_out and kind != "gone", {"unseen": False, "seen": True}.get(kind, visible))
                text += KINDS[kind].format(inner)
                words += found
        return text, words

    return make(depth, True, True)


def test_visible_words_equal_brute_force():
    rng = random.Random(3)
    for k in range(300):
        source, words = nested(rng, k % 9)
        assert to_text(source).split() == words


def test_hidden_stays_hidden_at_any_depth():
    for depth in (10, 160, 10_000):
        assert to_text("<div>" * depth + "<div hidden>SECRET</div>" + "ok") == "ok"
        assert to_text("<div hidden>" + "<div>" * depth + "SECRET" + "</div>" * depth + "</div>ok") == "ok"


PAGES = {
    "unclosed tags": "<a " * 300_000, "deep lists": "<ul><li>x" * 20_000, "deep tables": "<table><tr><td>x<td>" * 5_000, "sections": "<![CDATA[>" * 100_000, "style": "<style>" + "a" * 2_000_000 + "</style>",
    "comments": "<style>" + "/*" * 1_000_000, "spans": "<table>" + "<tr>" + "<td colspan=1000 rowspan=1000>x" * 3_000, "wide": "<table><tr><td>" + "w" * 500_000 + "<td>y" + "<tr><td>a<td>b" * 20_000, "quotes": "<p a='" * 100_000,
    "large spans": "<table>" + ("<tr>" + "<td colspan=100 rowspan=100>x" * 20) * 600, "selectors": "<style>" + "".join(f".a{k} .b, .b > .c{k}" + "{display:none}" for k in range(20_000)) + "</style>" + "<i class=b>x" * 20_000,
}


@pytest.mark.parametrize("name", PAGES)
def test_malformed_pages_take_time_in_proportion(name):
    began = time.perf_counter()
    out = to_text(PAGES[name])
    assert time.perf_counter() - began < 10
    assert out.count("x") == (PAGES[name].count("x") if name != "unclosed tags" else 0)


@pytest.mark.parametrize("name", CASES)
def test_case(name):
    source, expected = CASES[name]
    assert to_text(source) == expected


def test_deep_and_long_pages():
    assert to_text("<div>" * 20_000 + "x") == "x"
    assert to_text("<p>" + "word " * 200_000).count("word") == 200_000
    assert to_text("<ul>" + "<li><ul>" * 3000 + "<li>x").endswith("- x")


def test_extract_keeps_rows_and_columns(spark):
    rows = [(1, "u", "<p>a", "old"), (1, "u", "<p>a", "old"), (2, None, None, None), (None, "v", "", "t")]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert got.columns == ["page_id", "url", "text"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "u", "a")] * 2 + [(2, None, None), (None, "v", "")], key=str)
    assert extract(spark.createDataFrame([], "page_id long, html string")).count() == 0
