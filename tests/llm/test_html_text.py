import json
import random
import re

import pytest

from siftlane.llm import html_text as H


def stream(node):
    """The tokens of a page as one string, nothing folded."""
    out = ""
    for k in node.kids:
        if k.tag != "#":
            out += f"<{k.sig}>{'' if k.dropped else stream(k)}</{k.sig}>"
        elif k.text.strip():
            out += "#"
    return out


def pattern(parts):
    """A wrapper as an ordinary regular expression over ``stream``."""
    out = ""
    for p in parts:
        inner = "#" if p.sig == "#" else pattern(p.kids) if p.sig == "()" else re.escape(f"<{p.sig}>") + pattern(p.kids) + re.escape(f"</{p.sig}>")
        out += f"(?:{inner})" + {(1, 0): "", (0, 0): "?", (1, 1): "+", (0, 1): "*"}[1 if p.least else 0, 1 if p.many else 0]
    return out


def wrapper_of(pages):
    return [H.load(p) for p in json.loads(H.merge(iter(sorted({H.skeleton(p) for p in pages}))))]


def random_page(r, depth=0):
    out = ""
    for _ in range(r.randint(0, 4)):
        tag = r.choice(("p", "div", "ul", "li", "h2", "section", "#", "b", 'div class="menu"', "article"))
        out += "word " if tag == "#" else f"<{tag}>{random_page(r, depth + 1) if depth < 3 else 'x'}</{tag.split()[0]}>"
    return out


def test_a_wrapper_fits_every_page_it_came_from():
    r = random.Random(2)
    for _ in range(150):
        pages = [random_page(r) for _ in range(r.randint(1, 5))]
        wrapper = wrapper_of(pages)
        assert "|" not in pattern(wrapper).replace(r"\|", "")  # union-free
        rule = re.compile(pattern(wrapper))
        for p in pages:
            assert rule.fullmatch(stream(H.parse(p))), (pages, pattern(wrapper))


def test_mismatches_become_optional_or_repeated():
    shown = pattern(wrapper_of(["<div>a</div><p>x</p>", "<div>a</div><div>b</div><p>x</p><p>y</p>"]))
    assert shown == r"(?:<div>(?:#)</div>)+(?:<p>(?:#)</p>)+"
    assert pattern(wrapper_of(["<h1>t</h1><p>x", "<h1>t</h1><section>s</section><p>x"])) == r"(?:<h1>(?:#)</h1>)(?:<section>(?:#)</section>)?(?:<p>(?:#)</p>)"
    three = pattern(wrapper_of(["<div>a</div><div><p>b</p></div><div>c</div>", "<div>d</div><div><p>e</p></div><div>f</div>"]))
    assert three.count("<div>") == 3 and "+" not in three  # equal counts on all pages: positions stay apart


def text_of(page, *others):
    return H.extract(page, wrapper_of([page, *others]))


@pytest.mark.parametrize(
    "page, text",
    [
        ("<nav><a>Home</a></nav><article><h1>T</h1><p>One &amp; two.</p></article><footer>F</footer>", "T\nOne & two."),
        ("<article><p><b>Bold<br><p>next  \n line</p></article>", "Bold\nnext line"),
        ("<article><p>a<!-- <p>no</p> -->b<script>var t='</p><p>no';</script>c</p><style>p{}</style></article>", "abc"),
        ("<article><header><h1>Title</h1></header><p>x</p><footer>by me</footer><section class='comments'><p>nice!</p></section></article>", "Title\nx"),
        ("<body><header><h1>Site</h1></header><main><p>m</p><aside>no</aside><form><input>Name</form></main></body>", "m"),
        ("<div id=content><p>kept<span class='ad'><span>buy</span> this</span> too</p></div><div class=sidebar>no</div>", "kept too"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>tail", "a\nb\nc\nd\ntail"),
        ("<article><p>1 < 2 &lt; 3 &am &amp ok &#228;&nbsp;!</p></article>", "1 < 2 < 3 &am & ok ä !"),
        ("<article><p title='a>b'>quoted</p><p class=\"x>open</p>", 'quoted\nopen'),
        ("<article><p>cut off</p><div class=\"te", "cut off"),
        ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after</p></article>", "deep\nafter"),
        ("<article>" + "<div>d</div>" * 2000 + "</article>", "\n".join("d" * 2000)),
        ("", ""),
        ("<nav>only a menu</nav>", ""),
    ],
)
def test_main_text(page, text):
    assert text_of(page) == text


def test_reader_comments_that_are_articles():
    page = "<article><h1>T</h1><p>x</p><div id='comments'><article>first!</article></div></article>"
    assert text_of(page) == "T\nx"


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, salt int")


def test_hosts_without_an_article(spark):
    rows = [
        (i, f"http://plain.example/{i}", f"<div>Our own words</div><div><h2>T{i}</h2><p>Text {i}.</p></div><div><a>x{i}</a> <a>y</a></div><div>All rights</div>", "h", 1)
        for i in range(5)
    ]
    rows += [(9, "http://single.example/", "<div>Only page</div><p>text</p>", "h", 1)]
    got = {r.page_id: r.text for r in H.main_text(pages_of(spark, rows)).collect()}
    assert got == {**{i: f"T{i}\nText {i}." for i in range(5)}, 9: "Only page\ntext"}


def test_odd_pages_and_hot_hosts(spark, monkeypatch):
    article = "<nav>n</nav><article><h1>T{0}</h1><p>P{0}</p></article>"
    rows = [(i, f"https://Hot.example:80/{i}?a=://b", article.format(i), None, 0) for i in range(40)]
    rows += [(50, None, article.format(50), "x", None), (51, "no scheme", None, None, None), (52, "http://e.example", "", "", 0)] + [(53, "http://e.example#x", article.format(53), "", 0)] * 3
    rows += [(None, "http://e.example/", article.format(0), "", 0), (None, None, None, None, None)]
    out = H.main_text(pages_of(spark, rows))
    got = sorted((str(r.page_id), str(r.url), r.host, r.text) for r in out.collect())
    assert len(got) == len(rows) and dict(out.dtypes)["page_id"] == "bigint"
    texts = {(p, t) for p, _, _, t in got}
    assert texts == {(str(i), f"T{i}\nP{i}") for i in (*range(40), 50, 53)} | {("51", ""), ("52", ""), ("None", "T0\nP0"), ("None", "")}
    assert {h for _, _, h, _ in got} == {"hot.example:80", "e.example", ""}
    monkeypatch.setattr(H, "HOT", 3)
    monkeypatch.setattr(H, "SALTS", 4)
    assert sorted((str(r.page_id), str(r.url), r.host, r.text) for r in H.main_text(pages_of(spark, rows)).collect()) == got
    assert H.main_text(pages_of(spark, rows[:1]).limit(0)).count() == 0


def test_wrappers_do_not_depend_on_the_deal(spark):
    r = random.Random(7)
    rows = [(i, f"http://h{i % 3}.example/", random_page(r), "", 0) for i in range(120)]
    one = pages_of(spark, rows)
    a = {x.host: x.wrapper for x in H.infer_wrappers(one.repartition(1)).collect()}
    b = {x.host: x.wrapper for x in H.infer_wrappers(one.repartition(7)).collect()}
    assert a == b and len(a) == 3
    for i, _, p, *_ in rows:
        assert re.fullmatch(pattern([H.load(x) for x in json.loads(a[f"h{i % 3}.example"])]), stream(H.parse(p)))
