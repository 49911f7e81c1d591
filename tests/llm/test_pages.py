import random
import re
import time
from html import unescape

import pytest

from __spark_entry__ import SMOKE_DIR, queries
from tidemark.llm.common import table
from tidemark.llm import pages as module
from tidemark.llm.pages import Matcher, Node, extract, induce, main_text, parse_shape, parts_of, templates

CASES = {
    "nothing": ("", ""),
    "plain": ("just text", "just text"),
    "article": ("<nav>menu</nav><article><h1>T</h1><p>one</p><p>two</p></article><footer>f</footer>", "T\none\ntwo"),
    "open tags": ("<article><p><b>one<br>more<p>two<div>three", "one more\ntwo\nthree"),
    "references": ("<article><p>a &amp; b&nbsp;&lt;c&gt; &#233;&copy &unknown; &am</article>", "a & b <c> é© &unknown; &am"),
    "white space": ("<article><p> a \n\t b<i> c</i>d </p>\n e </article>", "a b cd\ne"),
    "scripts": ("<article><script>var x='</p><p>no';</script><style>p{}</style><p>yes</p><noscript>no</noscript></article>", "yes"),
    "unclosed script": ("<article><p>yes<script>no <p>no", "yes"),
    "comments": ("<article><!-- <p>no</p> --><p>yes</p></article><!-- no", "yes"),
    "readers": ("<article><p>yes</p><section class='comments-list'><p>no</p></section></article><div id='disqus_thread'>no</div>", "yes"),
    "regions": (
        "<div class='cookie-notice'>no</div><div role='banner'>no</div><div id=sidebar>no</div><main><form>no</form><p>yes</p>"
        "<div class=adBox>no</div><aside>no</aside><div hidden>no</div><div style='display: none'>no</div></main>",
        "yes",
    ),
    "names that mean something else": ("<div class='has-sidebar'><div class='ad-free'><p>yes</p></div></div><p class=shadow>too</p>", "yes\ntoo"),
    "named around the article": ("<div class='page menu'><article>yes</article></div>", "yes"),
    "several articles": ("<article>one</article><div>no</div><article>two, longer</article>", "one\ntwo, longer"),
    "main around an article": ("<main>lead<article>card</article>body</main><p>no</p>", "lead\ncard\nbody"),
    "names in an article": (
        "<article><h2 id=search>Search</h2><section id=related-work><p>a</p></section><section class=related-work>b</section><p class=notice>c</p></article>",
        "Search\na\nb\nc",
    ),
    "regions in an article": (
        "<article><p>yes</p><div class='share-buttons'>no</div><div id=comments>no</div><div class=related-posts>no</div><form>no</form><nav>no</nav></article>",
        "yes",
    ),
    "readers' articles": ("<article><p>yes</p></article><div class=comments><article class=comment>no</article></div>", "yes"),
    "only readers' articles": ("<div class=comment-page><article>yes</article></div>", "yes"),
    "form around an article": ("<form action=/><div><article>yes<form>no</form></article></div></form>", "yes"),
    "header in article": ("<header><h1>Site</h1></header><article><header><h1>T</h1></header><p>x</p><footer>f</footer></article>", "T\nx"),
    "no article": ("<body><ul><li><a href=/a>one</a><li><a href=/b>two</a></ul><div><h1>T</h1><p>x <a>link</a> and more</p></div></body>", "T\nx link and more"),
    "role": ("<div role=main><p>yes</p></div><p>no</p>", "yes"),
    "headers by name": ("<div id=header>no</div><div class=post-header><h1>T</h1></div><div><div class=commentlist>no</div>yes</div>", "T\nyes"),
    "header in an article by name": ("<article><div class=header>T</div><p>x</p></article>", "T\nx"),
    "list": ("<article><ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e</table></article>", "a\nb\nc\nd\ne"),
    "stray ends": ("</div></p><article></b>yes</i></article></html>", "yes"),
    "quotes": ("<article title=\"a > b\" data-x='<p>'><p>yes</p></article>", "yes"),
    "broken tag": ("<article><p>1 < 2 and <b>x</b></p><p", "1 < 2 and x"),
    "upper case": ("<ARTICLE><P>yes</P></ARTICLE><NAV>no</NAV>", "yes"),
    "surrogate": ("<article><p>&#xD800;x</p></article>", "�x"),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    html, text = CASES[name]
    assert main_text(html) == text


@pytest.mark.parametrize("part", ["<div>x", "<x-y>x", "<b>x", "<p><i>x", "</div>", "<li>x", "<a><div>x</p>"])
def test_time_grows_with_the_length(part):
    begun = time.perf_counter()
    main_text(part * 100_000)
    parts_of(part * 100_000)
    assert time.perf_counter() - begun < 30


def test_a_host_of_three_pages_and_repeated_headings():
    pages = [f"<ul class=top><li>Home page</li></ul><h2>Title {i}</h2><p>Text {i}</p>" for i in range(3)]
    reference, template = induce(pages)
    assert main_text(pages[0], template, reference) == "Title 0\nText 0"
    pages = [f"<div>Home</div><article><h2>Ingredients</h2><p>Text {i}</p></article>" for i in range(6)]
    reference, template = induce(pages)
    assert main_text(pages[0], template, reference) == "Ingredients\nText 0"


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + "<p>yes</p>" + "</div>" * 5000
    assert main_text(deep) == "yes"
    assert induce([deep.replace("yes", f"yes {i}") for i in range(6)])[1] == []
    long = "<article>" + "".join(f"<p>block {i}</p>" for i in range(5000)) + "</article>"
    assert main_text(long).count("\n") == 4999


def site(i):
    related = "".join(f"<p>link {i * 7 + k}</p>" for k in range(i % 3))
    return (
        f"<body><div class=top>My Site</div><div class=body><h1>Title {i}</h1><p>Text {i}</p>{related}<p>Written for My Site</p></div>"
        f"<div class=end>All rights</div></body>"
    )


def test_template_texts_are_found_and_contents_stay():
    reference, template = induce([site(i) for i in range(9)])
    assert main_text(site(20), template, reference) == "Title 20\nText 20\nlink 140\nlink 141"
    assert main_text(site(20)).startswith("My Site\n")
    # Copies of one page are one page.
    assert induce([site(1)] * 50)[1] == []


def test_given_pages_equal_brute_force(spark):
    """The given pages mark their article and hold only paragraphs and bold text in it."""
    expected = {}
    for r in table(spark, SMOKE_DIR, "pages").collect():
        inner = re.search("<article>(.*?)</article>", r["html"], re.DOTALL)[1]
        parts = re.split("</?(?:p|h1)>", re.sub("</?b>", "", inner.replace("<br>", " ")))
        blocks = (" ".join(unescape(part).split()) for part in parts)
        expected[r["page_id"]] = (r["url"], "\n".join(b for b in blocks if b))
    got = queries()["op7_html_extraction"](spark, SMOKE_DIR).collect()
    assert {r["page_id"]: (r["url"], r["text"]) for r in got} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in got) and len(got) == len(expected)


def test_rows(spark):
    rows = [(i, f"https://u@Site.example:80/{i}?x", site(i), "x", "y") for i in range(9)]
    rows += [(1, rows[1][1], rows[1][2], None, None), (None, None, None, None, None), (50, None, "<p>x</p>", "", ""), (51, "https://other/", "", "", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, template string")
    got = sorted((str(r["id"]), r["text"]) for r in extract(pages).collect())
    own = [(str(i), "\n".join([f"Title {i}", f"Text {i}", *(f"link {i * 7 + k}" for k in range(i % 3))])) for i in [*range(9), 1]]
    assert got == sorted([*own, ("None", ""), ("50", "x"), ("51", "")])


def test_empty_table(spark):
    assert extract(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def two_layouts():
    """A host whose pages mostly have one layout; a rare one, first by its html, has a menu and a footer of its own."""
    common = [(i, f"<main class=common><h1>Title {i}</h1><p>Text {i}</p></main><div class=end>All rights</div>") for i in range(60)]
    rare = [
        (100 + i, f"<div class=a><ul><li>Shop<li>Stock</ul></div><main class=rare><p>Item {i}</p><p>Price {i % 3}</p><p>Ask us</p></main>")
        for i in range(12)
    ]
    return common, rare


def test_templates_count_all_pages_and_each_layout(spark):
    common, rare = two_layouts()
    rows = [(i, "https://site.example/", html) for i, html in common + rare]
    # Pages of equal texts are one page: their content does not become template.
    rows += [(200 + i, "https://copies.example/", f"<main data-n={i}><p>Same content</p></main>") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)
    got = {r["id"]: r["text"] for r in extract(pages).collect()}
    assert all(got[i] == f"Title {i}\nText {i}" for i, _ in common)
    assert all(got[100 + i] == f"Item {i}\nPrice {i % 3}" for i in range(12))
    assert all(got[200 + i] == "Same content" for i in range(30))
    found = {r["host"]: (r["reference"], r["template"]) for r in templates(pages).collect()}
    assert found["site.example"] == induce([h for _, h in common + rare]) and found["copies.example"][1] == []


def test_layouts_that_differ_in_classes_share_their_template():
    """No layout has the notice on most of the host's pages by its path; aligned, it stands in one place."""
    pages = [
        f"<body><div class=c{i}><p class=t{i}>Title {i}</p><div class=n{i}><b>All rights reserved</b></div></div>"
        f"<div class=d{i}><h2>Head {i}</h2><p class=x{i}>Text {i}</p></div></body>"
        for i in range(8)
    ]
    reference, template = induce(pages)
    assert main_text(pages[3], template, reference) == "Title 3\nHead 3\nText 3"
    assert "All rights reserved" in main_text(pages[3])


def best_match(a: Node, b: Node) -> int:
    """Simple tree matching, by trying every alignment of children."""
    if a.tag != b.tag:
        return 0

    def rest(x, y):
        if not x or not y:
            return 0
        return max(rest(x[1:], y), rest(x, y[1:]), best_match(x[0], y[0]) + rest(x[1:], y[1:]))

    return 1 + rest(a.children, b.children)


def random_shape(draw, n):
    words, depth = ["0html"], 0
    for _ in range(n):
        depth = draw.randint(1, depth + 1)
        words.append(f"{depth}{draw.choice(['div', 'p', 'ul'])}")
    return " ".join(words)


def test_matching_equals_trying_everything():
    draw = random.Random(3)
    for _ in range(300):
        a, b = (random_shape(draw, draw.randint(0, 7)) for _ in "ab")
        matcher, keys = Matcher(), {}
        trees = parse_shape(a, keys), parse_shape(b, keys)
        found = matcher(b, a)
        expected = best_match(*trees) - 1
        assert sum(n >= 0 for n in found) == expected == matcher.size(parse_shape(a, matcher._keys), parse_shape(b, matcher._keys)) - 1
        kept = [n for n in found if n >= 0]
        assert len(set(kept)) == len(kept) and all(a.split()[i] == b.split()[n] for i, n in enumerate(found) if n >= 0)
        assert kept == sorted(kept)


def test_like_siblings_are_one_node():
    assert parts_of("<div><p>a</p><p>b</p><ul><li>c<li>d</ul><p>e</p></div>").shape == "0div 1p 1ul 2li 1p"
    assert Matcher()("0div 1p 1ul 2li", "0div 1ul 2li 1p") == [0, 2, 3, -1]


def test_wide_and_deep_trees_are_aligned_in_time(monkeypatch):
    wide = " ".join(["0div", *("1p 2b" if i % 3 else f"1h{i % 5}" for i in range(4000))])
    other = " ".join(["0div", *("1p 2i" if i % 2 else f"1h{i % 4}" for i in range(3000))])
    begun = time.perf_counter()
    assert sum(n >= 0 for n in Matcher()(wide, wide)) == len(wide.split())
    Matcher()(wide, other)
    deep = " ".join(f"{i}div" for i in range(100))
    assert Matcher()(deep, deep + " 99p")[:100] == list(range(100))
    assert time.perf_counter() - begun < 20
    monkeypatch.setattr(module, "MOST_CELLS", 10)
    assert Matcher()(wide, other)[0] == 0


def test_matches_do_not_depend_on_the_rows_that_are_kept(monkeypatch):
    draw = random.Random(5)
    trees = [(random_shape(draw, draw.randint(0, 40)), random_shape(draw, draw.randint(0, 40))) for _ in range(100)]
    trees.append(tuple(" ".join(["0div", *(f"1p 2{draw.choice('abc')}" for _ in range(n))]) for n in (150, 101)))
    expected = [Matcher()(b, a) for a, b in trees]
    for most in (0, 1, 7, 100):
        monkeypatch.setattr(module, "MOST_CELLS", most)
        monkeypatch.setattr(module, "KNOWN_SIZES", 3 * most)
        assert [Matcher()(b, a) for a, b in trees] == expected


def test_a_template_among_thousands_of_siblings_is_found():
    """The notice has another path on each page, and its node has over 2,000 siblings of many kinds."""
    draw = random.Random(6)

    def page(i):
        above, below = (
            "".join(f"<{tag}><{(kind := draw.choice(kinds))}>{side} {i} {k}</{kind}></{tag}>" for k in range(1100))
            for side, tag, kinds in (("above", "div", ["h1", "h2"]), ("below", "blockquote", ["p", "h3"]))
        )
        return f"<body>{above}<section class=n{i}>All rights reserved</section>{below}</body>"

    pages = [page(i) for i in range(4)]
    reference, template = induce(pages)
    text = main_text(pages[2], template, reference)
    assert text.count("\n") == 2199 and "rights" not in text and "rights" in main_text(pages[2])
