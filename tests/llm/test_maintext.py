"""Main text: structure of pages, alignment of lines, and differencing of pages without an article."""

import random
import time
import tracemalloc

import pytest
from hypothesis import given
from hypothesis import strategies as st

from epiloom.llm import maintext as M


def text_of(page):
    lines, marked = M.lines_of(page)
    return "\n".join(x.text for x in lines if x.content or not marked)


def test_article():
    page = """<!DOCTYPE html><html class="has-sidebar"><head><title>no</title><style>p{}</style><script>var t="</p><article>no";</script></head>
    <body><header>no</header><nav><ul><li>no</ul></nav><!-- <p>no --><div class="ad">no</div>
    <article class="post"><header><h1>Head&amp;line</h1></header><p><b>One<br>two&nbsp; &lt;3
    three<p>a<a href="x>y">b</a>c<aside>no</aside><form><label>no</label></form><div class="article-header">kept</div>
    <div id="comments"><article class="comment"><p>no</article></div><table><tr><td>x<td>y</table>1 < 2</article>
    <section class="related-posts">no</section><footer>&copy; no"""
    assert text_of(page) == "Head&line\nOne two <3 three\nabc\nkept\nx y\n1 < 2"


def test_odd_pages():
    assert text_of("") == "" and text_of("plain  text") == "plain text"
    assert text_of("<nav>never closed <article>x</article>") == "x"
    assert text_of("<main><p>m</main>tail") == "m"
    assert text_of("<p>a<script>never closed <p>b") == "a"
    assert text_of("<p hidden>a</p><p style='display: none'>b</p><p aria-hidden=true>c</p><p>d") == "d"
    assert text_of('<p title="unbalanced>a</p><p>b') == "a\nb"
    assert text_of("<article>" + "<p>x" * 50_000 + "</article>").count("\n") == 49_999
    assert text_of("<" * 20_000) == "<" * 20_000


@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=12))
def test_common_lines(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    found = M.common_lines(a, b)
    rest = iter(b)
    assert len(found) == best[-1][-1] and all(a[i] in rest for i in sorted(found))


def plain(*lines):
    return "<body>" + "".join(f"<div>{x}</div>" for x in lines)


def test_differencing(spark):
    pages = [
        (1, "http://h.com/a/1", plain("top", "one", "middle", "end")),
        (2, "http://h.com/a/2", plain("top", "two", "middle", "zwei", "end")),
        (3, "http://h.com/a/2?again", plain("top", "two", "middle", "zwei", "end")),
        (4, "http://h.com/b/9", "<article><p>top<p>end</article>"),
        (5, "http://other.com/a/1", plain("top", "alone")),
        (6, None, None), (7, "no url", plain("x")), (None, "http://h.com/a/1", plain("top", "one", "middle", "end")),
    ]
    df = spark.createDataFrame([(*p, "clash", 1) for p in pages], "page_id bigint, url string, html string, text string, host int")
    found = {r.page_id: r for r in M.main_text(df).collect()}
    assert {k: r.text for k, r in found.items()} == {
        1: "one", 2: "two\nzwei", 3: "two\nzwei", 4: "top\nend", 5: "top\nalone", 6: "", 7: "x", None: "one"
    }
    assert found[2].n_chars == 8 and found[6].url is None
    assert M.main_text(df.limit(0)).count() == 0


def test_neighbours_do_not_depend_on_partitions(spark):
    rng = random.Random(2)
    pages = [(i, f"http://h{i % 2}.com/{rng.randrange(30)}/{i}", plain("top", f"t{rng.randrange(4)}", f"own {i}", "end")) for i in range(120)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")

    def texts():
        return sorted((r.page_id, r.text) for r in M.main_text(df.repartition(7)).collect())

    before = spark.conf.get("spark.sql.shuffle.partitions")
    first = texts()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        assert texts() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(f"own {i}" in t and "top" not in t for i, t in first)


@pytest.mark.parametrize("broken", ['<a "', "<a ", "<a", "</", "<a \">\"'>'", "<p a='\"'>", "<!--", "<script>", '<div class="', "<a \"><b '>"])
def test_broken_pages_take_linear_time(broken):
    times = []
    for n in (250_000, 1_000_000):
        start = time.process_time()
        M.lines_of(broken * (n // len(broken)))
        times.append(time.process_time() - start)
    assert times[1] < 10 * times[0] + 1


def test_broken_tags():
    assert M.lines_of('one <a "two> three')[0] == [M.Line("one three", False)]
    assert M.lines_of('one <a b=">" c=\'"\'>two</a>')[0] == [M.Line("one two", False)]
    assert M.lines_of("one <a two")[0] == [M.Line("one <a two", False)]
    assert M.lines_of("one <a <p>two")[0] == [M.Line("one two", False)]
    assert M.lines_of("5 < 6 <b>x</b><!-- > --> y <!-- z")[0] == [M.Line("5 < 6 x y", False)]


@pytest.mark.parametrize("table_bits", [1, 50, 1 << 26])
def test_common_lines_halved(table_bits):
    rng = random.Random(table_bits)
    for _ in range(150):
        letters = rng.randrange(1, 8)
        a, b = ([rng.randrange(letters) for _ in range(rng.randrange(40))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        found = [a[i] for i in sorted(M.common_lines(a, b, table_bits))]
        assert len(found) == best[-1][-1]
        rest = iter(b)
        assert all(x in rest for x in found)


def test_common_lines_of_long_pages_in_little_memory():
    rng = random.Random(2)
    a = [rng.randrange(30_000) for _ in range(40_000)]
    b = [rng.randrange(30_000) if rng.random() < 0.2 else x for x in a]
    tracemalloc.start()
    found = M.common_lines(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) >= 0.7 * len(a) and peak < 100_000_000


def test_articles_lose_template_lines(spark):
    """A line of two articles that both neighbours mark as no content is template; what only copies share, or what the page alone has, stays."""
    def page(*lines, footer=""):
        return f"<nav><p>menu</nav><article>{''.join(f'<p>{x}' for x in lines)}</article><footer><p>{footer}</footer>"

    pages = [
        (1, "http://h.com/a/1", page("one", "uno", "share this page", "common words", "ein", footer="share this page")),
        (2, "http://h.com/a/2", page("two", "dos", "share this page", "common words", "zwei")),
        (3, "http://h.com/a/3", page("three", "tres", "drei", footer="share this page")),
        (4, "http://other.com/a/1", page("a", "b", "share this page", footer="share this page")),
        (5, "http://other.com/a/2", page("a", "b", "share this page", "c")),
        (6, "http://other.com/a/3", page("x", footer="share this page")),
    ]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    found = {r.page_id: (r.text, r.n_chars) for r in M.main_text(df).collect()}
    want = {
        1: "one\nuno\nshare this page\ncommon words\nein", 2: "two\ndos\ncommon words\nzwei", 3: "three\ntres\ndrei",
        4: "a\nb\nshare this page", 5: "a\nb\nshare this page\nc", 6: "x",
    }
    assert found == {k: (t, len(t)) for k, t in want.items()}


def texts_of(spark, pages):
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in M.main_text(df).collect()}


def test_lines_beside_articles_are_differenced(spark):
    """What no element marks as content or as none is decided by the nearest page, on pages with an article too."""
    def page(*lines, article):
        return "".join(f"<div>{x}</div>" for x in lines) + f"<article><p>{article}</article><div>we are h.com</div><footer>foot"

    found = texts_of(spark, [
        (1, "http://h.com/a/1", page("top", "intro one", article="body one")),
        (2, "http://h.com/a/2", page("top", "intro two", article="body two")),
        (3, "http://h.com/a/3", plain("top", "no article", "we are h.com")),
        (4, "http://one.com/1", page("intro", article="body")),
        (5, "http://main.com/1", "<div>logo</div><main><h1>head</h1><article>body</article><p>end</main>tail"),
        (6, "http://main.com/2", plain("logo", "text", "tail")),
        (7, "http://empty.com/1", "<article> </article><main></main><p>text"),
    ])
    assert found == {
        1: "intro one\nbody one", 2: "intro two\nbody two", 3: "no article", 4: "intro\nbody\nwe are h.com",
        5: "head\nbody\nend", 6: "text", 7: "text",
    }


def test_frames_around_articles():
    frame = '<form id="aspnet"><nav>menu</nav><label>no</label><article>text</article><footer>foot</footer></form>'
    assert text_of(frame) == "text"
    assert text_of("<form><label>no</label>name</form><article>text<form>no</form></article>") == "text"
    assert text_of('<div class="page no-sidebar"><div class="sidebar">no</div><main>text</main></div>') == "text"
    assert text_of('<div class="comments"><article>no</article></div><p>text') == "text"
    assert text_of('<div hidden><main>no</main></div><p>text') == "text"


def test_articles_lose_notices_without_a_mark(spark):
    """A line of the articles of 16 pages in a row, or of all pages of a smaller host, is template; what fewer share stays."""
    def page(i, *lines):
        return "<article>" + "".join(f"<p>{x}</p>" for x in (f"one {i}", f"two {i}", f"three {i}", f"four {i}", *lines)) + "</article>"

    def text(i, *lines):
        return "\n".join((f"one {i}", f"two {i}", f"three {i}", f"four {i}", *lines))

    pages = [(i, f"http://large.com/{i:02}", page(i, *["notice"] * (i >= 2), *["quoted"] * (i < 15))) for i in range(18)]
    pages += [(100 + i, f"http://small.com/{i}", page(i, *["notice"], *["quoted"] * (i < 3))) for i in range(4)]
    pages += [(200 + i, f"http://three.com/{i}", page(i, "quoted")) for i in range(3)]
    pages += [(300 + i, f"http://copies.com/{i}", f"<article><p>one<p>two<p>three {i}</article>") for i in range(20)]
    want = {i: text(i, *["quoted"] * (i < 15)) for i in range(18)} | {100 + i: text(i, *["quoted"] * (i < 3)) for i in range(4)}
    want |= {200 + i: text(i, "quoted") for i in range(3)} | {300 + i: f"one\ntwo\nthree {i}" for i in range(20)}
    assert texts_of(spark, pages) == want


def test_main_text_against_a_loop(spark):
    """Random pages with and without articles, main elements, menus and copies."""
    rng = random.Random(4)

    def some(n):
        return [f"line {rng.randrange(25)}" for _ in range(rng.randrange(n))]

    def html_of():
        inner = "".join(f"<p>{x}</p>" for x in some(8))
        if kind := rng.randrange(3):
            inner = f"<article>{inner}</article>" if kind == 1 else f"<main>{inner}<p>in main</main>"
        return f"<nav>{'<br><p>'.join(some(4))}</nav>{''.join(f'<div>{x}</div>' for x in some(3))}{inner}<div>end</div>"

    kinds = [html_of() for _ in range(70)]
    pages = [(i, f"http://h{i % 3}.com/{rng.randrange(5)}/{i:03}", rng.choice(kinds)) for i in range(150)]
    sites = {}
    for i, url, page in pages:
        every, marked = M.all_lines_of(page)
        lines = [x for x in every if not x.dropped]
        held = tuple((x.text, x.content or not marked, x.beyond) for x in lines)
        alike = sites.setdefault(url[:12], {}).setdefault((held, marked), [])
        alike.append((url[13:], sorted({M._hash(x.text) for x in every if x.dropped or marked and not x.content}), i))
    want = {}
    for site in sites.values():
        ordered = sorted((min(x[0] for x in alike), held, marked, min(x[1] for x in alike), [x[2] for x in alike]) for (held, marked), alike in site.items())
        for k, (path, held, marked, rest, ids) in enumerate(ordered):
            sides = [ordered[j] for j in (k - 1, k + 1) if 0 <= j < len(ordered)]
            nearest = max(sides, key=lambda x: M._prefix(path, x[0]))
            shared = M.common_lines([M._hash(x[0]) for x in held], [M._hash(x[0]) for x in nearest[1]])
            in_article = [j for j, x in enumerate(held) if marked and x[1]]
            gone = shared.difference(in_article)
            if len(sides) == 2 and 2 * len(shared.intersection(in_article)) < len(in_article):
                gone |= {j for j in shared.intersection(in_article) if M._hash(held[j][0]) in set(sides[0][3]) & set(sides[1][3]) - set(rest)}
            want.update(dict.fromkeys(ids, "\n".join(x[0] for j, x in enumerate(held) if j not in gone and not x[2])))
    assert texts_of(spark, pages) == want
