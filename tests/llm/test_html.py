import pytest

from quarry.llm import html_text

SCHEMA = "page_id long, url string, html string, text string, key long"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], SCHEMA)


def extract(spark, rows):
    return {r["page_id"]: r["text"] for r in html_text.digest(pages(spark, rows)).collect()}


def text(page):
    return html_text.page_text(html_text.parse(page))


@pytest.mark.parametrize("page,want", [
    ("", ""),
    ("plain words &amp; more", "plain words & more"),
    ("<article><h1>T</h1><p><b>open<br>tags<p>next &eacute;&#233;&nbsp;x</article><footer>f</footer>", "T\nopen tags\nnext éé x"),
    ("<script>var a='<p>no</p>';</script><p>yes</p><style>p{}</style>", "yes"),
    ("<body><nav><ul><li>menu</ul></nav><div class='ad'>buy</div><div>text<ul><li>one<li>two</ul>end</div></body>", "text\none\ntwo\nend"),
    ("<p>a<!-- <p>hidden</p> -->b</p>", "ab"),
    ("<p title='a > b'>x</p><p data-x=\"</p>\">y</p>", "x\ny"),
    ("<article>a<section class='comments'>c</section><form>f</form><aside>s</aside><div hidden>h</div>b</article>", "a\nb"),
    ("<main><p>m</p></main><p>outside</p>", "m"),
    ("<article><p>cut off in the mid", "cut off in the mid"),
    ("<article><header><h1>Head</h1><p>by someone</p></header><p>t</p></article>", "Head\nt"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("a < b and <3 hearts", "a < b and <3 hearts"),
    ("<div>" * 5000 + "deep", "deep"),
    ("<SCRIPT>x</script><P>Case</P>", "Case"),
    ("<article><p>one</p></article><article class='comment'>no</article><article><p>two</p></article>", "one\ntwo"),
])
def test_main_text(page, want):
    assert text(page) == want


def test_recurring_subtrees_go_by_host(spark):
    site = "<div><p>Welcome to our site</p><ul><li>Home<li>News</ul></div><div><p>Story {0} has its own words</p></div><section><p>All rights</p></section>"
    rows = [(i, f"http://A.example.com/{i}", site.format(i)) for i in range(10)]
    rows += [(20, "http://b.example.com/1", site.format(20)), (21, "http://b.example.com/2", "<p>All rights</p>")]
    out = extract(spark, rows)
    assert all(out[i] == f"Story {i} has its own words" for i in range(10))
    assert out[20].startswith("Welcome") and out[21] == "All rights"


def test_shared_paragraphs_of_articles_stay(spark):
    rows = [(i, "http://a.example.com/x", f"<nav>n</nav><article><p>The same passage</p><p>{i}</p><div><a>share</a></div></article>") for i in range(8)]
    assert extract(spark, rows) == {i: f"The same passage\n{i}" for i in range(8)}


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "", ""), (3, "not a url", "<p>x</p>"), (3, "not a url", "<p>x</p>"), (None, "http://h/", "<p>y</p>"),
            (4, "http://h/", "<p>" + "long " * 50_000 + "</p>")]
    out = html_text.digest(pages(spark, rows)).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in out) == [(0, 1), (1, 0), (2, 0), (3, 1), (3, 1), (4, 249_999)]
    assert html_text.digest(pages(spark, [])).count() == 0


SITE = "<html><body><div><p>Welcome here</p></div><div><h1>{0}</h1><p>Story {0} in its own words</p></div></body></html>"


def test_copies_of_a_page_are_one_page(spark):
    """Three copies among fifteen pages of a host without article elements."""
    rows = [(i, f"http://h.example/{i}", SITE.format(min(i, 12))) for i in range(15)]
    out = extract(spark, rows)
    assert all(out[i] == f"{min(i, 12)}\nStory {min(i, 12)} in its own words" for i in range(15))


def test_counts_equal_brute_force(spark):
    """Every subtree's number of different pages per host, counted plainly."""
    import collections
    import random

    rng = random.Random(3)
    parts = [f"<div><p>part {i}</p></div>" for i in range(12)]
    rows = []
    for i in range(120):
        body = "<body>" + "".join(rng.sample(parts, 4)) + f"<section><b>{rng.randrange(30)}</b></section></body>"
        rows.append((i, f"https://s{rng.randrange(3)}.example/{i}", f"<head><title>{i}</title></head>" + body))
    rows += rows[:40]
    bodies = collections.defaultdict(set)
    for _, url, page in rows:
        bodies[html_text.host_of(url)].add(page[page.index("<body"):])
    want = {}
    for host, pages_of in bodies.items():
        seen = collections.Counter()
        for page in pages_of:
            seen.update({k for _, k in html_text.hashed(html_text.parse(page), host)})
        want |= seen | {html_text._host_key(host): len(pages_of)}
    folder, bits, there = html_text.template_store(pages(spark, rows), "url", "html")
    import numpy as np

    keys = np.array(sorted(want), np.uint64)
    hit, (n,) = html_text.Shards(folder, bits, "key", ("pages",), there).find(keys)
    for k, there, count in zip(keys.tolist(), hit.tolist(), n.tolist()):
        assert there == (want[k] >= html_text.MIN_PAGES)
        assert not there or count == pytest.approx(want[k], abs=1e-6)


def test_the_template_part_decides(spark, monkeypatch):
    rows = [(i, f"http://h.example/{i}", SITE.format(i)) for i in range(12)]
    assert extract(spark, rows)[3] == "3\nStory 3 in its own words"
    monkeypatch.setattr(html_text, "MIN_PAGES", 10**6)
    assert extract(spark, rows)[3].startswith("Welcome here\n")


@pytest.mark.parametrize("name", ["side-by-side", "social-history", "legal", "search-results", "related-work", "login-story"])
def test_class_words_inside_articles_say_nothing(name):
    assert text(f"<article><p>a</p><div class='{name}'><p>b</p></div></article>") == "a\nb"


@pytest.mark.parametrize("name", ["comments", "ad", "share", "related wide", "big newsletter"])
def test_whole_names_inside_articles_do(name):
    assert text(f"<article><p>a</p><div class='{name}'><p>b</p></div></article>") == "a"


def test_large_hosts_need_no_share():
    menu, story = html_text.Node("div", None, False), html_text.Node("p", None, False)
    assert html_text.is_template(menu, 150_000, 1_000_000) and not html_text.is_template(story, 150_000, 1_000_000)


@pytest.mark.parametrize("page", [
    "<a " * 200_000, "<p>x</p>" + "<a '" * 200_000, "<script>" + "</script " * 100_000, "<div>" * 50_000 + "</x>" * 50_000,
    "<span>" * 50_000 + "<hr>" * 50_000, "<!--" * 100_000, "<![CDATA[" * 50_000, "<article>" * 30_000 + "<header><h1>" * 30_000,
    "<header>" + "<h2>x</h2>" * 30_000 + "</header>", "<p><b>" * 30_000, "<li>" * 60_000, "<" * 300_000, "<a href=\"" * 100_000 + ">",
])
def test_broken_markup_is_read_in_linear_time(page):
    import time

    began = time.process_time()
    text(page)
    assert time.process_time() - began < 6
