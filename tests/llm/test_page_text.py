import html
import random
import re

import pytest

from larder.llm import page_text, queries

SCHEMA = "page_id long, url string, html string, host string, codes int, drops string"


def longest(a, b):
    """Indexes of ``a`` in a longest common subsequence with ``b``, the earliest, by a full table."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(
                best[i + 1][j], best[i][j + 1])
    found, j = [], 0
    for i in range(len(a)):
        if a[i] in b[j:] and best[i][j]:
            k = b.index(a[i], j)
            if 1 + best[i + 1][k + 1] == best[i][j]:
                found.append(i)
                j = k + 1
    return found


def location(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    return host.lower(), rest[len(host):]


def brute(rows):
    """Texts by row: all pages sorted, each compared with the pages beside it."""
    pages = sorted(((*location(url), i) for i, (_, url, _) in enumerate(rows)))
    lines = [page_text.lines_of(text or "") for _, _, text in rows]
    said = [[t for t, _, _ in found] for found in lines]
    out = {}
    for at, (host, _, i) in enumerate(pages):
        sides = [pages[k][2] for k in (at - 1, at + 1)
                 if 0 <= k < len(pages) and pages[k][0] == host]
        sides = [set(longest(said[i], said[k])) for k in sides if said[k] != said[i]]
        gone = set.intersection(*sides) if sides else set()
        out[i] = " ".join(t for n, (t, kind) in enumerate(zip(
            said[i], page_text.candidates(lines[i]))) if kind == 2 or kind == 1 and n not in gone)
    return sorted((str(rows[i][0]), str(rows[i][1]), text) for i, text in out.items())


def frame(spark, rows, slices=4):
    return spark.createDataFrame([(*r, "h", 1, "d") for r in rows], SCHEMA).repartition(slices)


def result(frame):
    return sorted((str(r.page_id), str(r.url), r.text) for r in frame.collect())


def plain_page(pick, n):
    """No article element: head lines, own lines, tail lines of a site."""
    own = [f"own {n} {pick.randrange(4)}" for _ in range(pick.randrange(5))]
    tail = ["all rights", "call us"][:pick.randrange(3)]
    return "".join(f"<div>{t}</div>" for t in ["welcome", "news", *own, "more", *tail, "more"])


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    pick = random.Random(seed)
    rows = [(i, f"http://{pick.choice(['a.org', 'A.org', 'b.org', 'big.org', 'big.org'])}"
                f"/{pick.choice(['en', 'fr'])}/{i}", plain_page(pick, i)) for i in range(120)]
    rows += [(500 + i, f"http://big.org/copy/{i}", "<p>same</p><p>lines</p>") for i in range(40)]
    rows += [(None, None, "<p>x</p>"), (1, "no scheme", "<p>x</p>"), (2, "http://c.org/", None),
             (3, "http://c.org/1", ""), (4, "http://lone.org?q", "<p>alone</p>")]
    assert result(page_text.extracted(frame(spark, rows))) == brute(rows)


def test_template_goes_and_articles_stay(spark):
    licence = "<p>All text under a free licence.</p>"
    page = ("<div>Site</div><article><h1>{0}</h1><div>Share this</div><p>Text {0}.</p>" + licence
            + "</article><div>Contact</div>")
    rows = [(i, f"http://a.org/{i}", page.format(f"n{i}")) for i in range(4)]
    assert result(page_text.extracted(frame(spark, rows))) == [
        (str(i), f"http://a.org/{i}", f"n{i} Text n{i}. All text under a free licence.")
        for i in range(4)]
    loose = [(i, f"http://a.org/{i}", f"<b>Site</b><br>Text {i}<hr>Contact") for i in range(3)]
    assert [t for _, _, t in result(page_text.extracted(frame(spark, loose)))] == [
        "Text 0", "Text 1", "Text 2"]
    # A copy beside a page tells nothing: its lines stay, the template of both goes.
    twice = loose + [(9, "http://a.org/1", loose[1][2])]
    assert [t for _, _, t in result(page_text.extracted(frame(spark, twice)))] == [
        "Text 0", "Text 1", "Text 2", "Text 1"]


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "http://a.org/1", "<p>a</p><p>b</p>")] * 3 + [
        (2, "http://a.org/2", "<p>a</p><p>c</p>")]
    assert result(page_text.extracted(frame(spark, rows))) == [
        ("1", "http://a.org/1", "b")] * 3 + [("2", "http://a.org/2", "c")]
    assert result(page_text.extracted(frame(spark, rows).limit(0))) == []


@pytest.mark.parametrize("page, text", [
    ("<article><h1>A &am</h1><p><b>x<br><p>y&amp;&lt;z</article><footer>f</footer>", "A &am x y&<z"),
    ("<script>var t='<p>no</p>';</script><p>a <i>b</i>c\n\td</p>", "a bc d"),
    ("<nav>n<ul><li>m</nav><!-- c <p>x</p> --><main>q<aside>s</aside>r</main>", "q r"),
    ("<div class='Cookie-notice'>no<div>no</div></div><div id=\"content\">yes</div>", "yes"),
    ("<article>a<div class=comments><article>c</article></div></article>", "a"),
    ("<div class=promo>x<article>y</article></div>", "y"),
    ("<p title='a > b'>x</p><form>f<p>g</form><p hidden>h", "x h"),
    ("<header>h</header><article><header><h1>t</h1></header>u</article>", "t u"),
    ("a < b <3 & c", "a < b <3 & c"), ("<!-- open <p>x", ""), ("<script>open", ""),
    ("<p " + "a=\"" * 50 + "<p>x", None), ("", ""), ("   ", ""),
])
def test_lines(page, text):
    lines = page_text.lines_of(page)
    got = " ".join(t for (t, _, _), kind in zip(lines, page_text.candidates(lines)) if kind)
    assert got == text or text is None


def test_long_alignments_stay_small():
    pick = random.Random(4)
    own, other = ([pick.randrange(50) for _ in range(6000)] for _ in range(2))
    found = page_text.shared(own, other)
    assert len(found) > 1000 and found == sorted(found)
    for seed in range(300):
        pick = random.Random(seed)
        a, b = ([pick.randrange(3) for _ in range(pick.randrange(25))] for _ in range(2))
        assert page_text.shared(a, b) == longest(a, b)


def test_query_gives_the_articles(spark, sf_dir):
    """The test pages have one article element each; their other parts differ from page to page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    want = []
    for r in pages:
        body = re.search(r"(?s)<article>(.*?)</article>", r.html).group(1)
        body = re.sub(r"</?b>", "", body)
        text = " ".join(html.unescape(re.sub(r"<[^>]*>", "\n", body)).split())
        want.append((r.page_id, r.url, text, len(text)))
    assert sorted(tuple(r) for r in queries.op11_page_text(spark, sf_dir).collect()) == sorted(want)
