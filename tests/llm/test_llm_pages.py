"""Extraction: lines, differencing, and pages whose article is known."""

import random

import pytest

from stockrecon.llm import page_diff as D
from stockrecon.llm.page_lines import lines

PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize(
    "page,expected",
    [
        ("", []),
        ("plain  text\n", ["plain text"]),
        ("<p>a<b>b</b>c<p>d<br>e</p>", ["abc", "d", "e"]),
        ("<nav>x</nav><article><h1>T</h1><p>a &amp; b&nbsp;c &lt;i&gt;</article>footer", ["T", "a & b c <i>"]),
        ("<div class='ad box'>x<p>y</p></div><p>z", ["z"]),
        ("<article><p>a<aside>no</aside>b<form>f</form><!-- c > --> d</article>", ["a", "b", "d"]),
        ("<script>if (a<b) '</p>'</script><style>p{}</style><p>ok", ["ok"]),
        ('<p title="a>b">x</p><p class=cookie-notice>no</p><p>y', ["x", "y"]),
        ("<p class=ad>no<p>yes", ["yes"]),
        ("<main><p>a</p><section id=comments><article>c</article></section></main>", ["a"]),
        ("<article><p>cut <b", ["cut"]),
        ("<article>a < b &am", ["a < b &am"]),
        ("<article>x<!-- never closed", ["x"]),
        ("<ul class='sideBar'><li>a</ul><p>b", ["b"]),
        ("<header>h</header><article><header><h1>t</h1></header>x</article>", ["t", "x"]),
        ("<p hidden>h</p><div aria-hidden='true'>i</div><p>b", ["b"]),
        ("<html><head><meta x><title>t</title><body><p>story", ["story"]),
        ("<head><title>t</title><article><p>story</article>", ["story"]),
        ("<head>bare text<p>more", ["bare text", "more"]),
        ("<div class='layout has-sidebar'><p>story</div>", ["story"]),
        ("<div class='post no-comments'><article>story</article></div>", ["story"]),
        ("<div id='page-with-menu'><nav>m</nav><p>story</div>", ["story"]),
        ("<div role='search-results'><p>story</div>", ["story"]),
        ("<div class='sidebar-layout'><article>story</article></div>", ["story"]),
        ("<form action=x><header>h</header><div><p>story<p>goes on</div></form><footer>f</footer>", ["story", "goes on"]),
        ("<form><article>story</article></form>", ["story"]),
        ("<nav><ul><li>Home<li>News<article><p>story</article>", ["story"]),
        ("<ul><li class=share>no<li>yes</ul>", ["yes"]),
        ("<table><tr><td class=ad>no<td>yes<tr><td>and</table>", ["yes", "and"]),
        ("<div><p>the whole long story of the page in a plain element</div><article>teaser</article>",
         ["the whole long story of the page in a plain element", "teaser"]),
        ("<div><p>story</div><section class=comments><article>c1</article><article>c2</article></section>", ["story"]),
        ("<section class=comments><article>c1</article></section>", []),
        ("<div class=menu><p>a</div><div class=cookie><p>b</div>", []),
    ],
)
def test_lines(page, expected):
    assert lines(page)[0] == expected


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_lines_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
        found = D.common_lines(a, b)
        assert found == sorted(set(found)) and len(found) == lcs(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found)


def page(*parts):
    return "<body>" + "".join(f"<div>{p}</div>" for p in parts) + "</body>"


def test_shared_lines_of_the_nearest_page_are_deleted(spark):
    rows = [
        (1, "http://h.com/a/1", page("Site name", "first story", "more of it", "and more", "Read next")),
        (2, "http://h.com/a/2", page("Site name", "second story", "goes on", "to its end", "Read next")),
        (3, "http://h.com/b/9", page("Other head", "third", "Read next")),
        (4, "http://other.com/a/1", page("Site name", "alone")),
        (5, None, None),
    ]
    got = {r.page_id: r.text for r in D.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {1: "first story more of it and more", 2: "second story goes on to its end", 3: "Other head third", 4: "Site name alone", 5: ""}


def test_marked_articles_keep_lines_that_neighbours_quote(spark):
    body = "<div>Head</div><article><p>quoted<p>own {0}<p>and {0}<p>more {0}</article>"
    rows = [(i, f"http://h.com/{i}", body.format(i)) for i in range(3)]
    got = {r.page_id: r.text for r in D.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: f"quoted own {i} and {i} more {i}" for i in range(3)}


def test_marked_pages_are_differenced_too(spark):
    """Site text within a marked article goes, paragraphs that neighbours quote stay."""
    body = "<main><div>Share this page</div><h1>News</h1><p>own {0}<ul><li>quoted</ul><div>more {0}<br>and {0}</div><p>q<br>r</p>Print</main><div>by {0}</div>"
    rows = [(i, f"http://h.com/{i}", body.format(i)) for i in range(3)]
    rows += [(10, "http://s.com/1", "<main><div>alone</div><p>text</main>")]
    got = {r.page_id: r.text for r in D.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: f"News own {i} quoted more {i} and {i} q r" for i in range(3)} | {10: "alone text"}


def test_lines_beside_a_marked_article_count_in_its_neighbour(spark):
    rows = [
        (1, "http://h.com/a", "<div>Head</div><article><p>one<p>two<p>three</article><div>Foot</div>"),
        (2, "http://h.com/b", page("Head", "a story", "goes on", "Foot")),
    ]
    got = {r.page_id: r.text for r in D.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {1: "one two three", 2: "a story goes on"}


def test_every_page_with_lines_meets_its_neighbour(spark):
    """Positions shared with the nearest page are found for marked and unmarked pages alike."""
    rows = [(i, f"http://h.com/{i}", f"<article><p>quoted<p>own {i}<p>more {i}</article>") for i in range(4)]
    parsed = D.page_lines(spark.createDataFrame(rows, PAGES).coalesce(1))
    assert [r.deleted for r in D.site_lines(parsed).collect()] == [[0]] * 4


def test_copies_lose_nothing(spark):
    body = page("a", "b", "c")
    rows = [(i, f"http://h.com/{i}", body) for i in range(4)] + [(3, "http://h.com/3", body)]
    got = D.extract(spark.createDataFrame(rows, PAGES + "").selectExpr("*", "1 AS text", "2 AS row", "3 AS host")).collect()
    assert [r.text for r in got] == ["a b c"] * 5 and {r.n_chars for r in got} == {5}


def test_short_pages_and_stubs_lose_their_boilerplate(spark):
    site = [f"site {i}" for i in range(10)]
    rows = [(i, f"http://h.com/{i}", page(*site, *(f"own {i} {k}" for k in range(8)))) for i in range(2)]
    rows += [(10, "http://s.com/1", page(*site, "stub")), (11, "http://s.com/2", page(*site, *(f"long {k}" for k in range(40))))]
    got = {r.page_id: r.text for r in D.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: " ".join(f"own {i} {k}" for k in range(8)) for i in range(2)} | {10: "stub", 11: " ".join(f"long {k}" for k in range(40))}


def test_a_copy_is_passed_over_for_the_next_nearest_page(spark):
    story = [f"story {k}" for k in range(20)]
    rows = [(i, f"http://h.com/a/{i}", page("Head", *story, "Foot")) for i in range(5)]
    rows += [(5, "http://h.com/a/5", page("Head", *story[:-1], "changed", "Foot"))]
    rows += [(9, "http://h.com/b/1", page("Head", "another", "and more", "Foot"))]
    got = {r.page_id: r.text for r in D.extract(spark.createDataFrame(rows, PAGES).repartition(5)).collect()}
    assert got == {i: " ".join(story) for i in range(5)} | {5: " ".join([*story[:-1], "changed"]), 9: "another and more"}


def test_known_articles(spark):
    rng = random.Random(2)
    rows, truth = [], {}
    for i in range(200):
        title, body = f"Title {rng.random()}", [f"Text &amp; {rng.random()}" for _ in range(rng.randrange(1, 6))]
        truth[i] = " ".join([title, *body]).replace("&amp;", "&")
        rows.append(
            (i, f"http://h{i % 3}.com/{i}", f"<html><head><title>{title}</title></head><body><nav><ul><li><a>Home</a></ul></nav><div class='ad'>Buy</div>"
             f"<article><h1>{title}</h1>{''.join(f'<p>{b}' for b in body)}</article><footer>&copy; h</footer>")
        )
    got = {r.page_id: r.text for r in D.extract(spark.createDataFrame(rows, PAGES).repartition(7)).collect()}
    assert got == truth


def test_neighbours_do_not_depend_on_partitions(spark):
    rng = random.Random(3)
    rows = [(i, f"http://h{i % 2}.com/{rng.randrange(30)}", page("Head", f"s{rng.randrange(6)}", f"t{i}", f"u{i}", "x", "y" * rng.randrange(3))) for i in range(120)]
    one, many = (
        sorted((r.page_id, r.text) for r in D.extract(spark.createDataFrame(rows, PAGES).repartition(n)).collect()) for n in (1, 9)
    )
    assert one == many


def test_no_pages(spark):
    assert D.extract(spark.createDataFrame([], PAGES)).count() == 0
