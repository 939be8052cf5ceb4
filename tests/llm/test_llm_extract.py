import random
from itertools import combinations

import pytest

from tallyrock.llm import extract as E

SCHEMA = "page_id long, url string, html string, text string, row int"


def pages(spark, *rows):
    return spark.createDataFrame([(*r, "other", 1) for r in rows], SCHEMA)


ARTICLE = (
    "<html><head><title>t</title><style>p{}</style></head><body><header><nav><a href='/x'>Menu</a></nav></header>"
    "<div class='ad'>Buy</div><div id=\"cookie-notice\">Accept</div><article><header><h1>Ti&eacute;tle</h1></header>"
    "<p>One <b>bo</b>ld &amp; <i>two</i>\n three<br>four<p title='a>b'>five<script>if (a<b) x();</script>"
    "<div class=\"comments\"><p>nice</p><div>yes</div></div></article><aside>more</aside><form><input><p>mail</p></form>"
    "<footer>&copy; me</footer></body></html>"
)


def test_article_without_its_surroundings(spark):
    found = E.extract(pages(spark, (1, "http://h/a", ARTICLE))).first()
    assert found["text"] == "Tiétle One bold & two three four five"


def test_markup_that_is_cut_off():
    for cut in range(len(ARTICLE)):
        lines = E.page_lines(ARTICLE[:cut])
        whole = " ".join(line for line, kind in lines if kind == E.MAIN_LINE)
        assert "Menu" not in whole and "Buy" not in whole and "mail" not in whole
        assert not any("p{}" in line or "x()" in line for line, _ in lines)
    assert E.page_lines(ARTICLE[: ARTICLE.index("three") + 5])[-1] == ("One bold & two three", E.MAIN_LINE)


def test_what_markup_says_of_lines():
    assert E.page_lines(ARTICLE) == [
        ("Menu", E.DROPPED_LINE), ("Buy", E.DROPPED_LINE), ("Accept", E.DROPPED_LINE), ("Tiétle", E.MAIN_LINE),
        ("One bold & two three", E.MAIN_LINE), ("four", E.MAIN_LINE), ("five", E.MAIN_LINE), ("nice", E.DROPPED_LINE),
        ("yes", E.DROPPED_LINE), ("more", E.DROPPED_LINE), ("mail", E.DROPPED_LINE), ("© me", E.DROPPED_LINE),
    ]
    title = '<article><div class="entry-header"><h1>T</h1></div><p>x</p><div class="ad header">Buy</div></article>'
    assert [line for line, kind in E.page_lines(title) if kind == E.MAIN_LINE] == ["T", "x"]
    assert E.page_lines('<p>one<span class="ad">buy <p>x</span>two</p>') == [("buy", E.DROPPED_LINE), ("x", E.DROPPED_LINE), ("onetwo", E.OTHER_LINE)]
    assert E.page_lines('<p>one<span class="ad">buy') == [("buy", E.DROPPED_LINE), ("one", E.OTHER_LINE)]
    assert E.page_lines('<div class="site-header">H</div><div>t</div>') == [("H", E.DROPPED_LINE), ("t", E.OTHER_LINE)]


LONG = "These are the page's own words, " + "and there are many of them, " * 6 + "as in any paragraph."


def test_the_comparison_decides_on_every_page(spark):
    def page(own, *more):
        lines = ["<p>Read on</p>", "<p>A passage that both articles quote.</p>", f"<p>{own} is said here only.</p>", *more]
        return f"<div>Site of sites</div><article>{''.join(lines)}</article><div>{own} teaser</div><nav>{own} menu</nav>"

    rows = [
        (1, "http://h.org/a/1", page("One")),
        (2, "http://h.org/a/2", page("Two", "<p>Menu line of three</p>") + f"<div>{LONG}</div>"),
        (3, "http://h.org/a/3", f"<nav>Menu line of three</nav><article><p>Three.</p></article><div>{LONG[:60]}</div>"),
        (4, "http://k.org/1", f"<article><p>Read on</p></article><div>{LONG}</div>"),
    ]
    found = {r["page_id"]: r["text"] for r in E.extract(pages(spark, *rows)).collect()}
    assert found == {
        1: "A passage that both articles quote. One is said here only.",
        # Its own paragraph outside the article stays; a line of the article that is a menu elsewhere is not compared with that page.
        2: f"A passage that both articles quote. Two is said here only. Menu line of three {LONG}",
        3: "Three.",
        4: "Read on",
    }


def test_how_lines_read():
    assert [E.prose(x) for x in ("Menu", "one two three four five six seven eight", "Edre.", "“Is it?”", LONG, "")] == [0, 1, 2, 2, 3, 0]


def test_a_line_that_is_a_menu_on_the_neighbour_goes(spark):
    rows = [
        (1, "http://h.org/1", "<nav>Home and garden of all our readers today</nav><article><p>First text.</p><p>More of it.</p></article>"),
        (2, "http://h.org/2", "<article><p>Home and garden of all our readers today</p><p>Second text, which is longer.</p><p>And more.</p></article>"),
    ]
    found = {r["page_id"]: r["text"] for r in E.extract(pages(spark, *rows)).collect()}
    assert found == {1: "First text. More of it.", 2: "Second text, which is longer. And more."}


@pytest.mark.parametrize("seed", range(3))
def test_a_whole_result_equals_brute_force(spark, seed):
    """Lines of all pages follow one order, so that a longest common subsequence is what two pages have in common."""
    random.seed(seed)
    vocabulary = [f"line {k:03} " + " ".join(["word"] * random.choice([0, 3, 30])) + random.choice(["", ".", "?"]) for k in range(60)]
    vocabulary = [" ".join(v.split()) for v in vocabulary]
    rows, kinds = [], {}
    for k in range(60):
        lines = sorted(random.sample(range(60), random.randint(0, 25)))
        own = {i: random.choice([0, 0, 0, 1, 2]) for i in lines}
        if k % 5 == 0:
            own = {i: max(1, v) for i, v in own.items()}  # a page without a main element
        tags = ("article", "div", "nav")
        html = "".join(f"<{tags[v]}><p>{vocabulary[i]}</p></{tags[v]}>" for i, v in own.items())
        if k % 11 == 10:
            own, html = kinds[k - 1], rows[-1][2]  # a copy
        rows.append((k, f"http://h{k % 3 if k % 11 != 10 else (k - 1) % 3}/p{k // 7}/{k:02}", html))
        kinds[k] = own
    order = sorted(rows, key=lambda r: (*E.host_and_path(r[1]), r[0]))
    expected = {}
    for at, (k, url, _) in enumerate(order):
        mine, near = kinds[k], []
        for side in (at - 1, at + 1):
            if 0 <= side < len(order) and E.host_and_path(order[side][1])[0] == E.host_and_path(url)[0]:
                a, b = E.host_and_path(url)[1], E.host_and_path(order[side][1])[1]
                same = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                near.append((same, side < at, order[side][0]))
        theirs = kinds[max(near)[2]] if near else {}
        has_main = 0 in mine.values()
        plain = [i for i, v in mine.items() if v == (0 if has_main else 1)]
        chars = lambda places: sum(len(vocabulary[i]) for i in places)
        if not near or chars(i for i in plain if i in theirs) > 0.8 * chars(plain):
            kept = plain
        else:
            kept = []
            for i, v in mine.items():
                sentence, long = vocabulary[i][-1] in ".?", len(vocabulary[i].split()) >= 8
                paragraph = sentence and len(vocabulary[i].split()) >= 25
                if v == 0 and (i not in theirs or sentence or (theirs[i] == 0 and long)):
                    kept.append(i)
                if v == 1 and i not in theirs and (not has_main or paragraph):
                    kept.append(i)
        expected[k] = " ".join(vocabulary[i] for i in kept)
    found = {r["page_id"]: r["text"] for r in E.extract(pages(spark, *rows)).collect()}
    assert found == expected
    alone = {k: " ".join(vocabulary[i] for i, v in kinds[k].items() if v == (0 if 0 in kinds[k].values() else 1)) for k in kinds}
    assert sum(expected[k] != alone[k] for k in expected) > 10  # the comparison has a say


def test_shared_lines_of_the_nearest_page_go(spark):
    def page(*lines):
        return "".join(f"<div>{x}</div>" for x in lines)

    rows = [
        (1, "http://H.org/a/1.html", page("Site", "First", "text", "End")),
        (2, "http://h.org/a/2", page("Site", "Second", "End")),
        (3, "http://h.org/b/9", page("Site", "Other", "Bye")),
        (4, "http://z.org/a/1", page("Site", "Alone")),
        (5, "http://y.org/1", page("Copy", "of")),
        (6, "http://y.org/2", page("Copy", "of")),
        (7, None, None),
        (None, "::[", page("x")),
        (8, "http://k.org/1", ""),
        (8, "http://k.org/1", ""),
    ]
    found = E.extract(pages(spark, *rows)).collect()
    assert sorted(((r["page_id"] or 0, r["text"]) for r in found)) == [
        (0, "x"), (1, "First text"), (2, "Second"), (3, "Other Bye"), (4, "Site Alone"), (5, "Copy of"), (6, "Copy of"),
        (7, ""), (8, ""), (8, ""),
    ]


def test_neighbours_are_the_same_for_any_number_of_ranges(spark):
    random.seed(2)
    rows = [(k, f"http://h{random.randrange(4)}/p{random.randrange(30)}/{random.randrange(99)}", "<p>x</p>") for k in range(200)]
    answers = []
    for count in ("1", "8", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", count)
        parsed = E.parse_pages(pages(spark, *rows).repartition(3, "page_id").sortWithinPartitions("page_id"))
        parsed = parsed.withColumn("row", parsed["page_id"])
        answers.append({r["row"]: r["partner"] for r in E.neighbours(parsed).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert answers[0] == answers[1] == answers[2]
    order = sorted((*E.host_and_path(u), k) for k, u, _ in rows)
    for k, partner in answers[0].items():
        at = [x[2] for x in order].index(k)
        assert partner in [x[2] for x in order[max(0, at - 1) : at + 2]] and order[at][0] == next(x for x in order if x[2] == partner)[0]


@pytest.mark.parametrize("seed", range(8))
def test_shared_lines_are_a_longest_common_subsequence(seed):
    random.seed(seed)
    mine, theirs = ([random.randrange(4) for _ in range(8)] for _ in range(2))
    pairs = E.shared_lines(mine, theirs)
    places = sorted(pairs)
    assert all(mine[i] == theirs[j] for i, j in pairs.items()) and sorted(pairs.values()) == [pairs[i] for i in places]

    def common(xs):
        it = iter(theirs)
        return all(x in it for x in xs)

    best = max(k for k in range(9) for c in combinations(mine, k) if common(c))
    assert common([mine[p] for p in places]) and len(places) == best


def test_long_and_empty_pages(spark):
    long = "<p>" + "wörd " * 300_000 + "</p>" + "<div>line</div>" * 3000
    found = E.extract(pages(spark, (1, "http://a/1", long), (2, "http://a/2", long[:-15])))
    assert found.where("length(text) > 1000000").count() == 2
    assert E.extract(pages(spark)).count() == 0
