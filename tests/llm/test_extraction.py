"""Main text: minimum cut against all labellings, pages of several makes, odd markup."""

import itertools
import random
import time

import pytest

from sensorloom.llm import extraction
from sensorloom.llm.mincut import labels

ARTICLE = "<h1>A title &amp; more</h1><p>The first paragraph has a good number of words, <b>some bold</b>, and it ends\n here.</p><p>Second one, with a <a href='x>y'>link</a> in it; it goes on for a while so that it counts as prose.</p>"
WANT = "A title & more\nThe first paragraph has a good number of words, some bold, and it ends here.\nSecond one, with a link in it; it goes on for a while so that it counts as prose."


def cost(labelling, one, zero, edges):
    return sum(o if x else z for x, o, z in zip(labelling, one, zero, strict=True)) + sum(w for (i, j), w in edges.items() if labelling[i] != labelling[j])


@pytest.mark.parametrize("seed", range(60))
def test_cut_is_minimal(seed):
    rng = random.Random(seed)
    n = rng.randrange(1, 10)
    one, zero = ([rng.choice([0, 0, 1, 2, 3.5, rng.random() * 4]) for _ in range(n)] for _ in range(2))
    edges = {(i, j): rng.choice([0.4, 1.2, 3, rng.random() * 3]) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}
    got = cost(labels(one, zero, edges), one, zero, edges)
    assert got == pytest.approx(min(cost(x, one, zero, edges) for x in itertools.product((0, 1), repeat=n)))


@pytest.mark.parametrize(
    "page",
    [
        f"<nav><a href=/>Home</a></nav><article>{ARTICLE}</article><footer>&copy; host</footer>",
        f"<body><div class='top-nav'><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div><div id=main>{ARTICLE}</div><div class='sidebar'><p>Popular things you might want to read some day, all of them.</p></div>",
        f"<header><p>Welcome to the site of sites, where all is well and good today.</p></header><main>{ARTICLE}<div class=ad>Buy this now, it is the best thing you will ever buy in your life.</div></main>",
        f"<script>var a='<p>';</script><style>p{{}}</style><main>{ARTICLE}</main><section id='comments'><h2>Comments</h2><p>What a great article this is, I have read it twice and will again.</p></section>",
        f"<main>{ARTICLE}<form><label>Your mail</label><input><button>Send it</button></form></main><div class='cookie-notice'>We use cookies, as everyone does, to see what you like and what not.</div>",
        f"<div class='cookie-consent' role='dialog'>Accept all the cookies of this site, please, and go on.</div><article><header><time>May</time></header>{ARTICLE}",
        f"<div class='with-sidebar'><div class='content'>{ARTICLE}</div><div class='sidebar'><p>More to read on the other side of it.</p></div></div>",
        f"<div class='notice-bar'>Mind the works on the site tonight, all night long.</div><div class=post>{ARTICLE}</div><div class='related-posts'><a href=a>Another one to read</a></div>",
        f"<!-- <p>gone</p> --><main>{ARTICLE}<p hidden>Not seen by anybody at all, so it is not in the text.</p></main><!-- open",
    ],
)
def test_pages(page):
    got = extraction.main_text(page)
    assert [x for x in got.split("\n") if x != "May"] == WANT.split("\n")


def test_odd_markup():
    read = extraction.main_text
    assert read(None) == read("") == read("<p>") == read("<script>if (a<b) x</script>") == ""
    assert read("<main>1 < 2 &lt; 3&nbsp; and <b>so<br>on</main>") == "1 < 2 < 3 and so on"
    assert read("<main><p>a<p>b<ul><li>c<li>d</ul>e</main>") == "a\nb\nc\nd\ne"
    assert read("<p>plain words</p") == "plain words"
    long = "<main>" + "<p>word " * 20_000
    assert read(long).count("\n") == 19_999
    assert read("<div>" * 3000 + "deep text in it") == "deep text in it"


def test_rows(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "x"), (1, "u", f"<article>{ARTICLE}</article>", "x"), (None, None, None, "x"), (3, "v", "", "x")]
    got = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", WANT, len(WANT))] * 2 + [(None, None, "", 0), (3, "v", "", 0)], key=str)
    assert extraction.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        lambda n: "<div>text here. " * n,
        lambda n: "<div class=a>" * n + "<p>some text here, a sentence.</p>" * n,
        lambda n: "<b>" * n + "<h1></h1>text </x>" * n,
        lambda n: "<main>" * n + "<li>text" * n,
    ],
)
def test_time_is_linear_in_nesting(page):
    def seconds(n):
        at = time.process_time()
        extraction.main_text(page(n))
        return time.process_time() - at

    seconds(500)
    assert seconds(16_000) < 24 * max(seconds(2_000), 0.02)
