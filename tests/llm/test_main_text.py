"""Main text: whole blocks, wrappers named after chrome, optional end tags, and the scan against all ranges."""

import random

import pytest

from riskweave.llm import html_main_text as M

LONG = " ".join(["These plain words make a sentence that goes on until it counts as text."] * 4)


def brute_region(tokens, weights):
    best, found = 0.0, (0, 0)
    scores = [weights.get(f, weights["other"]) * n for f, n, _, _ in tokens]
    for low in range(len(scores)):
        total = 0.0
        for high in range(low + 1, len(scores) + 1):
            total += scores[high - 1]
            if total > best + 1e-9:
                best, found = total, (low, high)
    return best, found


def test_scan_against_all_ranges():
    draw = random.Random(5)
    features = [M.WORD, M.LINKED, "p", "li", "nav", "made-up"]
    for _ in range(300):
        tokens = [(draw.choice(features), draw.randint(0, 5), "", False) for _ in range(draw.randint(0, 30))]
        best, _ = brute_region(tokens, M.START)
        low, high = M.best_region(tokens, M.START)
        assert sum(M.START.get(f, -1.0) * n for f, n, _, _ in tokens[low:high]) == pytest.approx(best)


TRAINED = {**M.START, "p": -0.01, "br": -0.01, "h1": -0.01}
PAGES = {
    "wrapper named after chrome": (f"<body><div class='has-sidebar'><h1>T</h1><p>{LONG}</p></div></body>", f"T\n{LONG}"),
    "wrapper that is a form": (f"<body><form id=f><article><h1>T</h1><p>{LONG}</p></article></form></body>", f"T\n{LONG}"),
    "notice without an end tag": (f"<body><p class='notice'>Careful<p>{LONG}<p>more text here</body>", f"{LONG}\nmore text here"),
    "chrome that is never closed": (
        f"<body><article><p>{LONG}</p><div class='notice'>Careful<p>{LONG}</p><p>Rest</p></article></body>", f"{LONG}\n{LONG}\nRest"),
    "menu that is never closed": (f"<body><nav><ul><li><a href=x>home</a></ul><article><p>{LONG}</p></article></body>", LONG),
    "short list and last sentence": (f"<body><div><p>{LONG}</p><ul><li>x<li>y</ul><p>End.</p></div></body>", f"{LONG}\nx\ny\nEnd."),
    "heading and small table": (
        f"<body><div><p>{LONG}</p><h2>Data</h2><table><tr><td>1<td>2<tr><td>3<td>4</table></div></body>", f"{LONG}\nData\n1 2\n3 4"),
    "section on related work": (
        f"<body><div><p>{LONG}</p><div id='related-work'><h2>Related work</h2><p>{LONG}</p></div></div></body>",
        f"{LONG}\nRelated work\n{LONG}"),
    "comments longer than the article": (
        f"<body><nav><a href=x>a</a></nav><div class=post><h1>T</h1><p>{LONG}</p><h2>Comments</h2><div class='comment-list'>"
        f"<article><p>{LONG * 6}</p></article></div></div><footer>f</footer></body>", f"T\n{LONG}"),
    "advert between paragraphs": (
        f"<body><article><p>{LONG}</p><div class='google-ad'>Buy <b>now</b></div><p>End.</p></article></body>", f"{LONG}\nEnd."),
    "list of links behind the text": (
        f"<body><div><p>{LONG}</p><ul><li><a href=1>one</a><li><a href=2>two</a></ul></div></body>", LONG),
    "cell of a page laid out as a table": (
        f"<body><table><tr><td><a href=1>menu</a><td><p>{LONG}</p><p>End.</p></table></body>", f"{LONG}\nEnd."),
    "only a heading": ("<body><article><h1>Only a title of some words</h1></article></body>", "Only a title of some words"),
    "only an advert": ("<body><div class=ad>Buy now</div></body>", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(name):
    page, text = PAGES[name]
    assert M.main_text(page, M.START) == text
    assert M.main_text(page, TRAINED) == text


def test_columns_named_like_ours(spark):
    rows = [(1, "old", f"<article><p>{LONG}</p></article>")] * 2
    found = M.extract(spark.createDataFrame(rows, "page_id long, text string, html string"), M.START)
    assert [tuple(r) for r in found.collect()] == [(1, LONG)] * 2


def test_any_markup_is_read():
    draw = random.Random(11)
    parts = ["<div>", "</div>", "<p>", "</p>", "<li>", "<td class='ad'>", "</table>", "<nav>", "</nav>", "<a href=x>", "</a>", "word ", "<",
             "<div id=comments>", "<article>", "</article>", "<br>", "&amp;", "<!-- x", "<script>", "</script>", "</body>", "<body>", "<h2>"]
    for _ in range(500):
        page = "".join(draw.choice(parts) for _ in range(draw.randint(0, 40)))
        M.main_text(page, M.START)
