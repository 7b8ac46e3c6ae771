"""HTML extraction over several layouts, hostile pages, and the labels that the cut turns."""

import random
import time

import pytest

from folioscope.llm import html_extract

LONG = "This paragraph of the story is long enough to be told from a menu, as it has many words and ends like a sentence."
MORE = "Another paragraph follows it with a good number of words of its own, so that nobody can take it for a list of links."
COMMENT = "I am a reader who writes a rather long comment under this story, in whole sentences, as some readers do."

#: (page, blocks of its article)
LAYOUTS = {
    "plain divisions": (f"<div><a href=1>Home</a> <a href=2>News</a></div><div><h2>A short title</h2><p>{LONG}<p>So be it<p>{MORE}</div><div><a href=3>About us</a></div>", ["A short title", LONG, "So be it", MORE]),
    "table": (f"<table><tr><td><a href=1>Home</a><br><a href=2>News</a><td><p>{LONG}<p>Why<p>{MORE}</table>", [LONG, "Why", MORE]),
    "article with comments": (f"<nav><a href=1>Home</a></nav><article><h1>Title</h1><p>{LONG}</p><section class='comments'><p>{COMMENT}</p><p>{COMMENT}</p></section></article>", ["Title", LONG]),
    "named containers": (f"<div id='menu'>Pick one of these</div><div class='post-body content'><p>{LONG}</p><p>{MORE}</p></div><div class='sidebar'><p>{COMMENT}</p></div><div class='cookie-notice'>We use cookies to make this work.</div>", [LONG, MORE]),
    "misleading name": (f"<main><div class='social'><p>{LONG}</p><p>{MORE}</p></div></main>", [LONG, MORE]),
    "short lines alone": ("<p>A poem of lines<p>that are all short<p>and have no end<p>but the last one.", ["A poem of lines", "that are all short", "and have no end", "but the last one."]),
    "links in the text": (f"<article><p>{LONG} See <a href=1>this page</a> for it.</p><ul><li>{MORE}</li></ul></article><footer>&copy; us &middot; all of it is ours.</footer>", [f"{LONG} See this page for it.", MORE]),
    "header of the article": (f"<header><a href=/>Site</a></header><article><header><h1>Title of it</h1></header><p>{LONG}</p></article>", ["Title of it", LONG]),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layout(name):
    page, expected = LAYOUTS[name]
    assert html_extract.extract(page).split("\n") == expected


def test_the_cut_turns_labels_without_names():
    turned = blocks = 0
    for name in ("plain divisions", "table"):
        _, scores, content = html_extract.labelled(LAYOUTS[name][0])
        turned += sum((s > 0) != c for s, c in zip(scores, content, strict=True))
        blocks += len(scores)
    assert 2 <= turned < blocks / 2


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 200_000 + "x", '<a "' * 250_000, '<a href="' * 120_000, "<p>a</p>" * 125_000, "<li>" * 250_000, "<p><b><div>" + "<i>" * 100_000 + "</b>" * 100_000, "<" * 1_000_000, "<!--" * 250_000,
        "<script>" * 120_000, "<svg>" * 200_000, "<table><tr><td>a b c" * 40_000, "<div>" * 100_000 + "</p>" * 100_000 + "</span>" * 50_000, "&" * 1_000_000,
        "".join(f"<p>{'w ' * (k % 7 + 1)}</p><a href=x>q</a>" for k in range(30_000)),
    ],
    ids=lambda p: p[:12],
)
def test_a_hostile_page_of_a_megabyte_takes_seconds(page):
    began = time.process_time()
    html_extract.extract(page)
    assert time.process_time() - began < 30


def test_tags_and_quotes():
    assert html_extract.extract("<p title='a > b'>It is kept whole, as it should be.</p>") == "It is kept whole, as it should be."
    assert html_extract.extract('<p title="never closed>Yet its text is read to the end.</p>') == "Yet its text is read to the end."
    assert html_extract.extract("<p title=it's>And an apostrophe is no quote in this place.</p>") == "And an apostrophe is no quote in this place."
    assert html_extract.extract("Is 3 < 4 and 5 > 4? It has always been so.") == "Is 3 < 4 and 5 > 4? It has always been so."
    assert html_extract.extract("<svg><g><text>drawn</text><p>A paragraph ends a drawing that was left open.</p>") == "A paragraph ends a drawing that was left open."
    assert html_extract.extract("<p>  </p>") == html_extract.extract("<!-- no --><script>no</script>") == ""


def test_blocks_against_a_plain_parser():
    """Depths, boxes and links as a quadratic parser that walks the whole stack gives them, over well-formed pages."""
    rng = random.Random(4)

    def grow(depth, above, page, expected):
        for _ in range(rng.randint(1, 3)):
            if depth < 5 and rng.random() < 0.6:
                tag = rng.choice(["div", "section", "ul"])
                number = [0]
                page.append(f"<{tag}>")
                grow(depth + 1, [*above, number], page, expected)
                page.append(f"</{tag}>")
            else:
                word = f"w{len(expected)}"
                page.append(f"<div>{word}</div>")
                expected.append((word, [*above, [0]]))

    for _ in range(40):
        page, expected = [], []
        grow(0, [], page, expected)
        blocks = html_extract.blocks_of("".join(page))
        assert [b.text for b in blocks] == [w for w, _ in expected]
        edges = html_extract.smoothness(blocks)
        for i in range(1, len(blocks)):
            a, b = expected[i - 1][1], expected[i][1]
            shared = sum(x is y for x, y in zip(a, b, strict=False))
            near = html_extract.NEIGHBOUR / (1 + len(a) + len(b) - 2 * shared)
            same = len(a) > 1 and len(b) > 1 and a[-2] is b[-2] or len(a) == len(b) == 1
            assert abs(edges[i - 1, i] - near - (html_extract.SIBLING / 2 if same else 0)) < 1e-9
