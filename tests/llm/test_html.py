"""HTML extraction: the region against brute force, names that only look like boilerplate, depth, and odd tables."""

import time

import numpy as np
import pytest

from tesserae.llm import html_text as ht

W = ht.weights_of({})
PS = "<p>A first paragraph with words enough.</p><p>And another one of them.</p>"
WANT = "A first paragraph with words enough.\n\nAnd another one of them."
NOISE = "<p>" + "Loud words that nobody asked for at all. " * 5 + "</p>"


def slow_region(scores):
    best, at = 0.0, (0, 0)
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            if sum(scores[i:j]) > best + 1e-9:
                best, at = sum(scores[i:j]), (i, j)
    return best


def test_region_against_all_stretches():
    rng = np.random.default_rng(0)
    for n in range(40):
        s = np.round(rng.normal(0, 2, n), 2).tolist()
        i, j = ht.best_region(s)
        assert sum(s[i:j]) == pytest.approx(slow_region(s))


def test_text_is_the_best_stretch_of_a_page():
    """Words of the text are those of the best of all stretches, grown to whole blocks."""
    rng = np.random.default_rng(1)
    tags = ["p", "div", "h2", "li", "span", "b"]
    for _ in range(30):
        page = "".join(f"<{t}>{' '.join(f'w{k}x{int(i)}' for i in range(rng.integers(0, 6)))}</{t}>" + "<hr>" * int(rng.integers(0, 8)) for k, t in enumerate(rng.choice(tags, 12)))
        seq = ht.runs(page)
        kinds = ht.scored_kinds(seq)
        scores = ht.scores_of(seq, kinds, W)
        i, j = ht.best_region(scores)
        assert sum(scores[i:j]) == pytest.approx(slow_region(scores))
        blocks = {r.block for r in seq[i:j] if r.words}
        assert ht.main_text(page, W).split() == " ".join("".join(r.text for r in seq if r.block == b) for b in sorted(blocks)).split()


def test_region_decides():
    """What no name tells from content, the scan does: beside an article words count against."""
    beside = f"<div class=ad>{NOISE}</div>{NOISE}<article>{PS}</article>{NOISE}"
    assert ht.main_text(beside, W) == WANT
    assert ht.best_region(ht.scores_of(ht.runs(beside), ht.scored_kinds(ht.runs(beside)), W)) != (0, len(ht.runs(beside)))


@pytest.mark.parametrize("name", ["side-by-side", "share-price", "related-work", "site-content", "page", "post", "main-content", "search-results", "commentary", "adventure", "header-image", "no-sidebar"])
def test_names_that_are_content(name):
    assert ht.main_text(f"<body><div class='{name}'>{PS}</div></body>", W) == WANT
    assert ht.main_text(f"<body><article><div id='{name}'>{PS}</div></article></body>", W) == WANT


@pytest.mark.parametrize("name", ["ad", "ads", "ad-slot-2", "sidebar", "left-sidebar", "cookie-notice", "share-buttons", "related-posts", "reader-comments", "footer_links", "main-nav", "breadcrumbs", "newsletter-form", "site-footer", "comment"])
def test_names_that_are_not(name):
    assert ht.main_text(f"<body><article><p>A first paragraph with words enough.</p><div class='x {name}'>{NOISE}</div><p>And another one of them.</p></article></body>", W) == WANT


def test_all_articles_of_the_region():
    page = f"<body><main><article><h2>One</h2>{PS}</article><article><h2>Two</h2>{PS}</article></main><article class='comment'>{NOISE}</article></body>"
    assert ht.main_text(page, W) == f"One\n\n{WANT}\n\nTwo\n\n{WANT}"
    assert ht.main_text(f"<article>{PS}<aside>{NOISE * 50}</aside>{PS}</article>", W) == f"{WANT}\n\n{WANT}"  # a long aside doesn't part it


def test_linear_in_depth():
    for page in ("<b>" * 50_000 + PS + "</i>" * 50_000, "<div>" * 50_000 + PS, "<form>" * 50_000 + "</form>" * 50_000 + PS, "<p>" * 50_000 + "</b>" * 50_000 + PS, "<li><a>" * 50_000 + PS, "<script>" + "<!-- <a " * 50_000 + "</script>" + PS):
        t = time.time()
        assert ht.main_text(page, W) == WANT
        assert time.time() - t < 2


def test_tables(spark):
    page = f"<article>{PS}</article>"
    df = spark.createDataFrame([(None, "u", page, "x", 1), (1, None, None, "x", 1), (2, "u", "", None, 1), (2, "u", page, "y", 2), (2, "u", "<p>" + "long " * 300_000, "y", 2)], "page_id long, url string, html string, text string, n_chars int")
    w = ht.learn_weights(df)
    got = sorted((r["page_id"] or 0, r["n_chars"], r["text"][:10]) for r in ht.extracted(df, w).collect())
    assert got == [(0, len(WANT), WANT[:10]), (1, 0, ""), (2, 0, ""), (2, len(WANT), WANT[:10]), (2, 300_000 * 5 - 1, "long long ")]
    assert ht.extracted(df.limit(0), ht.learn_weights(df.limit(0))).count() == 0
