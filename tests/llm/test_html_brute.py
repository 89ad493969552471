"""Extraction against a plain version on well-formed pages, and the time of deep pages."""

import math
import random
import re
import time

import pytest

from fareflow.llm.html_text import main_text

INLINE = ("a", "b")


def lines_of(page):
    """(text, tags, path of (number, tag)) of every line, by cutting the page at its tags."""
    lines, path, text, tags, number = [], [], "", 0, 0
    for token in re.findall(r"<[^>]+>|[^<]+", page):
        if not token.startswith("<"):
            text += token
            continue
        tag = token.strip("</>")
        tags += 1
        if tag in INLINE:
            continue
        if text.split():
            lines.append((" ".join(text.split()), tags, tuple(path)))
        text, tags = "", 0
        if token.startswith("</"):
            path.pop()
        else:
            number += 1
            path.append((number, tag))
    return lines


def is_content(lines):
    ratios = [len(text) / max(tags, 1) for text, tags, _ in lines]
    weight = lambda d: math.exp(-d * d / 2)
    smooth = []
    for i in range(len(ratios)):
        near = [j for j in range(i - 2, i + 3) if 0 <= j < len(ratios)]
        smooth.append(sum(ratios[j] * weight(i - j) for j in near) / sum(weight(i - j) for j in near))
    low, high = min(smooth), max(smooth)
    for _ in range(20):
        middle = (low + high) / 2
        upper, lower = [x for x in smooth if x > middle], [x for x in smooth if x <= middle]
        if not upper or not lower:
            break
        low, high = sum(lower) / len(lower), sum(upper) / len(upper)
    least = min((low + high) / 2, max(smooth))
    both = [s >= least and r >= least for s, r in zip(smooth, ratios)]
    return both if any(both) else [s >= least for s in smooth]


def brute(page):
    """The text by whole paths of blocks, for pages whose region is a block with others beside it or in an article."""
    lines = lines_of(page)
    if not lines:
        return ""
    chosen = [line for line, yes in zip(lines, is_content(lines)) if yes]
    common = []
    for level in zip(*[path for *_, path in chosen]):
        if len(set(level)) > 1:
            break
        common.append(level[0])
    inside = lambda block: [i for i, (*_, path) in enumerate(lines) if block is None or block in path]
    top = next((b for b in common if b[1] == "article"), None)
    if top:
        return " ".join(lines[i][0] for i in inside(top))
    while common and len(inside(common[-1])) == 1 < len(lines):
        common.pop()
    article = lambda path: next((b for b in path if b[1] == "article"), None)
    held = [line for line in chosen if article(line[2])]
    tops = {article(path) for *_, path in held}
    if tops and 2 * sum(len(t) for t, *_ in held) >= sum(len(t) for t, *_ in chosen):
        return " ".join(t for t, _, path in lines if article(path) in tops)
    of = lambda: inside(common[-1] if common else None)
    if len(of()) == len(lines):
        return " ".join([t for t, _, path in lines if article(path) and not tops] or [t for t, *_ in lines])
    while len(common) > 1 and inside(common[-2]) == of():
        common.pop()
    start, end = of()[0], of()[-1] + 1
    first = inside(common[-2] if len(common) > 1 else None)[0]
    before = start
    while before > first and (len(lines[before - 1][2]) <= len(common) or lines[before - 1][2][-1][1] == "h2"):
        before -= 1
    while before < start and lines[before][2][-1][1] not in ("h2", "p"):
        before += 1
    return " ".join(t for t, *_ in lines[before:end])


def tree(pick, depth):
    """A well-formed part of a page: every text is in a block of its own."""
    if depth == 0 or pick.random() < 0.35:
        n = pick.choice([2, 5, 30, 60])
        text = " ".join(pick.choice(["wine", "river", "and", "stone", "lanterns"]) for _ in range(n))
        if pick.random() < 0.4:
            text = " ".join(f"<a>{w}</a>" for w in text.split()[:8])
        tag = pick.choice(["p", "p", "h2"])
        return f"<{tag}>{text}</{tag}>"
    tag = pick.choice(["div", "div", "section", "article"]) if depth < 4 else "div"
    return f"<{tag}>{''.join(tree(pick, depth - 1) for _ in range(pick.randrange(1, 5)))}</{tag}>"


@pytest.mark.parametrize("seed", range(8))
def test_against_brute_force(seed):
    pick = random.Random(seed)
    for _ in range(150):
        page = f"<body>{''.join(tree(pick, 4) for _ in range(pick.randrange(1, 4)))}</body>"
        assert main_text(page) == brute(page), page


@pytest.mark.parametrize(
    "page",
    ["<div>x" * 100_000, "<b>x" * 100_000, "<ul>" + "<div>" * 50_000 + "<li>a</li>" * 50_000, "<table>" * 30_000 + "<td>a" * 30_000,
     "<p>" + "<i>a" * 50_000 + "</i>" * 50_000 + "</u>" * 50_000, "<article>" + "<div>some text here" * 50_000],
    ids=["blocks", "inline", "items", "cells", "stray ends", "article"],
)
def test_time_does_not_grow_with_nesting(page):
    start = time.process_time()
    assert main_text(page)
    assert time.process_time() - start < 20


@pytest.mark.parametrize("open_", ['<section class="related-work">', '<p class="legal">', '<p id="alert">', '<div class="widget-area-x">'])
def test_names_that_hold_a_mark_are_no_marks(open_):
    body = "<p>A long paragraph of the article, with some words in it.</p>" * 5
    assert "kept text" in main_text(f"<body><article>{body}{open_}kept text</{open_[1:].split()[0]}></article></body>")


@pytest.mark.parametrize("name", ["ad", "ad-slot", "related", "newsletterSignup", "comments-list", "cookieNotice", "sidebar-left", "nav main"])
def test_names_of_marks_are(name):
    body = "<p>A long paragraph of the article, with some words in it.</p>" * 5
    assert "gone" not in main_text(f"<body><article>{body}<div class='{name}'>gone</div></article></body>")
