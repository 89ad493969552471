import numpy as np
import pytest

from fareflow.llm.html_text import extract, main_text, smoothed, threshold

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href="/a">A menu entry</a></li></ul></nav>
<div class="cookie-notice">We use cookies for many long and good reasons, as this long sentence is to say.</div>
%s
<aside>Something else to read</aside><div id="comments"><p>A reader's comment that is as long as a paragraph of the text.</p>
</div><form><input><button>Send</button></form><footer>&copy; someone</footer></body></html>"""
TEXT = "".join(f"<p>Paragraph {i} of the &amp; text&nbsp;with\n <b>bold <i>words</b> and</i> a<br>break, long enough.</p>" for i in range(6))
WANT = " ".join(f"Paragraph {i} of the & text with bold words and a break, long enough." for i in range(6))


@pytest.mark.parametrize("shape", ["<article>%s</article>", "<main><div>%s</div></main>", "<div class='c'>%s</div>"])
def test_article_only(shape):
    assert main_text(PAGE % (shape % ("<h1>Head</h1><p>Short.</p>" + TEXT))) == f"Head Short. {WANT}"


def test_inside_the_article():
    advert = "<div class='ad'>Buy this</div><!-- a note --><section class='newsletterSignup'>Mail me</section>"
    assert main_text(PAGE % f"<article>{advert}{TEXT}{advert}</article>") == WANT


def test_a_short_article_among_long_lines():
    long = "<div>" + "A long line that is not in the article at all. " * 9 + "</div>"
    assert main_text(f"<body>{long}<article><h1>Hi.</h1></article>{long}</body>") == "Hi."


def test_broken_markup():
    assert main_text("<article><p><b>One<br><p>two &amp three<p>four < five") == "One two & three four < five"
    assert main_text("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == "a b c d"
    assert main_text("plain text") == "plain text"
    assert main_text("</p></b><p>") == main_text("") == main_text(None) == ""
    assert main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert main_text("<article><p>" + "x " * 200_000 + "</p></article>") == ("x " * 200_000).strip()


def test_smoothing_and_threshold():
    values = smoothed(np.array([1.0, 1, 1, 90, 100, 95, 1, 1]))
    limit = threshold(values)
    assert 20 < limit < 80 and (values > limit).tolist() == [False] * 3 + [True] * 3 + [False] * 2
    assert smoothed(np.array([5.0])).tolist() == [5.0] and threshold(np.array([5.0])) == 5.0


def test_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE % f"<article>{TEXT}</article>"), (1, "u", None), (None, None, ""), (2, "u", "<p>é</p>")],
        "page_id long, url string, html string",
    ).selectExpr("*", "'x' AS text", "0 AS N_CHARS")
    out = extract(pages, drop=("html",))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["text"], r["n_chars"]) for r in out.collect()) == [("", 0), ("", 0), (WANT, len(WANT)), ("é", 1)]
    assert extract(pages.limit(0)).count() == 0
