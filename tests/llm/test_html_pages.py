"""Pages whose article must not be lost, and malformed pages of any length."""

import random
import time

import pytest

from tagmatch.llm import html_text
from tests.conftest import TESTDATA

TEXT = "A sentence of the article, with some words in it, that goes on for a while. And one more of them."
MENU = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/a'>About</a></li></ul></nav>"


def paragraphs(n, start=0):
    return [f"{TEXT} Number {i}." for i in range(start, start + n)]


def test_text_in_many_containers_is_all_kept():
    texts = paragraphs(8)
    nested = "".join("<div>" * i + f"<p>{t}</p>" + "</div>" * i for i, t in enumerate(texts, 1))
    assert html_text.main_text(f"<body>{MENU}{nested}</body>") == "\n\n".join(texts)


@pytest.mark.parametrize("name", ["post-content form", "form", "widget", "comments", "search", "ad"])
def test_an_article_of_a_bad_name_keeps_its_text(name):
    texts = paragraphs(5)
    inner = "".join(f"<p>{t}</p>" for t in texts)
    page = f"<body>{MENU}<div class='{name}'>{inner}</div><div class='footer'>Imprint</div></body>"
    assert html_text.main_text(page) == "\n\n".join(texts)
    beside = f"<body>{MENU}<article>{inner}<div class='{name}'><p>Buy it now.</p></div></article></body>"
    assert html_text.main_text(beside) == "\n\n".join(texts)


@pytest.mark.parametrize(
    "broken",
    [
        "<p class=\"x>{0}</p><p>{1}</p>", "<p class='x>{0}</p><p class='y'>{1}</p>", "<p title=\"it's\">{0}</p><p>{1}</p>",
        "<p data-x='a > b'>{0}</p><p>{1}", "<p><b>{0}</i></p><p>{1}</b></p>", "<p>{0}<p>{1}", "<p\n class=x\n>{0}</p ><p/>{1}</p>",
        "<p>{0}</p><!-- <p>gone</p> --><p>{1}</p><!-- open <p>gone</p>", "<p>{0}</p><script>'<p>gone'</script><p>{1}</p><style>p{{}}",
        "<p>{0}</p><p>{1}</p><p class='cut", "<p>{0}</p></section></div><p>{1}</p>",
    ],
)
def test_malformed_tags_are_no_text(broken):
    texts = paragraphs(2)
    page = f"<body>{MENU}<article>" + broken.format(*texts)
    assert html_text.main_text(page) == "\n\n".join(texts)


def test_less_than_signs_are_text():
    assert html_text.main_text("<article><p>If a < b and 3 <4, then <> is a mark, too.</p></article>") == (
        "If a < b and 3 <4, then <> is a mark, too."
    )


LONG = {
    "cut tags": "<a " * 100_000 + "'",
    "quotes": "<a '\"" * 100_000,
    "quotes and ends": "<a x='>\"" * 100_000,
    "nested": "<div>" * 60_000 + "x" + "</div>" * 60_000,
    "nested, with text": "<div>x" * 30_000,
    "unmatched ends": "<b><article>" + "<div>" * 30_000 + "</b>" * 30_000,
    "inline elements": "<i>" * 40_000 + "<p>x</p>" * 40_000,
    "open lists": "<ul>" + "<li><b>x" * 40_000,
    "articles in bad names": "<div class=ad>" * 5_000 + "<article>x</article>" * 20_000,
    "comments": "<!--" * 100_000,
    "raw": "<script>" * 50_000,
    "less-than signs": "<" * 300_000,
    "references": "&amp" * 100_000 + "&#x41;" * 50_000,
    "names": "<p " + "class " * 100_000 + ">x",
    "equals": "<p " + "class=" * 100_000 + ">x",
    "blanks": "<p class" + " " * 300_000 + "x>y",
}


@pytest.mark.parametrize("kind", sorted(LONG))
def test_long_malformed_pages_take_little_time(kind):
    start = time.process_time()
    html_text.main_text(LONG[kind])
    assert time.process_time() - start < 4 * len(LONG[kind]) / 1e6 + 1.0


def test_noise_takes_little_time():
    draw = random.Random(6)
    pieces = ["<", ">", "'", '"', "=", "<a ", "</", "<p>", "<!--", "-->", "<div class='ad'>", "<article>", "</div>", " x ", "&", "<b"]
    page = "".join(draw.choice(pieces) for _ in range(250_000))
    start = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - start < 6


def test_pages_of_the_test_table_have_their_paragraphs(spark):
    """By a plain reading: every piece of text between two tags in article, outside elements
    and names that are not content, is in the text."""
    import html
    import re

    rows = spark.read.parquet(f"{TESTDATA}/sf0.01/pages.parquet").collect()
    with_article = 0
    for row in rows:
        found = re.search(r"(?s)<article[^>]*>(.*?)</article>", row.html or "")
        if found is None:
            continue
        with_article += 1
        text = html_text.main_text(row.html)
        body = re.sub(r"(?s)<(script|style|aside|form|nav|footer)\b.*?</\1>|<div class=['\"]?\w*ad\w*.*?</div>|<!--.*?-->", "", found[1])
        for piece in re.split(r"<[^>]*>", body):
            plain = " ".join(html.unescape(piece).split())
            assert plain in text, (row.page_id, plain[:60])
    assert with_article > 20
