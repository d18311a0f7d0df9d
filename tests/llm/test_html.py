"""HTML extraction: attributes as browsers read them, languages without stop words, articles without markup."""

import re

import duckdb
import pytest

from cairnflow.llm import html_extract
from tests.llm.test_operators import PROSE, planted

RUSSIAN = "Сегодня утром в городе прошёл сильный дождь, поэтому многие жители остались дома. Днём погода улучшилась, и люди вышли гулять в парки и на набережную."
CHINESE = "今天早上城里下了一场大雨，所以很多居民都留在家里。下午天气好转，人们纷纷走出家门，到公园和河边散步。孩子们在草地上玩耍，老人们坐在长椅上聊天。"
FINNISH = "Tänään aamulla kaupungissa satoi rankasti, joten monet asukkaat jäivät kotiin. Iltapäivällä sää parani ja ihmiset lähtivät puistoihin kävelylle."
FIGURES = "1990 12.5 1991 13.5 1992 14.5 1993 15.5 1994 16.5 1995 17.5 1996 18.5"
MENU = '<ul class="x"><li><a href="/a">Eins</a></li><li><a href="/b">Zwei und drei</a></li></ul>'


@pytest.mark.parametrize("text", [RUSSIAN, CHINESE, FINNISH])
def test_prose_of_any_language_without_article(text):
    page = f"<body>{MENU}<h1>Title</h1><div>{text}</div><div>{text}</div>{MENU}</body>"
    assert html_extract.main_text(page) == f"Title\n{text}\n{text}"
    assert html_extract.main_text(f"<article><h1>Title</h1><p>{text}</p>{MENU}</article>") == f"Title\n{text}"


@pytest.mark.parametrize("between", [FINNISH, CHINESE, FIGURES])
def test_what_has_no_stop_words_goes_with_its_neighbours(between):
    assert html_extract.main_text(f"<div>{PROSE}</div><div>{between}</div><div>{PROSE}</div>") == f"{PROSE}\n{between}\n{PROSE}"


def test_quotes_enclose_only_after_an_equals_sign():
    assert html_extract.main_text("<img alt='it's nice' src=x> more it's text") == "more it's text"
    assert html_extract.main_text("<p title=it's>Lost sentence here is kept?</p>") == "Lost sentence here is kept?"
    assert html_extract.main_text('<p class="a"id=b>x</p><p =a b==c>y</p><p a = "1 > 2" >z</p>') == "x\ny\nz"
    assert html_extract.main_text(f'<p>{PROSE} <b title="never closed>bold</b> end</p>') == f"{PROSE} bold end"
    assert html_extract.main_text(f'<p>{PROSE}</p><p data-id="sidebar" title="class=footer">{PROSE}</p>') == f"{PROSE}\n{PROSE}"
    assert html_extract.main_text(f"<p>{PROSE}</p><p>{'<a b=' * 20_000}") == PROSE  # no stall


def test_links_are_measured_as_they_are_read():
    entity = "&amp;" * 12
    page = f"<div>{PROSE}</div><div><a href=x>{entity}\n\n\n   {' ' * 200}</a> {PROSE}</div><div>{PROSE}</div>"
    assert html_extract.main_text(page) == f"{PROSE}\n{'&' * 12} {PROSE}\n{PROSE}"


def test_a_cited_title_in_an_article_stays():
    title = "The complete and unabridged history of everything that was ever cited"
    assert html_extract.main_text(f"<article><p>{PROSE}</p><p><a href=x>{title}</a></p><p>{PROSE}</p></article>") == f"{PROSE}\n{title}\n{PROSE}"


def test_given_articles_in_plain_boxes():
    """With article and main turned into div nearly all articles of the given pages come out whole; words of no listed language too."""
    pages = [h for (h,) in duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet' WHERE html IS NOT NULL").fetchall()]
    boxed = [re.sub(r"<(/?)(?:article|main)>", r"<\1div>", h) for h in pages]
    same = sum(html_extract.main_text(b) == planted(h) for b, h in zip(boxed, pages, strict=True))
    assert same >= 0.95 * len(pages)
    # Every word between tags spelled backwards is in no list of stop words.
    turned = [re.sub(r"(?<=>)[^<]+", lambda m: re.sub(r"(?<!&)\b[^\W\d_]{2,}\b(?!;)", lambda w: w[0][::-1] + "x", m[0]), h) for h in pages]
    kept = sum(html_extract.main_text(t) == planted(t) for t in turned)
    assert kept >= 0.9 * len(pages)
