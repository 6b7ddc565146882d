"""Which elements of a page count as boilerplate."""

from __future__ import annotations

import random

import pytest

from skillgrid.llm import html_extract

from .helpers import prose

LONG = "This is a long paragraph of running text that no menu would have, with more than enough words in it."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f'<div style="overflow:hidden"><article><p>{LONG}</p></article></div>', LONG),
        (f'<article><div style="overflow:hidden"><p>{LONG}</p></div></article>', LONG),
        ('<article><p>See <a href="/hidden/x">the valley</a> and <a href=\'/a?id=share\' title="a hidden valley">more</a>.</p></article>', "See the valley and more."),
        ('<article><p data-id="promo-7" data-role="banner">Kept.</p></article>', "Kept."),
        ('<article><p hidden>a</p><p aria-hidden="true">b</p><p role=banner>c</p><p id="promo">d</p><p CLASS=ad>e</p><p aria-hidden=false>f</p></article>', "f"),
    ],
)
def test_only_real_attributes_count(page, want):
    assert html_extract.main_text(page) == want


BODY = "\n".join([LONG] * 4)
PARAGRAPHS = "".join(f"<p>{x}</p>" for x in BODY.split("\n"))


@pytest.mark.parametrize("mark", ['class="layout has-sidebar"', 'id="search-results"', 'class="post related"', 'class="content no-comment"', "class=related"])
def test_marked_elements_full_of_text_stay(mark):
    ad = "<div class='ad'>Buy</div><div class=ad-slot>Buy</div>"
    assert html_extract.main_text(f"<body><nav>x</nav><div {mark}>{ad}{PARAGRAPHS}<div id=share>Tell</div></div><footer>y</footer></body>") == BODY
    assert html_extract.main_text(f"<article><p>One.</p><section {mark}>{ad}{PARAGRAPHS}</section><p>Two.</p></article>") == f"One.\n{BODY}\nTwo."
    nested = f"<div {mark}><div class=related><p>In.</p>{PARAGRAPHS}<div class=promo>No</div>"
    assert html_extract.main_text(nested) == f"In.\n{BODY}"


def test_thin_marked_elements_go():
    links = "".join(f'<li><a href="/{i}">{LONG}</a></li>' for i in range(9))
    for mark in ("class=sidebar-left", "class='x comment-list'", "id=promo-7", "class=related"):
        assert html_extract.main_text(f"<article><p>One.</p><div {mark}><ul>{links}</ul><p>No.</p></div><p>Two.</p></article>") == "One.\nTwo."
    assert html_extract.main_text("<article><section class='search-methods'><p>Short.</p></section></article>") == "Short."
    assert html_extract.main_text(f"<article><div class=promo><form>{PARAGRAPHS}</form></div><p>Two.</p></article>") == "Two."


def test_deeply_nested_marks_are_read_in_proportion():
    assert html_extract.main_text("<div class=related>" * 20_000 + PARAGRAPHS) == BODY
    assert html_extract.main_text("<div class=ad>" * 20_000 + PARAGRAPHS) == ""


def test_short_blocks_parted_from_the_body_by_an_advert_stay():
    ad = "<div class=ad>Buy</div>"
    far = f"<p>Far.</p>{ad}"
    want = f"Head\n{LONG}\nMiddle.\n{LONG}\nEnd."
    page = f"<h1>Head</h1>{ad}<p>{LONG}</p>{ad}<p>Middle.</p>{ad}<p>{LONG}</p>{ad}<p>End.</p>"
    assert html_extract.main_text(f"<body>{far}{page}{ad}<p>Far.</p></body>") == want
    assert html_extract.main_text(f"<body>{ad}<div><h1>A</h1>{ad}<h2>B</h2>{ad}<p>{LONG}</p></div>{ad}</body>") == f"A\nB\n{LONG}"


@pytest.mark.parametrize("mark", ["id=comments", "class=ad", 'class="newsletter-signup"', 'class="cookie-notice"', 'class="ad-slot top"', "id=sidebar-left"])
def test_long_adverts_comments_and_notices_go(mark):
    long = f"<section {mark}><h2>Heading</h2>{PARAGRAPHS}</section>"
    assert html_extract.main_text(f"<article>{PARAGRAPHS}{long}<p>{LONG}</p></article>") == f"{BODY}\n{LONG}"
    assert html_extract.main_text(f"<body><div>{PARAGRAPHS}{long}<p>{LONG}</p></div></body>") == f"{BODY}\n{LONG}"
    assert html_extract.main_text(f"<body>{long}<div>{PARAGRAPHS}</div>{long}</body>") == BODY


def test_comments_as_nested_articles_and_teasers_of_other_stories():
    comment = f"<article class=comment><p>{LONG}</p></article>"
    assert html_extract.main_text(f"<article>{PARAGRAPHS}{comment}{comment}</article>") == BODY
    teaser = "<article><h3>Related story</h3><p>Read what happened next.</p></article>"
    for page in (f"<article>{PARAGRAPHS}</article>{teaser}", f"{teaser}<main><article>{PARAGRAPHS}</article></main>{teaser}", f"{teaser}{teaser}<article>{PARAGRAPHS}"):
        assert html_extract.main_text(page) == BODY
    assert html_extract.main_text(f"<article><p>{LONG}</p></article><article><p>{LONG}</p></article>") == f"{LONG}\n{LONG}"
    assert html_extract.main_text("<article><p>A.</p></article>") == "A."


def test_copyright_line_after_the_body_goes():
    for line in ("Copyright 2024 Foo", "© 2024 Foo. All rights reserved.", "(c) Foo"):
        assert html_extract.main_text(f"<body><div>{PARAGRAPHS}</div><div>{line}</div></body>") == BODY
    assert html_extract.main_text("<body><p>Copyright 2024 Foo</p></body>") == "Copyright 2024 Foo"


def _page(rng):
    """A page without an article element: its html and its main text."""
    blocks = [prose(rng, rng.randint(25, 90)) for _ in range(rng.randint(2, 9))]
    heads = {rng.randrange(len(blocks)): prose(rng, rng.randint(2, 6)) for _ in range(rng.randint(0, 3))}
    junk = lambda: f"<p>{prose(rng, rng.randint(3, 70))}</p>"
    menu = "<ul>" + "".join(f'<li><a href="/{i}">{prose(rng, 2)}</a></li>' for i in range(rng.randint(3, 9))) + "</ul>"
    aside = [
        lambda: f'<div class="{rng.choice(["ad", "ads", "advert", "ad-slot", "sponsored", "promo"])}">{junk()}</div>',
        lambda: f'<section id="{rng.choice(["comments", "comment-list", "disqus"])}"><h3>{prose(rng, 2)}</h3>{junk()}{junk()}</section>',
        lambda: f'<div class="{rng.choice(["cookie-notice", "newsletter-signup", "notice", "breadcrumbs", "sidebar"])}">{junk()}</div>',
        lambda: f"<form><label>{prose(rng, 4)}</label><input name=q><button>{prose(rng, 1)}</button></form>",
        lambda: f"<aside>{junk()}{menu}</aside>", lambda: f"<script>var x = '<p>{prose(rng, 30)}</p>';</script>",
        lambda: f"<style>.x {{ color: red }} /* {prose(rng, 20)} */</style>", lambda: f"<!-- {prose(rng, 30)} -->", lambda: menu,
    ]
    body, want = "", []
    for i, text in enumerate(blocks):
        if i in heads:
            level = rng.randint(1, 4)
            body += f"<h{level}>{heads[i]}</h{level}>"
            want.append(heads[i])
        shown = text.replace(" ", rng.choice([" ", "\n", " \t "])).replace("ö", "&ouml;")
        if rng.random() < 0.3:
            first, _, rest = shown.partition(" ")
            shown = f'<b>{first}</b> <a href="/l">{rest}</a>' if " " not in rest else f"<em>{first}</em> {rest}"
        body += rng.choice([f"<p>{shown}</p>", f"<div>{shown}</div>", f"<blockquote><p>{shown}</p></blockquote>"])
        want.append(text)
        if i < len(blocks) - 1 and rng.random() < 0.3:
            body += rng.choice(aside)()
    wrap = rng.choice(['<div class="content">{}</div>', '<div id="page"><div class="post">{}</div></div>', "<div>{}</div>", "<table><tr><td>{}</td></tr></table>"])
    top = rng.choice([f"<header><h1>{prose(rng, 3)}</h1></header>", f"<nav>{menu}</nav>", f'<div class="nav">{menu}</div>', ""])
    end = rng.choice([f"<footer>{junk()}</footer>", f'<div id="footer">{junk()}</div>', "<p>Copyright 2024 Foo</p>", ""])
    return f"<html><head><title>{prose(rng, 3)}</title></head><body>{top}{wrap.format(body + rng.choice(aside)())}{end}</body></html>", "\n".join(want)


def test_generated_pages_without_an_article():
    rng = random.Random(12)
    pages = [_page(rng) for _ in range(300)]
    wrong = [(html, want) for html, want in pages if html_extract.main_text(html) != want]
    assert not wrong, (len(wrong), wrong[0][0], html_extract.main_text(wrong[0][0]), wrong[0][1])
