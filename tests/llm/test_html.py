"""Main text of pages whose classes, links and short paragraphs say less than they seem to."""

import pytest

from strata.llm.html import main_text

P = "A paragraph of the article with quite some text in it, about one thing and another. "
ART = "".join(f"<p>{i}. {P * 2}</p>" for i in range(3))
TEXT = [f"{i}. {(P * 2).strip()}" for i in range(3)]
SIDE = "<p>Side text that should go away, really, as it is long enough to be a paragraph.</p>"
MENU = "<ul>" + "<li><a href='/x'>entry</a></li>" * 5 + "</ul>"


@pytest.mark.parametrize("name", ["content has-sidebar", "layout no-sidebar", "post with-comments", "entry related-news", "page widget-page", "not-a-menu"])
def test_class_of_the_whole_article(name):
    page = f"<body>{MENU}<div class='{name}'>{ART}</div><div class='site-footer'>{SIDE}</div></body>"
    assert main_text(page).split("\n") == TEXT


@pytest.mark.parametrize("name", ["sidebar", "site-sidebar", "sidebar-left", "x ad", "related-posts", "comment-list", "newsletter_box", "cookie-consent", "widget2", "share-buttons"])
def test_side_parts_go(name):
    page = f"<body>{MENU}<div class='main-column'>{ART}</div><div class='{name}'>{SIDE * 2}</div></body>"
    assert main_text(page).split("\n") == TEXT
    page = f"<body><div id='{name.split()[-1]}'>{SIDE * 2}</div><div>{ART}</div></body>"
    assert main_text(page).split("\n") == TEXT


def test_long_comments_are_not_the_article():
    page = f"<body><article>{ART}</article><section class='comments'>{SIDE * 60}</section></body>"
    assert main_text(page).split("\n") == TEXT


def test_link_paragraph_inside_the_article_stays():
    page = f"<body><article>{ART}<p><a href='/y'>This paragraph is a link from end to end</a></p>{ART}</article></body>"
    assert main_text(page).split("\n") == [*TEXT, "This paragraph is a link from end to end", *TEXT]
    # but not links before the first or after the last line of text
    assert main_text(f"<body>{MENU}<div>{ART}</div>{MENU}</body>").split("\n") == TEXT


def test_short_end_after_links_belongs_to_the_article():
    links = "<p><a href='/z'>more</a></p>" * 4
    assert main_text(f"<body><article>{ART}{links}<p>The end.</p></article><p>Elsewhere.</p></body>").split("\n") == [*TEXT, "The end."]
    assert main_text(f"<body><div>{ART}</div>{links}<p>Elsewhere.</p></body>").split("\n") == TEXT


def test_nested_and_open_elements_end():
    assert main_text("<div class='related'>" * 300 + ART).split("\n") == TEXT
    assert main_text("<div class='sidebar'>" + SIDE + "<article>" + ART).split("\n") == TEXT
    assert main_text("") == "" and main_text("<nav>" + SIDE) == ""
