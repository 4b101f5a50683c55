"""Layout wrappers whose class, id or form looks like boilerplate."""

import pytest

from triagelake.llm import pages

BODY = "<h1>On rivers</h1><p>A river is a stream of water that flows over land to a sea, a lake or another river.</p><p>Most rivers rise in hills, where rain and melting snow gather.</p>"
TEXT = "On rivers A river is a stream of water that flows over land to a sea, a lake or another river. Most rivers rise in hills, where rain and melting snow gather."
SIDE = "<div class='sidebar'><a href=a>One</a><a href=b>Two</a></div>"


@pytest.mark.parametrize("wrapper", [
    "<div class='layout has-sidebar'>{0}{1}</div>", "<div id='content' class='with-header'>{0}</div>", "<div class='search-page'><div>{0}</div>{1}</div>",
    "<form id='aspnetForm' action='.'><div class='page'>{0}</div>{1}</form>", "<div class='promo-layout'><main>{0}</main></div>", "<form role='form'>{0}</form>",
    "<section class='nav-open'><div class='cookie-accepted'><article>{0}</article>{1}</div></section>",
])
def test_wrappers_keep_the_text(wrapper):
    assert pages.main_text(f"<html><body><nav><a href=x>Menu</a></nav>{wrapper.format(BODY, SIDE)}<footer>me</footer></body></html>") == TEXT


@pytest.mark.parametrize("part", [SIDE, "<form><input>Search the site</form>", "<div class='newsletter'><p>Get our letter each week.</p></div>", "<div class='related'><article>Lakes</article></div>"])
def test_small_hinted_parts_stay_out(part):
    assert pages.main_text(f"<body><article>{BODY}{'' if 'article' in part else part}</article>{part}</body>") == TEXT
    if "article" not in part:
        assert pages.main_text(f"<body><div>{BODY}{part}</div></body>") == TEXT


def test_a_long_ad_beside_a_short_article_stays_out():
    ad = "<div class='ad'>Buy our boats, they are long and they are cheap and they float.</div>"
    assert pages.main_text(f"<body>{ad}<article><h1>Boats sink.</h1><p><b>Two boats sank.</b><br></p></article></body>") == "Boats sink. Two boats sank."


COMMENT = "<p>I live by such a river and I can tell you that the water is cold all year, even in a long and hot summer like the last one.</p>"


@pytest.mark.parametrize("part", [
    "<section aria-label='Comments'>{0}</section>", "<section aria-label='Reader comments'>{0}</section>", "<div data-component='comments'>{0}</div>",
    "<div itemprop='comment'>{0}</div>", "<h3>Comments</h3>{0}", "<div><h4>12 comments</h4><div>{0}</div></div>", "<h2>Reader comments (2)</h2><h3>Ann</h3>{0}",
])
def test_reader_comments_stay_out(part):
    assert pages.main_text(f"<body><article>{BODY}{part.format(COMMENT)}</article></body>") == TEXT


def test_text_behind_the_comments_and_prose_labels_stay():
    more = "<h2>Lakes</h2><p>A lake is a body of water that is larger and deeper than a pond.</p>"
    assert pages.main_text(f"<article>{BODY}<h2>Comments</h2>{COMMENT}{more}</article>") == f"{TEXT} Lakes A lake is a body of water that is larger and deeper than a pond."
    assert pages.main_text(f"<article>{BODY}<section aria-label='How rivers form and share their water'>{more}</section></article>").endswith("than a pond.")
    assert pages.main_text(f"<article><h1>Comments</h1>{COMMENT}</article>").startswith("Comments I live")


def test_deep_pages_take_linear_time():
    from time import process_time

    began = process_time()
    for piece in ("<div class='nav'>a", "<div><p>a<span>", "<section>a<b>", "<article id='comments'>a"):
        pages.main_text(piece * 100_000)
    assert process_time() - began < 60
    pages.main_text("<b>" * 100_000 + "</i>" * 100_000 + "</b>" * 100_000)
