"""Articles in wrappers whose names say nothing, or anything, with comments behind them.

Not found yet, and said so in the README: a single paragraph without heading in wrappers without names.
"""

from __future__ import annotations

import pytest

from terrafield.llm import html_text

LONG = "The river rose in the night and by morning the lower road was under water, so the farmers brought their animals up to the chapel hill."
AGAIN = "Nobody was hurt, and on the third day the water had gone back so far that the mill could be reached on foot again from the village."


@pytest.fixture(scope="module")
def field():
    return html_text.fit(html_text.labelled_pages())


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<nav><a href=/>Home</a> <a href=/b>Blog</a></nav><div class=post><p>{LONG}</p><aside><p>Related: ten bridges</p></aside><p>{AGAIN}</p></div><div class=comments><h3>Comments</h3><div class=comment><p>Great story, thanks for sharing it with us.</p></div></div>", f"{LONG}\n{AGAIN}"),
        (f"<div class='adventure'><p>{LONG}</p><p>{AGAIN}</p></div><div id='footer'><p>Copyright 2020 Example</p></div>", f"{LONG}\n{AGAIN}"),
        (f"<div><h1>Flood</h1><p>{LONG}</p></div><div class=sidebar><a href=/x>More</a></div>", f"Flood\n{LONG}"),
        (f"<div class='menu'><a href=/>Home</a></div><div id='lantern'><h2>Flood</h2><p>{LONG}</p><p>{AGAIN}</p></div><div id='comments'><div class='comment'><p>I saw it too, from the bridge.</p></div></div>", f"Flood\n{LONG}\n{AGAIN}"),
    ],
)
def test_articles_in_any_wrapper(field, page, text):
    assert field.main_text(f"<html><body>{page}</body></html>") == text
