"""Text beside the best container, on pages without <article>."""

import pytest

from fleetlens.llm.html_extract import main_text

LONG = "Rain fell on the hills, the river rose, and the road was closed for the whole day. " * 6
WANT = " ".join(LONG.split())


@pytest.mark.parametrize(
    "beside, text",
    [
        (f"<section><p>{LONG}</p></section>", WANT),
        ("<h1>A title</h1>", "A title"),
        ("<ul><li>one</li><li>two</li></ul>", "one two"),
        ("<table><tr><td>cell</td></tr></table>", "cell"),
        ("<pre>code</pre>", "code"),
        ("<blockquote>said</blockquote>", "said"),
        ("loose text", "loose text"),
    ],
)
def test_what_stands_beside_stays(beside, text):
    box = f"<div><p>{LONG}</p></div>"
    assert main_text(f"<body>{box}{beside}</body>") == f"{WANT} {text}"
    assert main_text(f"<body>{beside}<div>{box}</div></body>") == f"{text} {WANT}"
    assert main_text(f"<body><main>{box}{beside}</main></body>") == f"{WANT} {text}"


def test_link_lists_stay_in_the_article_only():
    links = "<ul><li><a href=x>first source</a></li><li><a href=y>second source</a></li></ul>"
    assert main_text(f"<body>{links}<div><p>{LONG}</p><h2>References</h2>{links}</div>{links}</body>") == f"{WANT} References first source second source"
    assert main_text(f"<body>{links}<p>{LONG}</p><p>{LONG}</p></body>") == f"{WANT} {WANT}"


STORY = "".join(f"<p>Sentence {i} of the story, with a comma and some more words.</p>" for i in range(20))
STORY_TEXT = " ".join(f"Sentence {i} of the story, with a comma and some more words." for i in range(20))
MENU = "<ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul>"


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<div id=widget-main>{STORY}</div><div><p>Short other.</p></div>", f"{STORY_TEXT} Short other."),
        (f"<div class=widget>{STORY}</div>", STORY_TEXT),
        (f"<div class=related-work>{STORY}</div>", STORY_TEXT),
        (f"<div class=content>{STORY}<p class=share-price>The price, at last, rose.</p></div>", f"{STORY_TEXT} The price, at last, rose."),
        (f"<div class=content>{STORY}</div><div class=post-comments><p>I think, as a reader, this is fine.</p></div>", STORY_TEXT),
        (f"<div class=content><p>One, two, three and more.</p></div><div class='box comments'>{STORY}</div>", "One, two, three and more."),
        (f"<div class=content>{STORY}</div><div class=related-posts><p>Read this, and that, too.</p></div>", STORY_TEXT),
        (f"<div class='ad-free top'>{MENU}</div><div class=story>{STORY}</div>", STORY_TEXT),
        (f"<div class=sidebar-content><p>About us, our people, our work.</p></div><div class=story>{STORY}</div><div id=siteFooter><p>All rights reserved, 2020.</p></div>", STORY_TEXT),
    ],
)
def test_names_alone_do_not_remove_articles(page, want):
    assert main_text(f"<html><body>{MENU}{page}</body></html>") == want
