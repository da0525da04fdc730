"""Articles in layouts whose names or tags sound like boilerplate: generated pages with a known text."""

import random

import pytest

from fleetlens.llm.html_extract import main_text

SENTENCES = [f"Paragraph number {i} tells, at some length, what happened in the town that day." for i in range(8)]
STORY = "".join(f"<p>{s}</p>" for s in SENTENCES)
WANT = " ".join(SENTENCES)
BOX = '<div class="elementor-widget elementor-widget-text-editor"><div class="elementor-widget-container">{}</div></div>'
BOXES = "".join(BOX.format(f"<p>{s}</p>") for s in SENTENCES)
MENU = "<nav><a href=a>Home</a> <a href=b>News</a></nav><ul class=menu><li><a href=c>One</a></li><li><a href=d>Two</a></li></ul>"
SIDE = "<div class=sidebar><p>Subscribe to our letter, it is free, and good.</p></div><div id=comments><p>Nice, I like it, a lot.</p></div>"
FORM = "<form><label>Your name, please</label><input name=n><button>Send</button></form>"
LAYOUTS = [
    f"<main>{BOX.format(STORY)}</main>", f"<main>{BOXES}</main>", BOXES, BOX.format(STORY), f"<article><div id=story-menu>{STORY}</div></article>",
    f"<main><section class=legal-notice>{STORY}</section></main>", f"<form id=aspnetForm><input type=hidden><div>{STORY}</div></form>", f"<form id=aspnetForm><div>{STORY}</div></form>",
    f"<article><fieldset>{STORY}</fieldset></article>", f"<article><fieldset><legend></legend><input>{STORY}</fieldset></article>", f"<main><div class=post>{STORY}</div>{FORM}</main>",
    f"<main><div class=post>{STORY}</div><div class=related><p>Read this, too.</p></div></main>", f"<div class=post>{STORY}</div>{FORM}",
]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_known_text(layout):
    for page in (layout, f"{MENU}{layout}{SIDE}", f"<html><body>{MENU}<div id=wrap>{layout}</div>{SIDE}<footer>All rights, reserved.</footer></body></html>"):
        assert main_text(page) == WANT


def test_wrappers_of_any_name_keep_the_article():
    rng = random.Random(4)
    words = "menu widget notice banner promo header related social alert content body text block".split()
    for _ in range(200):
        inner = STORY if rng.random() < 0.5 else "".join(f"<div class={rng.choice(words)}-item>{'<p>' + s + '</p>'}</div>" for s in SENTENCES)
        for _ in range(rng.randrange(1, 4)):
            inner = f'<{(tag := rng.choice(["div", "section"]))} class="{rng.choice(words)} {rng.choice(words)}-{rng.choice(words)}">{inner}</{tag}>'
        outer = rng.choice(["article", "main"])
        text = main_text(f"<body>{MENU}<{outer}>{inner}</{outer}>{SIDE}</body>")
        # One word over the halves of the story keeps it; only boxes of several words, each a small part, may go.
        assert text == WANT if STORY in inner else set(text) <= set(WANT + " ")


def test_empty_forms_and_dialogs_go():
    assert main_text(f"<main>{STORY}<dialog><p>We use cookies, accept them.</p></dialog><fieldset><select><option>One</option></select> pick, please</fieldset></main>") == WANT
