"""Pages whose article is known by construction, names of classes, and hostile markup."""

from __future__ import annotations

import random
import time

import pytest

from millrace.llm import html

FURNITURE = [
    "<nav><ul><li>Home<li>News</ul></nav>",
    "<div class='ad-slot'><p>Buy now, buy more, buy today</p></div>",
    "<aside><h3>More</h3><p>Elsewhere on this site</p></aside>",
    "<form><label>Mail</label><input><button>Send</button></form>",
    "<script>if (a < b) { c = '<p>no</p>'; }</script>",
    "<style>p > b { color: red }</style>",
    "<div id='cookie-banner'>We use cookies</div>",
    "<section class='comments'><div class='comment'><p>First!</p></div></section>",
    "<!-- <p>hidden</p> -->",
    "<div role='navigation'>1 2 3</div>",
]


def built(rng: random.Random) -> tuple[str, str]:
    """A page and the text of its article."""
    blocks, text = [], []
    for _ in range(rng.randint(1, 12)):
        said = " ".join("".join(rng.choice("abcdeéß中") for _ in range(rng.randint(1, 9))) for _ in range(rng.choice([1, 5, 60])))
        text.append(f"{said} & < {said}")
        inner = f"{said}\n  &amp; &lt; <b>{said}</b>"
        kind = rng.choice(["p", "h2", "li", "div", "section class='related-work'", "div class='alert-level'", "blockquote", "div id='share-of-votes'"])
        blocks.append(f"<{kind}>{inner}</{kind.split()[0]}>")
    page = []
    for block in blocks:
        page += [rng.choice(FURNITURE)] * rng.randint(0, 1) + [block]
    around = [rng.choice(FURNITURE) for _ in range(6)]
    tag = rng.choice(["article", "main"])
    wrap = rng.choice(["<div>{}</div>", "<div class='layout with-sidebar'>{}</div>", "<div id='page-header-wide'>{}</div>", "{}"])
    article = f"<{tag}>{''.join(page)}</{tag}>"
    return f"<html><body>{''.join(around[:3])}{wrap.format(article)}{''.join(around[3:])}<footer>End</footer></body></html>", " ".join(text)


def test_built_pages():
    rng = random.Random(8)
    for _ in range(400):
        page, text = built(rng)
        assert html.main_text(page) == text


@pytest.mark.parametrize(
    "page,text",
    [
        ("<article><p>a</p><div class='related'>x</div><div class='share-box'>y</div><p>b</p></article>", "a b"),
        ("<article><section class='related-work'><p>a</p></section><div class='alert-level'>b</div></article>", "a b"),
        ("<div class='has-sidebar'><article><p>a</p></article><p>beside</p></div>", "a"),
        ("<article><p>a</p></article><div class='sidebar'><article><p>teaser</p></article></div>", "a"),
        ("<article><p>a &lt; b</p><p>c < d <!-- never closed <p>e</p></article>", "a < b c < d"),
        ("<article><p>a</p><p>b <a href='x>never closed</p></article>", "a b"),
        ("<article><p>a</p><p>b <", "a b <"),
        ("<article><p>a</p><![CDATA[ x <p>b", "a"),
    ],
)
def test_names_and_open_ends(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("unit", ["<!--", "<a ", '<a b="', "<a b ", "</a ", "<!", "<?", "<![CDATA[", "<div>", "<p><b>x", "</b>", "<", "&#", "<script>", "<a/ "])
def test_hostile_pages_take_linear_time(unit):
    begin = time.perf_counter()
    assert html.main_text("<article><p>Text of the article.</p>" + unit * 100_000).startswith("Text of the article.")
    assert time.perf_counter() - begin < 10
