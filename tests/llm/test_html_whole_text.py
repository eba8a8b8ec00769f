"""Valid pages whose text was lost: heads without an end tag, self-closed foreign elements."""

import pytest

from statuta.llm import html_crf

ARTICLE = "<article><h1>Some title</h1><p>First line, of some text here.</p><p>Second one, with more words in it.</p></article>"
TEXT = ["Some title", "First line, of some text here.", "Second one, with more words in it."]
HEADS = [
    "<html><head><title>T</title><body>",
    "<html><head><meta charset=utf-8><title>T</title><style>p{}</style><link rel=x href=y><script>x</script>",
    "<head><title>T</title><noscript><link href=x></noscript><main>",
    "<head><head><title>T</title><body>",
    "<html><head><title>T</title></head><body><div><head>",
]


def texts(source):
    return [b.text for b in html_crf.parse(source).blocks]


@pytest.mark.parametrize("head", HEADS)
def test_heads_end_without_an_end_tag(head):
    assert texts(f"{head}{ARTICLE}</html>") == TEXT
    assert texts(f"{head}bare text <b>here</b></html>") == ["bare text here"]
    assert texts(f"{head}bare text") == ["bare text"]


def test_what_stands_in_a_head_stays_hidden():
    assert texts(f"<html><head> \n<title>T</title> <script>x</script> <style>y</style>\n</head> <body>{ARTICLE}</body></html>") == TEXT


@pytest.mark.parametrize("empty", ["<svg/>", "<svg />", "<SVG class='a>b' id=x />", '<math title="a=b"/>', '<svg viewBox="0 0 1 1" hidden/>', "<svg-icon></svg-icon>"])
def test_self_closed_foreign_elements_hold_nothing(empty):
    assert texts(f"<body>{empty}{ARTICLE}") == TEXT
    assert texts(f"<body>{empty}{ARTICLE}<svg><text>z</text></svg><p>end</p>") == [*TEXT, "end"]


def test_a_slash_in_a_value_does_not_close():
    assert texts(f"<body><svg xmlns=http://x/><text>z</text></svg>{ARTICLE}") == TEXT


def test_article_of_a_minified_page():
    model = html_crf.fit(html_crf.labelled_pages(100))
    body = f"<nav><a href=1>home</a></nav><svg/>{ARTICLE}<footer>&copy; us</footer>"
    whole = html_crf.main_text(f"<html><head><title>T</title></head><body>{body}</body></html>", model)
    assert whole == " ".join(TEXT)
    assert html_crf.main_text(f"<html><head><title>T</title><body>{body}</html>", model) == whole
