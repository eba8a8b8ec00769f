"""Main text of the given pages against a plain extraction, and of hand-written pages in layouts of other kinds."""

from html.parser import HTMLParser

import pytest

from statuta.llm import html_crf

INLINE = {"a", "b", "code", "em", "i", "span", "strong"}


class Article(HTMLParser):
    """The text of the article elements, blocks apart."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.inside, self.hidden = [], 0, 0

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.hidden += tag in ("script", "style")
        self.out += [" "] if tag not in INLINE else []

    def handle_endtag(self, tag):
        self.out += [" "] if tag not in INLINE else []
        self.inside -= tag == "article"
        self.hidden -= tag in ("script", "style")

    def handle_data(self, data):
        if self.inside and not self.hidden:
            self.out.append(data)


@pytest.fixture(scope="module")
def crf():
    return html_crf.fit(html_crf.labelled_pages())


def test_given_pages(spark, crf):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html").collect()
    right = 0
    for r in rows:
        plain = Article()
        plain.feed(r.html)
        plain.close()
        right += html_crf.main_text(r.html, crf) == " ".join("".join(plain.out).split())
    assert right == len(rows)


ONE = "The council met on Tuesday to discuss the new bridge, and after four hours of debate it agreed to fund the first stage."
TWO = "Work will begin in spring, said the engineer in charge, provided that the river stays low enough for the piles to be driven."
THREE = "Residents had asked for a footpath on the eastern side; the plans now include one, with lamps every twenty metres."
#: (page, what its article holds)
PAGES = {
    "plain": (f"<html><body><h1>A new bridge</h1><p>{ONE}</p><p>{TWO}</p><p>{THREE}</p></body></html>", ["A new bridge", ONE, TWO, THREE]),
    "table": (f"<table><tr><td><a href=/a>Home</a> <a href=/b>Sport</a> <a href=/c>Weather</a></td></tr><tr><td><h2>A new bridge</h2><p>{ONE}</p><p>{TWO}</p><p>{THREE}</p></td></tr><tr><td><font size=1>Copyright 1999 The Courier</font></td></tr></table>", ["A new bridge", ONE, TWO, THREE]),
    "blog": (f'<body class="home blog"><div id="masthead"><ul class="menu"><li><a href="/">Home</a></li><li><a href="/about">About</a></li></ul></div><div id="primary"><main id="main"><div class="post-117 post hentry"><h1 class="entry-title">A new bridge</h1><div class="entry-content"><p>{ONE}</p><blockquote><p>{TWO}</p></blockquote><p>{THREE}</p></div></div></main></div><aside class="widget-area"><h3>Recent posts</h3><ul><li><a href="/1">Older thing</a></li><li><a href="/2">Other thing</a></li></ul></aside><footer><p>Powered by something</p></footer></body>', ["A new bridge", ONE, TWO, THREE]),
    "comments": (f"<main><article><h1>A new bridge</h1><p>{ONE}</p><p>{TWO}</p><p>{THREE}</p></article><section id=comments class=comments><h2>Comments</h2><div class=comment><p>I don't believe a word of this, they said the same ten years ago.</p></div><form><label>Your comment</label><textarea></textarea><button>Send</button></form></section></main>", ["A new bridge", ONE, TWO, THREE]),
    "banner": (f'<div class="cookie-banner"><p>We use cookies to improve this site. <a href="/p">Read our policy</a></p><button>Accept</button></div><header><a href="/">The Courier</a></header><div class="content"><h1>A new bridge</h1><p>{ONE}</p><p>{TWO}</p><p>{THREE}</p></div><footer>&copy; 2020 The Courier | <a href="/t">Terms</a></footer>', ["A new bridge", ONE, TWO, THREE]),
    "list": (f"<nav><a href=/>Home</a><a href=/x>News</a></nav><article><h1>A new bridge</h1><p>{ONE}</p><ul><li>{TWO}</li><li>{THREE}</li></ul></article><div class=newsletter><p>Sign up for our newsletter</p><form><input name=mail><button>Subscribe</button></form></div>", ["A new bridge", ONE, TWO, THREE]),
}


@pytest.mark.parametrize("name", PAGES)
def test_other_layouts(crf, name):
    page, blocks = PAGES[name]
    assert html_crf.main_text(page, crf) == " ".join(blocks)


def test_very_long_page(crf):
    prose = "".join(f"<p>{ONE} {k}</p>" for k in range(20_000))
    got = html_crf.main_text(f"<nav><a href=/>Home</a></nav><article>{prose}</article><footer>&copy; us</footer>", crf)
    assert got == " ".join(f"{ONE} {k}" for k in range(20_000))


def test_ties_go_to_the_plainer_label(crf):
    """Weights that say nothing: the path is still one of the labels, for every block."""
    page = html_crf.parse(f"<p>{ONE}</p><p>{TWO}</p>")
    labels = html_crf.viterbi([0.0] * len(page.blocks), {"0>0": 0.0, "0>1": 0.0, "1>0": 0.0, "1>1": 0.0})
    assert len(labels) == 2 and set(labels) <= {0, 1} and labels == html_crf.viterbi([0.0] * 2, {"0>0": 0.0, "0>1": 0.0, "1>0": 0.0, "1>1": 0.0})
