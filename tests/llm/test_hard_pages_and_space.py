"""Runs of white space beyond what the pattern's engine can do; pages with odd attributes, comments, forms and asides."""

import time

import numpy as np
import pytest

from statuta.llm import html_crf, training_order
from statuta.llm.token_counts import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.tiktoken")


def test_runs_of_white_space_equal_the_library():
    ids, library = training_order.ids_of(PATH), training_order.encoding(PATH).encode_ordinary
    for space in (" ", "\n", "\t", " \n", "\n ", "\r\n\t ", "\xa0", " 　"):
        for text in ("%s", "%sx", "x%s", "x%sy", "a %s'sz", "1%s2%s!", "%s.%s", "é%sé "):
            text = text.replace("%s", (space * 40_000)[:40_000])
            assert ids(text) == library(text)
    assert ids("") == [] and ids("a  b") == library("a  b")


@pytest.mark.parametrize("space", [" ", "\n", "\t", " \n\t"])
def test_a_million_of_white_space_through_spark(spark, tmp_path, space):
    run = (space * 1_000_000)[:1_000_000]
    docs = spark.createDataFrame([(1, run), (2, f"a{run}b"), (3, f"{run}'s {run}")], "doc_id long, text string")
    index = training_order.materialise(docs, f"file://{tmp_path}/shards", PATH).collect()
    records = list(training_order.read(f"file://{tmp_path}/shards", 0, len(index)))
    of = {}
    for r in sorted(index, key=lambda r: (r.doc_id, r.seq)):
        of.setdefault(r.doc_id, []).extend(records[r.slot][: r.n_tokens].tolist())
    for i, text in docs.collect():
        assert of[i][-1] == training_order.END
        assert training_order.encoding(PATH).decode(of[i][:-1]) == text


ONE = "The council met on Tuesday to discuss the new bridge, and after four hours of debate it agreed to fund the first stage."
TWO = "Work will begin in spring, said the engineer in charge, provided that the river stays low enough for the piles to be driven."
THREE = "Residents had asked for a footpath on the eastern side; the plans now include one, with lamps every twenty metres."


@pytest.fixture(scope="module")
def crf():
    return html_crf.fit(html_crf.labelled_pages())


@pytest.mark.parametrize(
    "odd",
    [
        '<div data-gold="yes">{}</div>',
        "<div data-gold>{}</div>",
        "<div data-gold='1' data-gold=0.5>{}</div>",
        "<!-->{}",
        "<!--->{}",
        "<!-- a --!>{}<!-- b -->",
        "<!-- <p>gone</p> -->{}<!---->",
        "{}<form><p>Leave your mail</p><label>Mail</label><textarea>some words</textarea> <button>Send it</button></form>",
        "{}<form action=/x>Leave your mail <input name=mail><button>Subscribe</button></form>",
        "{}<aside><h3>Read also</h3><ul><li><a href=/a>The old bridge</a></li><li><a href=/b>The ferry</a></li></ul></aside>",
        "{}<aside><p>Our reporters have followed the river for years. Find their stories here.</p></aside>",
    ],
)
def test_articles_with_odd_markup(crf, odd):
    page = f"<html><body><nav><a href=/>Home</a></nav><article><h1>A new bridge</h1><p>{ONE}</p>{odd.replace('{}', f'<p>{TWO}</p>')}<p>{THREE}</p></article></body></html>"
    assert html_crf.main_text(page, crf) == " ".join(["A new bridge", ONE, TWO, THREE])


def test_labels_count_in_training_alone():
    page = '<div data-gold="1"><p>One</p></div><p data-gold="x">Two</p>'
    assert [b.gold for b in html_crf.parse(page).blocks] == [None, None]
    assert [b.gold for b in html_crf.parse(page, labelled=True).blocks] == [1, None]


@pytest.mark.parametrize("page", ["<b>x" * 40_000 + "</i>" * 40_000, "<address>" * 40_000, "<b>x<br>" * 40_000, "<div>" * 30_000 + "x" + "</div>" * 30_000])
def test_deep_and_unclosed_tags_take_linear_time(page):
    began = time.time()
    html_crf.parse(page)
    assert time.time() - began < 5


def test_repeated_and_no_pages(spark, crf):
    page = f"<article><p>{ONE}</p><p>{TWO}</p></article>"
    df = spark.createDataFrame([(1, "u", page, "a"), (1, "u", page, "a"), (2, None, None, None)], "page_id long, url string, html string, _text string")
    got = html_crf.extract(df, crf)
    assert sorted(r._n_chars for r in got.collect()) == [0, len(ONE) + len(TWO) + 1, len(ONE) + len(TWO) + 1]
    assert html_crf.extract(df.limit(0), crf).count() == 0
    assert np.isfinite(list(crf.values())).all()
