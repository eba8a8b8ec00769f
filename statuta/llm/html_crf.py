"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: stretches of text between block-level tags.
Each block is described by its ancestors (tag names, words of class, id and
role attributes, whether they stand inside an article) and by its text
(length, links, punctuation). Labels are article or not; neighbouring labels
are tied by transition weights; the best sequence is found by Viterbi.

The model is fitted by gradient ascent on labelled pages, in which
``data-gold`` attributes mark what is article text. ``labelled_pages`` writes
such pages in varied layouts from a seed; own ones can be given instead.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship

TRAINING_PAGES = 500
SEED = 31
STEPS, RATE, DECAY = 250, 0.15, 1e-3

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
#: A tag that opens closes an open one of these, unless one of the fences stands between.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}} | {t: {"p"} for t in "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split()}
_FENCES = frozenset("ul ol dl table article section div aside main nav header footer form body html blockquote figure select".split())
_NO_TEXT = frozenset("script style template svg math head title object iframe canvas noframes".split())
#: Any other start tag closes an open head, as text does.
_IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
_TOKEN = re.compile(
    # an empty comment may end at once, any at --!> too
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    # self-closed, which it isn't where the slash ends a value without quotes
    r"|<(?:svg|math)(?=[\s/])(?:\s++|/(?!>)|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*+))?+)*+/>"
    r"|<(?P<raw>script|style|template|svg|title|iframe|noframes|object|canvas|math|textarea)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(class|id|role|aria-label|data-gold)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    node: int
    text: str
    linked: int
    gold: int | None = None


@dataclass
class Page:
    #: Of every element: its parent's number and its own features.
    parents: list[int] = field(default_factory=lambda: [-1])
    features: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    blocks: list[Block] = field(default_factory=list)


_attrs_seen: dict[str, tuple[tuple[str, ...], str | None]] = {}


def _of_attributes(attrs: str) -> tuple[tuple[str, ...], str | None]:
    if attrs in _attrs_seen:
        return _attrs_seen[attrs]
    names, gold = [], None
    for kind, a, b, c in _NAMES.findall(attrs):
        if kind.lower() == "data-gold":
            gold = a or b or c
        else:
            names += ["." + w.lower() for w in _WORD.findall(a or b or c)]
    if len(_attrs_seen) > 20_000:
        _attrs_seen.clear()
    found = _attrs_seen[attrs] = (tuple(dict.fromkeys(names)), gold)
    return found


def parse(source: str | None, labelled: bool = False) -> Page:
    """The page's leaf blocks in page order, white space and character references resolved. labelled: data-gold is read where it is 0 or 1."""
    page = Page()
    source = source or ""
    # tag, node, whether in an article, label, node of the nearest element that isn't inline
    stack: list[tuple[str, int, bool, int | None, int]] = [("", 0, False, None, 0)]
    opened: Counter = Counter()  # elements on the stack, by tag
    text: list[str] = []
    linked = at = in_link = 0

    def close() -> None:
        nonlocal linked
        if text:
            t = " ".join("".join(text).split())
            if t:
                page.blocks.append(Block(stack[-1][4], t, min(linked, len(t)), stack[-1][3]))
            text.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            if "&" in piece:
                piece = entities.unescape(piece)
            text.append(piece)
            if in_link:
                linked += len(piece)

    hidden = 0

    def close_head() -> None:
        nonlocal hidden
        k = next(k for k, s in enumerate(stack) if s[0] == "head")
        hidden -= sum(s[0] in _NO_TEXT for s in stack[k:])
        opened.subtract(s[0] for s in stack[k:])
        del stack[k:]

    for m in _TOKEN.finditer(source):
        if m.start() > at:
            if hidden and not source[at : m.start()].isspace():
                close_head()
            if not hidden:
                add(source[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            if tag == "br":
                close()
            elif opened[tag] > 0:
                if tag not in _INLINE:
                    close()
                top = ""
                while top != tag:
                    top = stack.pop()[0]
                    opened[top] -= 1
                    in_link -= top == "a"
                    hidden -= top in _NO_TEXT
            continue
        if hidden and tag not in _IN_HEAD:
            close_head()
        if tag not in _INLINE:
            close()
        if tag in _VOID:
            continue
        shut = _CLOSES.get(tag)
        if shut and any(opened[x] > 0 for x in shut):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in shut:
                    for name, *_ in stack[k:]:
                        in_link -= name == "a"
                        opened[name] -= 1
                    del stack[k:]
                    break
                if stack[k][0] in _FENCES:
                    break
        names, gold = _of_attributes(m["attrs"]) if m["attrs"] else ((), None)
        gold = int(gold) if labelled and gold in ("0", "1") else None
        _, up, inside, above, holder = stack[-1]
        if tag in _INLINE and not names:
            node = up
        else:
            node = len(page.parents)
            page.parents.append(up)
            page.features.append((tag + "@a" if inside else tag, *names))
        if m["attrs"].endswith("/") and tag in _NO_TEXT:
            continue
        in_link += tag == "a"
        hidden += tag in _NO_TEXT
        opened[tag] += 1
        stack.append((tag, node, inside or tag in ("article", "main"), above if gold is None else gold, holder if tag in _INLINE else node))
    if hidden and source[at:].strip():
        close_head()
    if not hidden:
        add(source[at:])
    close()
    return page


def text_features(b: Block) -> list[str]:
    t, n = b.text, len(b.text)
    words = t.count(" ") + 1
    out = ["words<3" if words < 3 else "words<8" if words < 8 else "words<20" if words < 20 else "words<60" if words < 60 else "words60+"]
    share = b.linked / n
    out.append("links0" if share == 0 else "links<.3" if share < 0.3 else "links<.8" if share < 0.8 else "links.8+")
    out.append("ends" if t[-1] in ".!?…:;\"”»" else "open")
    if "," in t:
        out.append("comma")
    if ". " in t:
        out.append("sentences")
    if "©" in t or t[:9].lower() == "copyright":
        out.append("copyright")
    if "|" in t or "»" in t or "·" in t:
        out.append("separators")
    return out


Model = dict[str, float]


def emissions(page: Page, model: Model) -> list[float]:
    """Weight of the label article less that of the other, for every block."""
    of_node = []
    get = model.get
    for up, feats in zip(page.parents, page.features, strict=True):
        s = of_node[up] if up >= 0 else 0.0
        for f in feats:
            s += get(f, 0.0)
        of_node.append(s)
    bias = model["bias"]
    out = []
    for k, b in enumerate(page.blocks):
        s = of_node[b.node] + bias + (model["first"] if k == 0 else 0.0)
        for f in text_features(b):
            s += get(f, 0.0)
        out.append(s)
    return out


def viterbi(e: list[float], model: Model) -> list[int]:
    """The best label sequence; ties go to not article."""
    stay0, stay1, go01, go10 = model["0>0"], model["1>1"], model["0>1"], model["1>0"]
    if not e:
        return []
    zero, one, back = 0.0, e[0], []
    for x in e[1:]:
        to0, to1 = (zero + stay0, 0) if zero + stay0 >= one + go10 else (one + go10, 1), (zero + go01, 0) if zero + go01 >= one + stay1 else (one + stay1, 1)
        back.append((to0[1], to1[1]))
        zero, one = to0[0], to1[0] + x
    label = int(one > zero)
    out = [label]
    for b in reversed(back):
        label = b[label]
        out.append(label)
    return out[::-1]


def main_text(source: str | None, model: Model) -> str:
    page = parse(source)
    labels = viterbi(emissions(page, model), model)
    return " ".join(b.text for b, y in zip(page.blocks, labels, strict=True) if y)


def fit(pages: list[str], steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> Model:
    """Maximum conditional likelihood (forward-backward over all pages together), Adam, quadratic penalty."""
    names: dict[str, int] = {}
    rows, cols, gold, first, lengths = [], [], [], [], []
    for source in pages:
        page = parse(source, labelled=True)
        if not page.blocks:
            continue
        lengths.append(len(page.blocks))
        for k, b in enumerate(page.blocks):
            feats, node = text_features(b) + ["bias"] + ["first"] * (k == 0), b.node
            while node >= 0:
                feats += page.features[node]
                node = page.parents[node]
            for f in feats:
                rows.append(len(gold))
                cols.append(names.setdefault(f, len(names)))
            gold.append(b.gold or 0)
    n, longest = len(lengths), max(lengths)
    x = np.zeros((len(gold), len(names)))
    np.add.at(x, (rows, cols), 1.0)
    place = np.full((n, longest), -1)
    for i, (s, k) in enumerate(zip(np.cumsum(lengths) - lengths, lengths, strict=True)):
        place[i, :k] = np.arange(s, s + k)
    real = place >= 0
    y = np.where(real, np.array(gold)[place], 0)
    pairs = real[:, 1:]
    observed = np.zeros((2, 2))
    np.add.at(observed, (y[:, :-1][pairs], y[:, 1:][pairs]), 1)
    w, t = np.zeros(len(names)), np.zeros((2, 2))
    m1, m2, t1, t2 = np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)
    for step in range(1, steps + 1):
        e = np.zeros((n, longest, 2))
        e[:, :, 1] = np.where(real, (x @ w)[place], 0)
        alpha, beta = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        alpha[:, 0] = e[:, 0]
        for k in range(1, longest):
            alpha[:, k] = np.where(real[:, k, None], np.logaddexp(alpha[:, k - 1, :1] + t[0], alpha[:, k - 1, 1:] + t[1]) + e[:, k], alpha[:, k - 1])
        for k in range(longest - 2, -1, -1):
            nxt = beta[:, k + 1] + e[:, k + 1]
            b = np.stack([np.logaddexp(t[i, 0] + nxt[:, 0], t[i, 1] + nxt[:, 1]) for i in (0, 1)], 1)
            beta[:, k] = np.where(real[:, k + 1, None], b, beta[:, k + 1])
        z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        p = np.exp(alpha + beta - z[:, None, None])[:, :, 1]
        expected = np.array([[np.exp(alpha[:, :-1, i] + t[i, j] + e[:, 1:, j] + beta[:, 1:, j] - z[:, None])[pairs].sum() for j in (0, 1)] for i in (0, 1)])
        residual = np.zeros(len(gold))
        residual[place[real]] = (y - p)[real]
        gw, gt = x.T @ residual / n - decay * w, (observed - expected) / n - decay * t
        m1 += 0.1 * (gw - m1)
        m2 += 0.01 * (gw * gw - m2)
        t1 += 0.1 * (gt - t1)
        t2 += 0.01 * (gt * gt - t2)
        now = rate * (1 - step / (steps + 1))
        w += now * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
        t += now * (t1 / (1 - 0.9**step)) / (np.sqrt(t2 / (1 - 0.99**step)) + 1e-8)
    model = dict(zip(names, w.tolist(), strict=True))
    return {"bias": 0.0, "first": 0.0} | model | {f"{i}>{j}": float(t[i, j]) for i in (0, 1) for j in (0, 1)}


# -- labelled pages -----------------------------------------------------------------


def labelled_pages(count: int = TRAINING_PAGES, seed: int = SEED) -> list[str]:
    """Pages in varied layouts, article text marked data-gold="1"."""
    r = random.Random(seed)
    return [_page(r) for _ in range(count)]


def _page(r: random.Random) -> str:
    letters = "abcdefghijklmnopqrstuvwxyzéüñç"

    def word() -> str:
        return "".join(r.choice(letters) for _ in range(r.randint(1, 9)))

    def words(lo: int, hi: int) -> str:
        return " ".join(word() for _ in range(r.randint(lo, hi)))

    def sentence() -> str:
        parts = [words(1, 9) for _ in range(r.choice((1, 1, 2, 3)))]
        return ", ".join(parts).capitalize() + r.choice((".", ".", ".", "!", "?"))

    def prose(lo: int, hi: int) -> str:
        t = " ".join(sentence() for _ in range(r.randint(lo, hi)))
        if r.random() < 0.3:
            t += r.choice(("%%%", " &amp;&amp;", " ***", " <b>%s</b>", " <a href='/x'>%s</a>", " <em>%s</em>.")).replace("%s", words(1, 3))
        return t

    def attrs(names: list[str]) -> str:
        if r.random() < 0.2:
            return ""
        name = r.choice(names)
        more = r.choice(("", "", "-" + word(), "-wrapper", "_box", "-inner", "Block"))
        return f' {r.choice(("class", "class", "id"))}="{name}{more}"'

    def box(names: list[str], inner: str, tags: tuple[str, ...] = ("div",)) -> str:
        tag = r.choice(tags)
        a = attrs(names)
        if tag in ("div", "section") and not a:
            a = f' class="{r.choice(names)}"'
        return f"<{tag}{a}>{inner}</{tag}>"

    def links(lo: int, hi: int, sep: str | None = None) -> str:
        some = [f'<a href="/{word()}">{words(1, 4)}</a>' for _ in range(r.randint(lo, hi))]
        return sep.join(some) if sep else "<ul>" + "".join(f"<li>{x}</li>" for x in some) + "</ul>"

    def short() -> str:
        return r.choice((words(1, 4), sentence(), prose(1, 2)))

    def menu() -> str:
        return box(["menu", "nav", "navbar", "navigation", "main-menu", "topnav", "breadcrumb", "breadcrumbs"], r.choice((links(3, 9), links(2, 6, " | "), links(2, 6, " "), links(2, 5, " » "))), ("nav", "nav", "div", "ul"))

    def advert() -> str:
        return box(["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "banner"], r.choice((short(), f"<p>{prose(1, 3)}</p>", f'<a href="/{word()}">{short()}</a>')), ("div", "div", "aside", "section"))

    def notice() -> str:
        return box(["cookie", "cookies", "consent", "notice", "alert", "popup", "modal", "gdpr", "newsletter", "subscribe", "overlay", "warning", "paywall"], f"<p>{prose(1, 3)}</p>" + r.choice(("", f"<button>{words(1, 2)}</button>")), ("div", "div", "section", "aside"))

    def formular() -> str:
        fields = "".join(f"<label>{words(1, 3)}</label><input name='{word()}'>" for _ in range(r.randint(1, 3)))
        return box(["form", "search", "login", "signup", "subscribe", "contact"], f"<p>{short()}</p>{fields}<select><option>{word()}<option>{word()}</select><textarea>{word()}</textarea><button>{words(1, 2)}</button>", ("form",))

    def sidebar() -> str:
        return box(["sidebar", "related", "widget", "aside", "popular", "recommended", "trending", "share", "social", "tags", "toc", "pagination"], f"<h3>{words(1, 4)}</h3>" + r.choice((links(3, 8), f"<p>{prose(1, 3)}</p>", links(2, 4) + f"<p>{prose(1, 2)}</p>")), ("aside", "aside", "div", "section"))

    def comments() -> str:
        one = lambda: box(["comment", "reply", "comment-body", "response"], f"<span class='author'>{words(1, 2)}</span> <p>{prose(1, 4)}</p>", ("div", "li", "article"))
        return box(["comments", "comment-list", "responses", "discussion", "replies", "disqus"], f"<h3>{words(1, 3)}</h3>" + "".join(one() for _ in range(r.randint(1, 5))), ("section", "div", "ol"))

    def head() -> str:
        return box(["header", "masthead", "site-header", "top", "logo", "branding"], f"<a href='/'>{words(1, 3)}</a>" + r.choice(("", f"<p>{short()}</p>", f"<h2>{words(1, 4)}</h2>", menu())), ("header", "header", "div"))

    def foot() -> str:
        return box(["footer", "site-footer", "bottom", "copyright", "legal", "colophon"], r.choice((f"&copy; {word()}.example &middot; {short()}", f"<p>&copy; {words(2, 6)}</p>", f"<p>{prose(1, 2)}</p>" + links(2, 5), links(2, 6, " · "))), ("footer", "footer", "footer", "div"))

    def content() -> str:
        title = words(2, 9).capitalize()
        parts = [r.choice((f"<h1>{title}</h1>", f"<h1>{title}.</h1>", f"<header><h1>{title}</h1></header>", f"<p><b>{title}.<br>", f"<h1>{title}</h1><p><b>{title} {prose(1, 2)}<br>", ""))]
        for _ in range(r.randint(1, 9)):
            parts.append(r.choice([f"<p>{prose(1, 8)}</p>"] * 8 + [f"<p>{words(1, 3).capitalize()}.</p>", f"<p>{prose(1, 6)}", f"<p><b>{prose(1, 2)}<br><p>{prose(1, 5)}", f"<h2>{words(1, 6)}</h2>", f"<ul><li>{sentence()}</li><li>{prose(1, 2)}</li></ul>", f"<blockquote><p>{prose(1, 3)}</p></blockquote>", f"<pre>{words(3, 20)}</pre>", f"<table><tr><th>{word()}<th>{word()}<tr><td>{words(1, 3)}<td>{words(1, 3)}</table>", f"<figure><img src='x'><figcaption>{sentence()}</figcaption></figure>", f"<div>{prose(1, 4)}</div>", f"<ol><li>{words(1, 5)}</li><li>{words(1, 5)}</li></ol>"]))
            if r.random() < 0.08:
                parts.append("</p>" + f'<div data-gold="0">{r.choice((advert, sidebar, notice, formular))()}</div>')
            if r.random() < 0.08:  # without names: only the tags tell
                parts.append("</p>" + r.choice((f'<form data-gold="0"><p>{short()}</p><label>{words(1, 3)}</label><textarea>{words(1, 4)}</textarea>{words(1, 2)}<button>{words(1, 2)}</button></form>', f'<form data-gold="0">{short()} <input name="{word()}"> <button>{words(1, 2)}</button></form>', f'<aside data-gold="0"><p>{prose(1, 3)}</p></aside>', f'<aside data-gold="0"><h3>{words(1, 4)}</h3>{r.choice((links(2, 5), prose(1, 2)))}</aside>', f'<nav data-gold="0">{links(2, 5)}</nav>', f'<footer data-gold="0">{prose(1, 2)}</footer>')))
        inner = "".join(parts)
        names = ["content", "article", "post", "entry", "story", "main", "text", "body", "article-body", "entry-content"]
        kind = r.random()
        if kind < 0.55:
            return f'<article data-gold="1"{attrs(names)}>{inner}</article>'
        if kind < 0.7:
            return f'<main data-gold="1"{attrs(names)}>{inner}</main>'
        if kind < 0.92:
            return f'<div data-gold="1" class="{r.choice(names)}">{inner}</div>'
        return f'<div data-gold="1">{inner}</div>'

    before = [f() for f in (head, menu, notice, advert, formular) if r.random() < 0.5]
    after = [f() for f in (sidebar, comments, advert, formular, notice) if r.random() < 0.35] + ([foot()] if r.random() < 0.85 else [])
    side = [sidebar()] if r.random() < 0.2 else []
    if r.random() < 0.05:
        return f"<html><body>{''.join(before + after)}</body></html>"
    if r.random() < 0.1:  # all in the cells of a table, without names
        font = r.choice(("%s", "<font size=1>%s</font>", "<small>%s</small>"))
        top = r.choice((links(2, 7, " "), links(2, 7, " | "), f"{words(1, 3)} {links(2, 5, ' ')}"))
        bottom = r.choice((f"&copy; {r.randint(1995, 2024)} {words(1, 4)}", f"Copyright {r.randint(1995, 2024)} {words(1, 4)}", f"Copyright {words(1, 3)} | {links(1, 3, ' | ')}", links(2, 5, " | ")))
        side = f"<td>{links(2, 6)}</td>" if r.random() < 0.4 else ""
        return f"<html><body><table><tr><td>{top}</td></tr><tr>{side}<td>{content()}</td></tr><tr><td>{font.replace('%s', bottom)}</td></tr></table></body></html>"
    middle = content()
    if r.random() < 0.2:
        middle = f"<div class='{r.choice(('wrapper', 'container', 'page', 'row', 'main', 'content'))}'>{''.join(side)}{middle}</div>"
        side = []
    return f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title><style>p{{}}</style></head><body>{''.join(before)}{''.join(side)}{middle}{''.join(after)}</body></html>"


# -- on tables ------------------------------------------------------------------------


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """pages (html, ...) with all its columns, and _text and _n_chars (code points).

    A null or empty html, or a page without article blocks, gives the empty
    text. Whole pages are read and nothing of an article is dropped or capped.
    Repeated rows stay, other columns are carried (earlier ones of these two
    names are replaced), and an empty table gives no rows. Attributes of any
    kind are read as they are: data-gold counts in training alone.
    """
    spark = pages.sparkSession
    pages = pages.drop("_text", "_n_chars")
    ship(spark)
    shared = spark.sparkContext.broadcast(model or fit(labelled_pages()))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import html_crf

        for batch in batches:
            texts = [html_crf.main_text(h, shared.value) for h in batch.column(batch.schema.get_field_index("html")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*batch.schema.names, "_text", "_n_chars"])

    from pyspark.sql.types import LongType, StringType, StructField, StructType

    return pages.mapInArrow(extracted, StructType([*pages.schema.fields, StructField("_text", StringType()), StructField("_n_chars", LongType())]))


def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("_text").alias("text"), F.col("_n_chars").alias("n_chars"))
