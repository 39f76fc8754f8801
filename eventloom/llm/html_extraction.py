"""Main text of web pages: a linear-chain conditional random field over the DOM's leaf blocks.

A page becomes the sequence of its leaf blocks (runs of text that no block element
breaks), each with features of its ancestors (tags, roles, classes and ids) and of its text
(length, links, punctuation, place). The field has two labels, main and other; it is trained
in numpy on labelled pages (``labelled_pages``: page layouts of many kinds, each block with its
label) and decoded by Viterbi. The weights are a few hundred numbers and go along with the task.

Left out before the field decides is only what is never text: comments, scripts and styles (up to their
end tag or the page's end), titles and the inside of form controls (up to their end tag or the next block).
Formulas, drawings and the fallback text of objects, frames and scripts are text like any other.

Defined cases: a null page is the empty one and has no text; unclosed, misnested and
truncated markup ends where the next block or the page does; an unknown or cut character
reference stays as it is; white space is what Unicode calls so (no-break and ideographic spaces too), and
becomes one plain space; pages of any length are read whole; repeated rows and null ids are
rows like any other; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled pages and passes of the training.
PAGES, STEPS = 700, 150

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</\s*([a-zA-Z][^\s>/]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s>/]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-label)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
TOKEN = re.compile(r"[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose inside is no text, and those of them that an open block ends.
RAW = frozenset("script style title textarea select".split())
CUT = frozenset("title textarea select".split())
#: Elements with names of their own inside, none of them a block, and the HTML elements that end such a one.
FOREIGN = frozenset("svg math".split())
ENDS_FOREIGN = frozenset(
    "article aside blockquote body dd div dl dt footer form h1 h2 h3 h4 h5 h6 head header hr li main nav ol p pre section table tr td th ul".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr img input button br center nobr output picture meter progress svg math object canvas iframe noscript template".split()
)
RAW_END = {
    tag: re.compile(f"</{tag}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)" + (f"|<(?:{'|'.join(sorted(ENDS_FOREIGN))})(?=[\\s/>])" if tag in CUT else ""), re.I) for tag in RAW
}
#: Start tags that end an open element of the kinds listed (up to a border element).
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BORDERS = frozenset("ul ol dl table body html article section main div nav aside header footer form".split())
#: Words in class, id and role attributes, by what they tell.
CLUES = {
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs tabs toolbar pagination pager toc skip",
    "advert": "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner adsense",
    "side": "sidebar aside related widget rail complementary recommended more teaser trending popular",
    "notice": "cookie cookies notice consent gdpr alert popup modal newsletter subscribe dialog warning message",
    "comment": "comment comments commentlist reply replies respond discussion disqus feedback reader response responses",
    "foot": "footer copyright legal contentinfo colophon bottom",
    "head": "header masthead topbar logo branding top",
    "form": "form search login signup register",
    "share": "share sharing social tags byline meta author",
    "main": "article content post entry story main body text prose",
}
CLUE_OF = {w: kind for kind, ws in CLUES.items() for w in ws.split()}


@dataclass
class Block:
    text: str
    features: list[str]


def inline(tag: str) -> bool:
    """``~`` marks elements inside a foreign one."""
    return tag in INLINE or tag[0] == "~"


def blocks_of(page: str) -> list[Block]:
    """The leaf blocks of a page, in page order."""
    open_tags: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    raw: list[tuple[str, int, list]] = []  # text, characters in links, ancestors
    links = 0
    linked = 0
    drawings = False  # a formula or drawing has begun on this page

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                raw.append((text, linked, list(open_tags)))
            pieces.clear()
        linked = 0

    def close(at: int) -> None:
        nonlocal links
        links -= sum(t == "a" for t, _ in open_tags[at:])
        if not all(inline(t) for t, _ in open_tags[at:]):
            flush()
        del open_tags[at:]

    def foreign() -> int | None:
        """Place of the open formula or drawing that the next tag lies in."""
        return next((k for k in range(len(open_tags) - 1, -1, -1) if open_tags[k][0] in FOREIGN), None) if drawings else None

    def say(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            pieces.append(text)
            if links:
                linked += len(text)

    at = 0
    while True:
        m = MARKUP.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] in (tag, "~" + tag):
                    close(k)
                    break
                if tag in INLINE and not inline(open_tags[k][0]):
                    break
            else:
                if tag not in INLINE and foreign() is None:
                    flush()
        elif m[2]:
            tag = m[2].lower()
            if tag in RAW:
                if not m[0].endswith("/>"):
                    end = RAW_END[tag].search(page, at)
                    at = len(page) if end is None else end.end() if end[0][1] == "/" else end.start()
                if tag in ("select", "textarea"):
                    pieces.append(" ")
                continue
            inside = foreign()
            if inside is not None:
                if tag not in ENDS_FOREIGN:
                    if not m[0].endswith("/>"):
                        open_tags.append(("~" + tag, ()))
                    continue
                close(inside)
            if tag in FOREIGN:
                drawings = True
                if m[0].endswith("/>"):
                    continue
            if tag == "br":
                pieces.append(" ")
                continue
            if tag not in INLINE:
                for k in range(len(open_tags) - 1, -1, -1):  # a block ends an open paragraph, a list item the one before
                    if open_tags[k][0] == "p" or open_tags[k][0] in ENDS.get(tag, ()):
                        close(k)
                        break
                    if open_tags[k][0] in BORDERS and not (tag in ENDS and open_tags[k][0] == "div"):
                        break
                flush()
            if tag in VOID or m[0].endswith("/>") and tag not in INLINE:
                continue
            if tag == "a":
                links += 1
            open_tags.append((tag, clues(m[3]) if m[3].strip() else ()))
        if at >= len(page):
            break
    flush()
    n = len(raw)
    return [Block(text, describe(text, linked, ancestors, k, n)) for k, (text, linked, ancestors) in enumerate(raw)]


def clues(attributes: str) -> tuple[str, ...]:
    out = []
    for m in ATTRIBUTE.finditer(attributes):
        if m[1].lower() == "hidden":
            out.append("hidden")
        for word in TOKEN.findall((m[2] or m[3] or m[4] or "").lower()):
            if word in CLUE_OF:
                out.append(CLUE_OF[word])
    return tuple(dict.fromkeys(out))


def describe(text: str, linked: int, ancestors: list, k: int, n: int) -> list[str]:
    out = ["bias", "place=" + ("first" if k == 0 else "last" if k == n - 1 else "inside")]
    own, inner = "none", set()
    for tag, said in ancestors:
        if tag not in ("html", "body", "b", "i", "em", "strong", "span") and tag[0] != "~":
            inner.add("in=" + tag)
        if not inline(tag):
            own = tag
        inner.update("clue=" + c for c in said)
    # the nearest clue speaks for the block more than those around it
    near = next((c for _, said in reversed(ancestors) for c in reversed(said)), None)
    box = next((t for t, _ in reversed(ancestors) if t in ("article", "main", "section", "nav", "aside", "header", "footer", "form")), "none")
    out += [*inner, "own=" + own, "box=" + box, f"near={near}", f"own+box={own}+{box}"]
    size = len(text)
    out.append("size=" + ("tiny" if size < 20 else "short" if size < 60 else "middle" if size < 150 else "long"))
    share = linked / size if size else 0
    out.append("links=" + ("none" if share == 0 else "some" if share < 0.5 else "most"))
    out.append("end=" + ("stop" if text[-1] in ".!?…:\"'»”" else "open"))
    if "©" in text or "·" in text:
        out.append("sign")
    return out


@dataclass
class Field:
    """weights: feature -> what it adds to main; step[a][b]: from label a to b; begin: main at the start."""

    weights: dict[str, float]
    step: list[list[float]]
    begin: float


def viterbi(field: Field, blocks: list[Block]) -> list[int]:
    weigh, step = field.weights.get, field.step
    back, best = [], (0.0, 0.0)
    for k, b in enumerate(blocks):
        e = sum([weigh(f, 0.0) for f in b.features])
        if k == 0:
            best = (0.0, e + field.begin)
            continue
        a0, a1 = best[0] + step[0][0], best[1] + step[1][0]
        b0, b1 = best[0] + step[0][1], best[1] + step[1][1]
        back.append((int(a1 > a0), int(b1 > b0)))
        best = (max(a0, a1), max(b0, b1) + e)
    labels = [int(best[1] > best[0])] if blocks else []
    for pair in reversed(back):
        labels.append(pair[labels[-1]])
    return labels[::-1]


def train(pages: list[tuple[list[Block], list[int]]], decay: float = 2e-3) -> Field:
    """Maximum likelihood by full gradient steps (Adam); forward and backward sums run over all pages at once."""
    names = {f: k for k, f in enumerate(sorted({f for blocks, _ in pages for b in blocks for f in b.features}))}
    longest, n = max(len(b) for b, _ in pages), len(pages)
    y, there = np.zeros((n, longest), dtype=int), np.zeros((n, longest), dtype=bool)
    at_page, at_block, at_feature = [], [], []
    for p, (blocks, labels) in enumerate(pages):
        y[p, : len(labels)], there[p, : len(labels)] = labels, True
        for k, b in enumerate(blocks):
            at_page += [p] * len(b.features)
            at_block += [k] * len(b.features)
            at_feature += [names[f] for f in b.features]
    where = (np.array(at_page), np.array(at_block))
    feature = np.array(at_feature)
    params = np.zeros(len(names) + 5)
    first, second = np.zeros_like(params), np.zeros_like(params)
    both = there[:, 1:]
    for it in range(1, STEPS + 1):
        w, step, begin = params[: len(names)], params[len(names) : -1].reshape(2, 2), params[-1]
        e = np.zeros((n, longest, 2))
        np.add.at(e[:, :, 1], where, w[feature])
        e[:, 0, 1] += begin
        f, b = np.zeros_like(e), np.zeros_like(e)
        f[:, 0] = e[:, 0]
        for k in range(1, longest):
            new = np.logaddexp(f[:, k - 1, :1] + step[0], f[:, k - 1, 1:] + step[1]) + e[:, k]
            f[:, k] = np.where(there[:, k, None], new, f[:, k - 1])
        total = np.logaddexp(f[:, -1, 0], f[:, -1, 1])
        for k in range(longest - 2, -1, -1):
            ahead = e[:, k + 1] + b[:, k + 1]
            new = np.stack([np.logaddexp(step[a, 0] + ahead[:, 0], step[a, 1] + ahead[:, 1]) for a in (0, 1)], axis=1)
            b[:, k] = np.where(there[:, k + 1, None], new, 0)
        p_main = np.exp(f[:, :, 1] + b[:, :, 1] - total[:, None]) * there
        grad = np.zeros_like(params)
        np.add.at(grad, feature, (y - p_main)[where])
        for a in (0, 1):
            for c in (0, 1):
                pair = np.exp(f[:, :-1, a] + step[a, c] + e[:, 1:, c] + b[:, 1:, c] - total[:, None]) * both
                grad[len(names) + 2 * a + c] = ((y[:, :-1] == a) & (y[:, 1:] == c) & both).sum() - pair.sum()
        grad[-1] = (y[:, 0] - p_main[:, 0]).sum()
        grad = grad / n - decay * params
        first += 0.1 * (grad - first)
        second += 0.01 * (grad * grad - second)
        params += 0.2 * (first / (1 - 0.9**it)) / (np.sqrt(second / (1 - 0.99**it)) + 1e-8)
    return Field(dict(zip(names, params.tolist(), strict=False)), params[len(names) : -1].reshape(2, 2).tolist(), float(params[-1]))


def labelled_pages(n: int = PAGES, seed: int = 5) -> list[tuple[str, list[int]]]:
    """Pages of many layouts with the label (1: main text) of each leaf block, in page order."""
    rng = np.random.default_rng(seed)
    syllables = "ra mi to ne lu ka so ve di po an el or us ine ta ren wal che tion".split()

    def words(least: int, most: int) -> str:
        return " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(rng.integers(least, most + 1)))

    def sentence(least: int = 5, most: int = 40) -> str:
        return words(least, most).capitalize() + rng.choice([".", ".", ".", "!", "?", ""], p=[0.45, 0.2, 0.1, 0.05, 0.05, 0.15])

    def some(*options):
        return options[rng.integers(len(options))]

    def links(tag: str, k: int) -> str:
        inner = "".join(f'<li><a href="/{words(1, 1)}">{words(1, 3)}</a></li>' for _ in range(k))
        return f"{tag.format(f'<ul>{inner}</ul>')}"

    def other(kind: str) -> tuple[str, int]:
        """Markup of something that isn't the article, and its number of blocks."""
        k = int(rng.integers(2, 8))
        if kind == "menu":
            return links(some("<nav>{}</nav>", '<div class="menu">{}</div>', '<div id="nav">{}</div>', '<div role="navigation">{}</div>', '<header><nav>{}</nav></header>', '<div class="breadcrumbs">{}</div>'), k), k
        if kind == "side":
            if rng.random() < 0.5:
                return links(some("<aside>{}</aside>", '<div class="sidebar">{}</div>', '<div class="related">{}</div>', '<section class="related-posts">{}</section>'), k), k
            return some("<aside><p>{}</p></aside>", '<div class="sidebar"><p>{}</p></div>', '<div id="sidebar">{}</div>', '<aside class="widget"><div>{}</div></aside>', "<aside>{}</aside>").format(sentence(5, 60)), 1
        text = sentence(4, 45)
        if kind == "advert":
            return some('<div class="ad">{}</div>', '<div class="advert"><p>{}</p></div>', '<aside class="ad">{}</aside>', '<div id="ad-top">{}</div>', '<p class="sponsored">{}</p>', '<section class="promo"><p>{}</p></section>').format(text), 1
        if kind == "notice":
            return some('<div class="notice">{}</div>', '<div class="cookie-notice"><p>{}</p></div>', '<div id="cookie">{}</div>', '<p class="notice">{}</p>', '<div role="alert">{}</div>', '<div class="newsletter"><p>{}</p></div>', '<div class="cookie-banner">{} <button>ok</button></div>').format(text), 1
        if kind == "form":
            return some('<form><label>{}</label><input name="q"></form>', '<form action="/go"><p>{}</p><input type="text"></form>', '<form class="search"><div>{}</div></form>').format(words(1, 8)), 1
        if kind == "comments":
            box = some('<section class="comments">{}</section>', '<div id="comments">{}</div>', '<div class="comments">{}</div>', '<div class="reader-comments">{}</div>', '<ol class="commentlist">{}</ol>')
            inner = some('<div class="comment"><p>{}</p></div>', "<p>{}</p>", "<li>{}</li>", '<div class="comment">{}</div>', "<article><p>{}</p></article>", "<div>{}</div>")
            head, extra = some(("", 0), ("<h2>" + words(1, 3) + "</h2>", 1), ("<h3>" + words(1, 3) + "</h3>", 1))
            return box.format(head + "".join(inner.format(sentence(3, 60)) for _ in range(k))), k + extra
        if kind == "head":
            return some("<header>{}</header>", '<div class="header">{}</div>', '<div id="masthead"><h2>{}</h2></div>', "<header><h1>{}</h1></header>", "<header><p>{}</p></header>", '<div class="topbar">{}</div>').format(words(1, 12)), 1
        if kind == "share":
            return links(some('<div class="share">{}</div>', '<div class="social">{}</div>', '<div class="tags">{}</div>'), k), k
        return some("<footer>{}</footer>", '<div class="footer"><p>{}</p></div>', "<footer><p>{}</p></footer>", '<div id="footer">{}</div>').format(some("&copy; ", "") + words(1, 5) + some(" &middot; ", " ") + sentence(2, 30)), 1

    out = []
    for _ in range(n):
        markup, labels = [], []

        def add(kind: str, markup=markup, labels=labels) -> None:
            text, k = other(kind)
            markup.append(text)
            labels.extend([0] * k)

        alone = rng.random() < 0.15  # an article of one block, on half of these pages with nothing around it
        bare = alone and rng.random() < 0.5
        for kind in () if bare else ("head", "menu", "notice", "advert", "side", "form"):
            if rng.random() < (0.75 if kind == "menu" else 0.4):
                add(kind)
        begin, end = some(
            ("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<div class="content">', "</div>"),
            ('<div id="content"><div class="post">', "</div></div>"), ('<section class="entry-content">', "</section>"), ('<article class="post">', "</article>"),
            ("<article><section>", "</section></article>"), ("<div>", "</div>"), ("", ""),
        )
        markup.append(begin)
        if not alone and rng.random() < 0.8:
            title = f"<h1>{words(2, 12)}</h1>"
            markup.append(f"<header>{title}</header>" if "article" in begin and rng.random() < 0.2 else title)
            labels.append(1)
        closed = rng.random() < 0.8
        for _ in range(1 if alone else rng.integers(1, 14)):
            draw = rng.random()
            if alone:
                tag = some("<p>{}</p>", "<p>{}</p>", "{}", "<div>{}</div>")
                markup.append(tag.format(some(sentence(3, 60), words(3, 30), words(2, 12))))
            elif draw < 0.02:
                markup.append(f"<p>{words(2, 20)} <math><mi>{words(1, 1)}</mi><mo>=</mo><mn>2</mn></math> {sentence()}</p>")
            elif draw < 0.04:
                markup.append(some("<noscript><p>{}</p></noscript>", "<object><p>{}</p></object>", "<p><object>{}</object></p>", "<canvas><p>{}</p></canvas>").format(sentence(5, 40)))
            elif draw < 0.09:
                markup.append(f"<h2>{words(1, 6)}</h2>")
            elif draw < 0.11:
                markup.append(f"<blockquote>{sentence()}</blockquote>")
            elif draw < 0.14:
                markup.append(f"<ul><li>{sentence(2, 20)}</li><li>{sentence(1, 6)}</li></ul>")
                labels.append(1)
            elif draw < 0.16:
                markup.append(f"<pre>{sentence(2, 20)}</pre>")
            elif draw < 0.18:
                markup.append(f"<table><tr><td>{words(1, 6)}</td><td>{words(1, 3)}</td></tr></table>")
                labels.append(1)
            elif draw < 0.3:
                markup.append(f"<p>{sentence(1, 3)}</p>")
            elif draw < 0.38:
                markup.append(f'<p>{words(2, 20)} <a href="/x">{words(1, 4)}</a> {sentence()}</p>')
            elif closed:
                markup.append(f"<p>{sentence(5, 90)}</p>")
            else:
                markup.append(f"<p><b>{sentence(5, 90)}<br>")
            labels.append(1)
            if not alone and rng.random() < 0.06:
                add(some("advert", "share", "notice", "side", "form"))
        if not alone and rng.random() < 0.1:
            add(some("share", "comments", "form"))
        markup.append(end)
        for kind in () if bare else ("share", "comments", "side", "form", "advert", "notice", "foot"):
            if rng.random() < (0.7 if kind == "foot" else 0.35):
                add(kind)
        body = "".join(markup)
        page = f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title><style>p{{}}</style><script>var a = '</p>';</script></head><body>{body}</body></html>"
        out.append((page[: -14] if rng.random() < 0.1 else page, labels))
    return out


def fit(pages: list[tuple[str, list[int]]] | None = None) -> Field:
    return train([(blocks_of(p), labels) for p, labels in pages]) if pages else own_field()


@lru_cache(maxsize=1)
def own_field() -> Field:
    """The field of ``labelled_pages``, trained once in a process."""
    return train([(blocks_of(p), labels) for p, labels in labelled_pages()])


def main_text(field: Field, page: str | None) -> str:
    blocks = blocks_of(page or "")
    return "\n".join(b.text for b, label in zip(blocks, viterbi(field, blocks), strict=True) if label)


def extractor(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                texts = [main_text(field, p) for p in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(texts, pa.string())], names=["__id", "__url", "text"])

    return run


def extract(pages: DataFrame, field: Field | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    rows = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.col(html_col).alias("__html"))
    schema = T.StructType([rows.schema["__id"], rows.schema["__url"], T.StructField("text", T.StringType())])
    done = rows.mapInArrow(extractor(field or fit()), schema)
    return done.select(F.col("__id").alias(id_col), F.col("__url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))
