"""Main text of web pages: a linear-chain conditional random field over the DOM's leaf blocks.

A page is cut into leaf blocks (runs of text between block-level tags). Each block has
features of its ancestors (tags, and the words of their class, id and role) and of its text;
the field scores labels with them and with the label before, and Viterbi's best labelling
says which blocks are main text. The weights are fitted to labelled pages, which a generator
makes in many layouts, so no page of the input needs a label.
"""

from __future__ import annotations

import html as html_lib
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

#: Labelled pages that the field is fitted to, and passes over them.
TRAIN_PAGES = 700
EPOCHS = 12
SEED = 11

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: HTML's own element classes.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr"
    " math mi mn mo ms mtext mrow msub msup msubsup munder mover munderover mfrac msqrt mroot mstyle mspace mpadded mphantom menclose mfenced mtable mtr mtd semantics annotation svg g tspan".split()
)
#: Scripts, styles, markup and the controls of forms.
_SKIPPED = frozenset("script style template head button select textarea".split())
#: Blocks of their own that may stand within a paragraph.
_EMBEDDED = frozenset("object iframe canvas audio video noscript text desc".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_HOLDERS = frozenset("ul ol dl table".split())

#: Words of texts that tell notices from articles.
_WORDS = frozenset("copyright cookie cookies privacy terms rights reserved subscribe newsletter login register share tweet advertisement sponsored comments comment reply menu search related".split())


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # features of the ancestors, outermost first
    tag: str
    linked: int  # characters within links


def _describe(tag: str, attributes: str) -> tuple[str, ...]:
    out = [f"in:{tag}"]
    if attributes and "=" in attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            for part in _PART.findall(_CAMEL.sub(" ", "".join(values)).lower()):
                if len(part) > 1:
                    out.append(f"{'role' if name.lower() == 'role' else 'name'}:{part}")
    return tuple(out)


def blocks_of(page: str | None) -> list[Block]:
    """The page's leaf blocks with text, in order; comments, scripts, styles, the head and the controls of forms have none."""
    if not page:
        return []
    out: list[Block] = []
    #: Open elements: tag, distinct features of it and all around it, nearest block-level tag.
    stack: list[tuple[str, tuple[str, ...], str]] = []
    open_tags: Counter[str] = Counter()
    never_closed: set[str] = set()
    parts: list[str] = []
    linked = 0
    # Behind the last > there are no tags; each search below moves on or is not made again, so the time is linear.
    at, end, last = 0, len(page), page.rfind(">")

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                _, path, tag = stack[-1] if stack else ("", (), "body")
                out.append(Block(text, path, tag, min(linked, len(text))))
            parts.clear()
        linked = 0

    def close_to(k: int) -> None:
        if any(t not in _INLINE for t, *_ in stack[k:]):
            flush()
        open_tags.subtract(t for t, *_ in stack[k:])
        del stack[k:]

    def close_nearest(tags: frozenset[str] | set[str], holders: frozenset[str] | tuple[str, ...]) -> None:
        """Closes the nearest of these elements, if none of the holders stands before it."""
        if any(open_tags[t] for t in tags):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in tags:
                    close_to(k)
                    break
                if stack[k][0] in holders:
                    break

    while at < end:
        found = _TOKEN.search(page, at) if at <= last or page.find("<!--", at) >= 0 else None
        begin = found.start() if found else end
        if begin > at:
            parts.append(page[at:begin])
            if open_tags["a"] > 0:
                linked += begin - at
        if not found:
            break
        at = found.end()
        slash, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            if found[0].startswith("<![CDATA["):
                parts.append(html_lib.escape(found[0][9:-3]))
            continue
        tag = tag.lower()
        if slash:
            if tag in _SKIPPED:
                continue
            if open_tags[tag]:
                close_nearest({tag}, ())
            elif tag not in _INLINE and tag != "br":
                flush()
            continue
        if tag in _SKIPPED:
            if tag not in ("script", "style"):
                flush()
            if tag not in never_closed and not attributes.rstrip().endswith("/"):
                closing = re.compile(rf"</{re.escape(tag)}\s*>" if tag != "head" else r"</head\s*>|(?=<body)", re.I).search(page, at)
                if not closing:
                    never_closed.add(tag)
                at = closing.end() if closing else (end if tag in ("script", "style") else at)
            continue
        if tag == "br":
            parts.append("\n")
            continue
        if tag not in _INLINE:
            flush()
            if tag in _CLOSED_BY:
                close_nearest(_CLOSED_BY[tag], _HOLDERS)
            elif tag not in _EMBEDDED:
                close_nearest({"p"}, ("td", "th", "table", "button", "object"))
        if tag in _VOID or attributes.rstrip().endswith("/"):
            continue
        _, around, block = stack[-1] if stack else ("", (), "body")
        own = tuple(f for f in dict.fromkeys(_describe(tag, attributes)) if f not in around)
        stack.append((tag, around + own if own else around, block if tag in _INLINE else tag))
        open_tags[tag] += 1
    flush()
    return out


def text_features(block: Block) -> list[str]:
    text = block.text
    words = text.split()
    n = len(words)
    tail = text[-1:]
    out = [
        f"tag:{block.tag}",
        f"words:{min(8, n.bit_length())}",
        f"linked:{min(4, 5 * block.linked // max(1, len(text)))}",
        f"end:{'stop' if tail in '.!?…»”' + chr(34) else 'colon' if tail == ':' else 'none'}",
        f"commas:{min(3, text.count(','))}",
    ]
    if "©" in text:
        out.append("sign:copyright")
    if n <= 40:
        out.extend(f"word:{w}" for w in {x.strip(".,:;!?()").lower() for x in words} & _WORDS)
    return out


@dataclass
class Field:
    """Weights of features for the label 'main text', and of label pairs (before, now) with 2 for the start."""

    weights: dict[str, float]
    pairs: list[list[float]]

    def __post_init__(self):
        self._paths: dict[tuple[str, ...], float] = {}

    def emissions(self, blocks: list[Block]) -> list[float]:
        get, out = self.weights.get, []
        for block in blocks:
            path = self._paths.get(block.path)
            if path is None:
                path = sum(get(f, 0.0) for f in set(block.path))
                if len(self._paths) < 50_000:
                    self._paths[block.path] = path
            out.append(path + sum([get(f, 0.0) for f in text_features(block)]))
        return out

    def decode(self, emissions: list[float]) -> list[int]:
        """Viterbi's best labels; ties to 'not main text'."""
        if not emissions:
            return []
        (p00, p01), (p10, p11), (s0, s1) = self.pairs
        a, b = s0, s1 + emissions[0]
        back = []
        for e in emissions[1:]:
            from_a = (a + p00 >= b + p10, a + p01 >= b + p11)
            back.append(from_a)
            a, b = (a + p00 if from_a[0] else b + p10), e + (a + p01 if from_a[1] else b + p11)
        label = int(b > a)
        out = [label]
        for from_a in reversed(back):
            label = 0 if from_a[label] else 1
            out.append(label)
        return out[::-1]

    def main_text(self, page: str | None) -> str:
        blocks = blocks_of(page)
        labels = self.decode(self.emissions(blocks))
        return "\n".join(b.text for b, label in zip(blocks, labels) if label)


def fit(pages: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS, seed: int = SEED, rate: float = 0.25, ridge: float = 1e-3) -> Field:
    """Weights of greatest (ridge-penalised) likelihood, by stochastic gradient over forward and backward sums."""
    names: dict[str, int] = {}
    rows = [([np.array([names.setdefault(f, len(names)) for f in {*b.path, *text_features(b)}]) for b in blocks], np.array(labels)) for blocks, labels in pages if blocks]
    w, squares = np.zeros(len(names)), np.full(len(names), 1e-6)
    t, t_squares = np.zeros((3, 2)), np.full((3, 2), 1e-6)
    rng = random.Random(seed)
    for _ in range(epochs):
        rng.shuffle(rows)
        for features, labels in rows:
            n = len(features)
            e = np.zeros((n, 2))
            e[:, 1] = [w[f].sum() for f in features]
            forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
            forward[0] = t[2] + e[0]
            for i in range(1, n):
                forward[i] = np.logaddexp(forward[i - 1, 0] + t[0], forward[i - 1, 1] + t[1]) + e[i]
            for i in range(n - 2, -1, -1):
                onward = e[i + 1] + backward[i + 1]
                backward[i] = np.logaddexp(t[:2, 0] + onward[0], t[:2, 1] + onward[1])
            total = np.logaddexp(*forward[-1])
            chance = np.exp(forward + backward - total)
            delta = labels - chance[:, 1]
            gradient_t = np.zeros((3, 2))
            gradient_t[2] = np.array([1 - labels[0], labels[0]]) - chance[0]
            for i in range(1, n):
                joint = np.exp(forward[i - 1][:, None] + t[:2] + (e[i] + backward[i])[None, :] - total)
                gradient_t[:2] -= joint
                gradient_t[labels[i - 1], labels[i]] += 1
            flat, amount = np.concatenate(features), np.repeat(delta, [len(f) for f in features])
            used, where = np.unique(flat, return_inverse=True)
            g = np.bincount(where, amount) - ridge * w[used]
            squares[used] += g * g
            w[used] += rate * g / np.sqrt(squares[used])
            gradient_t -= ridge * t
            t_squares += gradient_t**2
            t += rate * gradient_t / np.sqrt(t_squares)
    return Field({f: float(w[i]) for f, i in names.items()}, t.tolist())


# ---------------------------------------------------------------- labelled pages


def _sentence(rng: random.Random, low: int, high: int, stop: str = ".") -> str:
    words = ["".join(rng.choice("aeiou" if i % 2 else "bcdfghlmnprstv") for i in range(rng.randint(2, 9))) for _ in range(rng.randint(low, high))]
    for i in range(len(words) - 1):
        if rng.random() < 0.12:
            words[i] += ","
    if rng.random() < 0.12:  # junk in the words says nothing about the block
        return rng.choice((" | ", " *** ", "%%% ", " - ", " · ")).join(words) + rng.choice((stop, "", "###"))
    return " ".join(words).capitalize() + stop


def labelled_page(rng: random.Random) -> tuple[str, list[int]]:
    """A page in a random layout, and for each of its leaf blocks whether it is main text."""
    out, labels = [], []
    own = random.Random(rng.getstate()[1][0])  # for what is embedded; the layout's draws stay as they are

    def block(open_tag: str, text: str, close_tag: str, label: int) -> None:
        out.append(f"{open_tag}{text}{close_tag}")
        labels.append(label)

    def links(n: int) -> None:
        out.append("<ul>")
        for _ in range(n):
            block("<li><a href='/x'>", _sentence(rng, 1, 4, ""), "</a></li>", 0)
        out.append("</ul>")

    def box(tags: str, names: str, body) -> None:
        tag = rng.choice(tags.split())
        name = rng.choice(names.split())
        plain = tag in ("nav", "aside", "header", "footer", "form") and rng.random() < 0.5
        out.append(f"<{tag}{'' if plain else f' {rng.choice(("class", "id"))}={chr(34)}{name}{chr(34)}'}>")
        body()
        out.append(f"</{tag}>")

    def short(low: int = 2, high: int = 14) -> None:
        for _ in range(rng.randint(1, 3)):
            block(rng.choice(("<p>", "<div>", "<span>", "<h3>")), _sentence(rng, low, high, rng.choice((".", "", "!"))), "</p></div></span></h3>", 0)

    def long_boilerplate() -> None:
        for _ in range(rng.randint(1, 4)):
            block("<p>", " ".join(_sentence(rng, 5, 20) for _ in range(rng.randint(1, 4))), "</p>", 0)

    def notice() -> None:
        block("<p>", rng.choice(("We use cookies. ", "Subscribe to our newsletter. ", "Advertisement. ", "")) + _sentence(rng, 3, 15), "</p>", 0)

    def form() -> None:
        block("<label>", _sentence(rng, 1, 4, ":"), "</label><input name='q'>", 0)
        out.append("<br>")

    def comments() -> None:
        block("<h3>", rng.choice(("Comments", "Responses", _sentence(rng, 1, 3, ""))), "</h3>", 0)
        for _ in range(rng.randint(1, 4)):
            out.append(f"<{(t := rng.choice(('div', 'li', 'article')))} class='{rng.choice(('comment', 'reply', 'comment-body'))}'>")
            block("<p>", " ".join(_sentence(rng, 4, 25) for _ in range(rng.randint(1, 3))), "</p>", 0)
            out.append(f"</{t}>")

    def article() -> None:
        level, headed = rng.choice(("h1", "h2")), rng.random() < 0.65
        if headed:
            block(f"<{level}>", _sentence(rng, 2, 12, rng.choice(("", "", "."))), f"</{level}>", 1)
        for _ in range(rng.choice((0, 1, 2, 3, 5, 8, 13, 30)) if headed else rng.choice((1, 1, 2, 3, 5, 8))):
            kind = rng.random()
            if kind < 0.62:
                inner = " ".join(_sentence(rng, 1, 30) for _ in range(rng.choice((1, 1, 2, 4, 6, 12))))
                if rng.random() < 0.2:
                    inner = inner.replace(" ", " <a href='/y'>", 1) + "</a>"
                block(rng.choice(("<p>", "<p>", "<p class='text'>", "<div>")), inner, "</p></div>", 1)
            elif kind < 0.7:
                block("<p><b>", _sentence(rng, 1, 9, rng.choice((".", ""))), "<br></b></p>", 1)
            elif kind < 0.78:
                block("<h2>", _sentence(rng, 1, 7, ""), "</h2>", 1)
            elif kind < 0.85:
                block("<blockquote>", _sentence(rng, 5, 25), "</blockquote>", 1)
            elif kind < 0.93:
                out.append("<ul>")
                for _ in range(rng.randint(2, 5)):
                    block("<li>", _sentence(rng, 1, 14, rng.choice((".", ""))), "</li>", 1)
                out.append("</ul>")
            else:
                block("<pre>", _sentence(rng, 3, 15, ";"), "</pre>", 1)
            if own.random() < 0.05:
                tag = own.choice(("object", "canvas", "audio", "video", "iframe"))
                block(f"<{tag}>", _sentence(own, 2, 20), f"</{tag}>", 1)
            if rng.random() < 0.06:
                box("div aside", "ad ads advert sponsored promo related newsletter share", rng.choice((notice, short)))

    if rng.random() < 0.5:
        box("header div", "header masthead banner top site-header", short)
    if rng.random() < 0.85:
        box("nav nav div", "nav menu navigation navbar breadcrumb", lambda: links(rng.randint(2, 9)))
    if rng.random() < 0.3:
        box("div section", "cookie cookie-notice notice consent banner alert popup", notice)
    if rng.random() < 0.6:
        box("div", "ad ads advert advertisement sponsor banner promo", rng.choice((notice, short)))
    if rng.random() < 0.3:
        box("aside div", "sidebar side related widget", lambda: rng.choice((links, lambda _: short()))(4))
    if rng.random() < 0.25:
        box("form", "search searchform login subscribe", form)
    wrap = rng.choice(("<main>", "<div id='content'>", "<div class='container'>", "<div id='page'>", "<div class='wrapper'>", ""))
    body = rng.choice(
        ("<article>", "<article>", "<article>", "<article class='post'>", "<div class='article-body'>", "<div class='post-content'>", "<div class='entry'>", "<main>", "<section class='story'>", "<div itemprop='articleBody'>")
        + ("<div id='main'>", "<div class='main'>", "<div id='main-content'>", "<div class='content'>", "<div role='main'>", "<section>", "<div id='text'>")
    )
    if own.random() < 0.5:  # a wrapper that says nothing, or whose name is any word
        body = own.choice(("<div>", "<div>", "<div class='post'>", "<div class='story'>", f"<div class='{_sentence(own, 1, 1, '').lower()}'>", f"<div id='{_sentence(own, 1, 1, '').lower()}'>", f"<section class='{_sentence(own, 1, 1, '').lower()}'>"))
        wrap = own.choice(("", "<div>", "<div>", wrap))
    out.append(wrap + body)
    article()
    out.append(re.sub(r"<(\w+)[^>]*>", r"</\1>", body) + (re.sub(r"<(\w+)[^>]*>", r"</\1>", wrap)))
    if rng.random() < 0.4:
        box("section div", "comments comment-list responses discussion disqus", comments)
    if rng.random() < 0.3:
        box("aside div", "sidebar side related recommended widget social share", lambda: rng.choice((links, lambda _: short(), lambda _: long_boilerplate()))(4))
    if rng.random() < 0.2:
        box("form", "contact subscribe newsletter", form)
    if rng.random() < 0.9:
        box("footer footer div", "footer copyright legal bottom site-footer", lambda: block("<p>" if rng.random() < 0.5 else "", rng.choice(("&copy; ", "Copyright ", "")) + _sentence(rng, 1, 14), "</p>", 0))
    return "<html><head><title>x</title></head><body>" + "\n".join(out) + "</body></html>", labels


def labelled_pages(n: int = TRAIN_PAGES, seed: int = SEED) -> list[tuple[list[Block], list[int]]]:
    """Leaf blocks and labels of ``n`` generated pages; a page whose markup merges blocks is made anew."""
    rng, out = random.Random(seed), []
    while len(out) < n:
        page, labels = labelled_page(rng)
        blocks = blocks_of(page)
        if len(blocks) == len(labels):
            out.append((blocks, labels))
    return out


def extract(pages: DataFrame, field: Field | None = None, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text (blocks of main text joined by line breaks, empty if none) and n_chars of every row.

    Null and empty pages have no text, and pages of any length are read whole, in time that grows with
    their length. Equal pages get equal texts, repeated rows one each, and an empty table gives an
    empty one. Viterbi's ties go to what is not main text. Columns are taken by name and others
    ignored, whatever they are called.
    """
    shared = pages.sparkSession.sparkContext.broadcast(field or fit(labelled_pages()))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [own.main_text(p) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (page_id, url)]
    chosen = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return chosen.mapInArrow(scan, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


__all__ = ["Block", "Field", "blocks_of", "extract", "fit", "labelled_page", "labelled_pages", "op9_html_text"]
