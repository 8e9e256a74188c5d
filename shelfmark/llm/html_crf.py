"""Main text of web pages by a linear-chain conditional random field (operator 4).

A page is a sequence of leaf blocks: runs of text between block tags, in page order, each with the
tags, classes, ids and roles of its ancestors. The field has a label for the main text and one for
everything else; features are the block's ancestors, its text (length, link share, sentences,
signs of notices) and its neighbours through the transitions. Viterbi decoding labels the blocks.

The field is trained on labelled pages: a bounded sample of the table's own pages in which an
``article`` element marks the main text, each once as it is and several times in other layouts
that keep its blocks and labels but change the tags around them (``div`` with class or id in place
of ``article``, and further menus, sidebars, notices, forms, adverts and reader comments).

Scripts, styles, templates, heads and comments of the markup are no blocks; a head ends at its end
tag or at the first text or tag that cannot stand in one. Character references
are decoded, white space in a block becomes one space, main blocks are joined by line feeds.

Defined results: null and empty pages, and pages without main text, give an empty text; markup cut
off in the middle is read as far as it goes; null ids and repeated rows each get a row; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm import crf
from shelfmark.llm.common import give_back

#: Bound of the training sample, layouts made of each page, and steps of the optimiser.
TRAINING_PAGES = 300
LAYOUTS = 3
TRAINING_STEPS = 200
FEATURE_BITS = 16
LABELS = ["main", "other"]
#: Pages that are decoded side by side.
BATCH_PAGES = 256

#: Tags of running text, which don't end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr "
    "math mfrac mi mn mo mover mroot mrow ms msqrt mstyle msub msubsup msup mtext munder munderover".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never shown as text of the page.
SILENT = frozenset("script style template head".split())
#: Tags that don't end a head whose end is left out; all others do, as text does.
IN_HEAD = VOID | frozenset("html title noscript noframes iframe".split())
#: An opening tag closes these if they are open in the same container.
CLOSES = {
    "p": ("p",),
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr",),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
#: Block tags that close an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main nav ol p pre section table ul".split()
)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    """Text between two block tags, the ancestors' marks, and the characters inside links."""

    text: str
    marks: tuple[str, ...]
    linked: int


@dataclass
class _Open:
    tag: str
    marks: tuple[str, ...]


@dataclass
class _State:
    stack: list[_Open] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    links: int = 0


class BlockParser(HTMLParser):
    """Collects the leaf blocks of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.state = _State()
        self.silent: list[str] = []

    def _flush(self) -> None:
        state = self.state
        text = _SPACE.sub(" ", "".join(state.parts)).strip()
        if text:
            marks = tuple(m for o in state.stack for m in o.marks)
            self.blocks.append(Block(text, marks, state.linked))
        state.parts, state.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SILENT:
            self.silent.append(tag)
            return
        if self.silent and self.silent[-1] == "title" and (tag == "body" or tag in ENDS_P):
            self.silent.pop()
        if self.silent:
            if tag == "title" and self.silent[-1] == "head":
                self.silent.append(tag)
            if self.silent != ["head"] or tag in IN_HEAD:
                return
            self.silent = []
        if tag in INLINE:
            if tag == "a":
                self.state.links += 1
            elif tag in ("br", "wbr", "img"):
                self.state.parts.append(" ")
            return
        self._flush()
        if tag in VOID:
            return
        stack = self.state.stack
        closes = CLOSES.get(tag, ())
        if tag in ENDS_P:
            closes = (*closes, "p")
        while stack and stack[-1].tag in closes:
            stack.pop()
        stack.append(_Open(tag, _marks(tag, attrs)))

    def handle_endtag(self, tag: str) -> None:
        if self.silent:
            if tag in self.silent:
                del self.silent[self.silent.index(tag) :]
            return
        if tag in INLINE:
            if tag == "a" and self.state.links:
                self.state.links -= 1
            return
        if tag in VOID:
            return
        self._flush()
        stack = self.state.stack
        for at in range(len(stack) - 1, -1, -1):
            if stack[at].tag == tag:
                del stack[at:]
                self.state.links = 0
                break

    def handle_data(self, data: str) -> None:
        if self.silent == ["head"] and data.strip():
            self.silent = []
        if self.silent:
            return
        self.state.parts.append(data)
        if self.state.links:
            self.state.linked += len(data.strip())

    def close(self) -> None:
        super().close()
        self._flush()


def _marks(tag: str, attrs: list) -> tuple[str, ...]:
    marks = [tag]
    for name, value in attrs:
        if value and name in ("class", "id", "role", "itemprop", "aria-label", "type"):
            kind = "role" if name in ("role", "itemprop", "aria-label") else "name"
            marks += [f"{kind}={word}" for word in _WORDS.findall(value.lower())[:8]]
        elif name in ("hidden", "data-ad", "data-nosnippet"):
            marks.append(name)
    return tuple(marks)


def leaf_blocks(html: str | None) -> list[Block]:
    parser = BlockParser()
    parser.feed(html or "")
    parser.close()
    return parser.blocks


def _signs(block: Block) -> tuple[str, ...]:
    """Features of the text alone."""
    text = block.text
    n = len(text)
    sentences = text.count(". ") + text.count("! ") + text.count("? ") + (text[-1] in ".!?…")
    share = 4 * block.linked // max(n, 1)
    return (
        f"length={min(n.bit_length(), 12)}",
        f"sentences={min(sentences, 4)}",
        f"links={min(share, 4)}",
        f"end={text[-1] if not text[-1].isalnum() else 'a'}",
        f"commas={min(text.count(','), 3)}",
        f"capital={text[0].isupper()}",
        f"digits={8 * sum(map(str.isdigit, text[:200])) // min(n, 200)}",
        f"copyright={text[0] == '©' or 'copyright' in text[:80].lower()}",
        f"bars={min(text.count('|') + text.count('·') + text.count('»'), 2)}",
    )


def _hashed(names: tuple[str, ...]) -> list[int]:
    mask = (1 << FEATURE_BITS) - 1
    return [zlib.crc32(n.encode()) & mask for n in names]


class Types:
    """Distinct feature sets of blocks, numbered as they come."""

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.marks: dict[tuple, list[int]] = {}
        self.flat: list[int] = []
        self.at = [0]

    def __call__(self, block: Block) -> int:
        signs = _signs(block)
        known = self.number.get((block.marks, signs))
        if known is None:
            own = self.marks.get(block.marks)
            if own is None:
                names = {f"in:{m}" for m in block.marks}
                names.add("last:" + (block.marks[-1] if block.marks else ""))
                own = self.marks[block.marks] = _hashed(tuple(sorted(names)))
            known = self.number[block.marks, signs] = len(self.number)
            self.flat += own + _hashed(signs)
            self.at.append(len(self.flat))
        return known

    def features(self) -> crf.Features:
        return crf.Features(np.array(self.flat, np.int64), np.array(self.at, np.int64))


def labelled(html: str) -> list[tuple[str, bool]] | None:
    """(text, whether it is main text) of a page's blocks by its ``article``; None without one."""
    rows = [(b.text, "article" in b.marks) for b in leaf_blocks(html)]
    return rows if any(main for _, main in rows) else None


#: Names that public page layouts commonly give to what is and what isn't the main text.
_MAIN = ("article", "main", "div class=content", "div class=post-body", "div id=main-content",
         "section class=article-text", "div class=entry", "div class=story", "div itemprop=articleBody")
_OTHER = ("nav", "header", "footer", "aside", "form", "div class=menu", "div class=sidebar",
          "div class=ad", "div class=advert", "div class=cookie-notice", "div class=comments",
          "section id=comments", "div class=related", "div class=share", "div class=banner",
          "div class=newsletter", "ul class=breadcrumb", "div class=promo", "div id=footer",
          "div class=comment", "div role=navigation", "div class=notice", "div class=widget",
          "section class=comment-list", "div class=popup", "div class=sponsored")


def _wrapped(kind: str, inner: str) -> str:
    tag, _, attribute = kind.partition(" ")
    name, _, value = attribute.partition("=")
    return f"<{tag}{f' {name}={chr(34)}{value}{chr(34)}' if name else ''}>{inner}</{tag}>"


def layout(rows: list[tuple[str, bool]], lines: list[str], rng: random.Random) -> list[tuple[Block, bool]]:
    """A page's blocks and labels in another layout; ``lines`` fill what is not main text."""
    def other(kind: str) -> str:
        parts = []
        for _ in range(rng.randint(1, 5)):
            text = rng.choice(lines)
            if kind.startswith(("nav", "ul", "div class=menu")) or rng.random() < 0.3:
                parts.append(f"<li><a href='#'>{escape(' '.join(text.split()[:3]))}</a></li>")
            else:
                words = text.split()
                cut = rng.randint(1, max(1, min(len(words), 60)))
                parts.append(f"<p>{escape(' '.join(words[:cut]))}</p>")
        return _wrapped(kind, "".join(parts))

    before = [other(k) for k in rng.sample(_OTHER, rng.randint(1, 4))]
    after = [other(k) for k in rng.sample(_OTHER, rng.randint(1, 4))]
    main = [text for text, is_main in rows if is_main]
    inside = []
    for k, text in enumerate(main):
        tag = "h1" if k == 0 else rng.choice(("p", "p", "p", "p", "h2", "li", "blockquote"))
        inside.append(f"<{tag}>{escape(text)}</{tag}>")
        if rng.random() < 0.15:
            inside.append(other(rng.choice(_OTHER)))
    body = _wrapped(rng.choice(_MAIN), "".join(inside))
    wrap = rng.choice(("", "div class=wrapper", "div id=page", "main"))
    whole = "".join(before) + body + "".join(after)
    page = f"<html><body>{_wrapped(wrap, whole) if wrap else whole}</body></html>"
    texts = set(main)
    return [(b, b.text in texts and not _is_other(b)) for b in leaf_blocks(page)]


def _is_other(block: Block) -> bool:
    names = {k.split()[0] if " " not in k else "name=" + k.split("=")[1].split("-")[0] for k in _OTHER}
    names -= {"name=navigation"}
    return bool(names & set(block.marks)) or "role=navigation" in block.marks


def train(pages: list[str], layouts: int = LAYOUTS, steps: int = TRAINING_STEPS, seed: int = 7) -> crf.Field | None:
    """A field from pages with an ``article`` element; None if there is none."""
    rng = random.Random(seed)
    samples = [rows for rows in map(labelled, pages) if rows]
    if not samples:
        return None
    lines = [text for rows in samples for text, _ in rows]
    sequences = []
    for html in pages:
        rows = labelled(html)
        if rows:
            sequences.append([(b, "article" in b.marks) for b in leaf_blocks(html)])
            sequences += [layout(rows, lines, rng) for _ in range(layouts)]
    types = Types()
    numbers = np.array([types(b) for s in sequences for b, _ in s])
    labels = np.array([0 if main else 1 for s in sequences for _, main in s])
    lengths = np.array([len(s) for s in sequences])
    return crf.train(types.features(), numbers, labels, lengths, LABELS, 1 << FEATURE_BITS, steps, 0.1, 1e-4)


@F.arrow_udf(T.BooleanType())
def has_main_text(column: pa.Array) -> pa.Array:
    """Whether a page can be trained on: it has an ``article`` element with text."""
    return pa.array([labelled(html) is not None for html in column.to_pylist()], pa.bool_())


def training_sample(pages: DataFrame, bound: int = TRAINING_PAGES) -> list[str]:
    """Whole html of the ``bound`` labelled pages, copies counted once, whose html has the least hashes.

    Pages with the tag are parsed in the order of their hashes, more at a time, until there are enough.
    """
    tagged = pages.filter(F.col("html").rlike("(?i)<article")).select("html", F.xxhash64("html").alias("draw"))
    chosen: list[str] = []
    step = 2 * bound
    while len(chosen) < bound:
        least = tagged.select("draw").distinct().orderBy("draw").limit(step)
        n, last = least.agg(F.count("*"), F.max("draw")).first()
        if not n:
            break
        part = tagged.filter(F.col("draw") <= last).groupBy("draw").agg(F.first("html").alias("html"))
        drawn = part.filter(has_main_text("html")).orderBy("draw").limit(bound - len(chosen)).collect()
        chosen += [r["html"] for r in drawn]
        if n < step:
            break
        tagged, step = tagged.filter(F.col("draw") > last), 2 * step
    return chosen


def main_texts(field: crf.Field | None, pages: list[str | None]) -> list[str]:
    """Main text of each page."""
    if field is None:
        return [""] * len(pages)
    blocks = [leaf_blocks(html) for html in pages]
    types = Types()
    numbers = np.array([types(b) for page in blocks for b in page], np.int64)
    if not len(numbers):
        return [""] * len(pages)
    scores = types.features().scores(field.emission)[numbers]
    labels = crf.viterbi(field, scores, crf.Chains(np.array([len(p) for p in blocks])))
    out, at = [], 0
    for page in blocks:
        own = labels[at : at + len(page)]
        at += len(page)
        out.append("\n".join(b.text for b, label in zip(page, own) if label == 0))
    return out


def extract(
    df: DataFrame,
    training_pages: int = TRAINING_PAGES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``page_id, url, text`` of every page."""
    pages = df.select(
        df[id_col].alias("page_id"), df[url_col].alias("url"), df[html_col].alias("html")
    )
    field = train(training_sample(pages, training_pages))
    shared = df.sparkSession.sparkContext.broadcast(field)

    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            out: list[str] = []
            for at in range(0, len(column), BATCH_PAGES):
                out += main_texts(shared.value, column.slice(at, BATCH_PAGES).to_pylist())
            yield pa.array(out, pa.string())
        give_back()

    return pages.select("page_id", "url", text_of("html").alias("text"))
