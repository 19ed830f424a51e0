"""Main text of web pages by template deduction (operator 2).

Tokens are elements and runs of text, told apart by the path of elements around
them, so that a token occurs only inside its ancestors. Over the pages of a
host, tokens with the same occurrence vector (how often each occurs on each
page) form an equivalence class. A class is part of a template when it holds an
element and its pages differ in content; any two pages can share one, and a
host has as many templates as its pages have designs. Being told apart by path,
classes nest. Text runs of a class are fixed words; what is left are slots. A
page's main text is what stands in the container that holds most varying running
text, on average over its pages. Names of elements and classes label slots:
parts inside the container that are menus, adverts, forms and the like are left
out, and a container inside an article (or main) stands for all of that. Only a
page without a template's container goes by names alone.

Pages that copy one another share their text as pages of one design share
fixed text. Each page has SKETCHES drawn text runs, long ones likelier; tokens
whose pages agree on most of them are on copies of one content, and no template.

Occurrence vectors are never gathered: each is kept as the sum of one hash per
page and count, so a host with a third of all pages is a sum like any other.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslake.llm.common import carried, materialize, restored

# A class with fixed text has at least this many tokens.
MIN_CLASS_TOKENS = 3
# Text runs drawn for each page, and how many agree on copies of one content.
SKETCHES, COPIES_AGREE = 4, 3
# Template rows (one a host) that are broadcast: up to this many template tokens.
MAX_BROADCAST_TOKENS = 2_000_000

# ---------------------------------------------------------------------------
# Names of HTML elements, and words by which pages name parts
# that are no article text (in class, id and role).
# ---------------------------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template svg math object audio video canvas select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr br img".split()
)
DROPPED = frozenset("nav footer aside form button dialog menu fieldset datalist head".split())
PART_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar comment comments reply "
    "replies respond disqus notice notices cookie cookies consent gdpr newsletter subscribe subscription signup social share sharing "
    "related recommended recommendations breadcrumb breadcrumbs menu nav navbar navigation footer masthead header popup modal overlay "
    "widget login search toolbar pagination pager alert contentinfo complementary form dialog alertdialog menubar".split()
)
COMMENT_NAMES = frozenset("comment comments reply replies respond disqus".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# ---------------------------------------------------------------------------

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+>"
    r"|<(?P<start>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<loose>[a-zA-Z][^\s/>]*+)[^>]*+>",
    re.DOTALL,
)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
_NAME_WORD = re.compile(r"[a-z]+")
_WORD = re.compile(r"\w+")
_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


def token(path: str, text: str | None = None) -> int:
    """Signed 64-bit name of an element (by its path) or of a text run under a path."""
    h = xxhash.xxh3_64_intdigest(path if text is None else f"{path}\0{text}")
    return h - (1 << 64) if h >> 63 else h


class Block:
    """A run of text between block borders."""

    __slots__ = ("path", "text", "region", "dropped", "link_chars", "labels")

    def __init__(self, path: str, text: str, region: str, dropped: bool, link_chars: int, labels: tuple):
        self.path, self.text, self.region, self.dropped, self.link_chars, self.labels = path, text, region, dropped, link_chars, labels


def parse(source: str) -> tuple[list[Block], list[str]]:
    """Blocks of a page in order, and the paths of its block elements."""
    # Open block elements: name, path, region (article, main or ''), dropped,
    # and whether that is for good (an element's kind or comments, not a class name).
    # Last, the labels: (path, opens a region, named as no article text, for good)
    # of the elements that have one.
    stack: list[tuple[str, str, str, bool, bool, tuple]] = [("", "", "", False, False, ())]
    blocks: list[Block] = []
    paths: list[str] = []
    parts: list[str] = []
    links = link_from = 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                _, path, region, dropped, _, labels = stack[-1]
                blocks.append(Block(path, text, region, dropped, links, labels))
            parts.clear()
        links = 0

    at = 0
    in_link = False
    while True:
        m = _MARKUP.search(source, at)
        text = source[at : m.start()] if m else source[at:]
        if text:
            parts.append(text)
            links += len(text) if in_link else 0
        if not m:
            break
        at = m.end()
        if end := m["end"]:
            name = end.lower()
            if name in INLINE:
                in_link = in_link and name != "a"
                continue
            flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    in_link = False
                    break
            continue
        name = (m["start"] or m["loose"] or "").lower()
        if not name:
            continue
        if name in RAW:
            if not (m["attrs"] or "").rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
                at = close.end() if close else len(source)
            if name not in ("script", "style", "title"):
                parts.append(" ")
            continue
        if name in INLINE:
            if name == "br":
                parts.append(" ")
            in_link = in_link or name == "a"
            continue
        flush()
        if name in VOID:
            continue
        in_link = False
        closes = CLOSED_BY.get(name, ())
        while stack[-1][0] == "p" or stack[-1][0] in closes:
            stack.pop()
        _, above, region, dropped, final, labels = stack[-1]
        named = {k.lower(): (a or b or c or "").lower() for k, a, b, c in _NAMED.findall(m["attrs"] or "")}
        words = set(_NAME_WORD.findall(" ".join((named.get("class", ""), named.get("id", ""), named.get("role", "")))))
        label = name + "".join("." + w for w in sorted(words))
        path = f"{above}/{label}"
        opens = name in ("article", "main") or "main" in named.get("role", "").split()
        if name in ("html", "body"):
            words = set()
        if opens and not final:
            dropped = False  # a wrapper's class says nothing about the article in it
            region = "article" if name == "article" or region == "article" else "main"
        own = name in DROPPED or "hidden" in named or bool(words & COMMENT_NAMES) or (name == "header" and not region)
        final = final or own
        inside = words & PART_NAMES - ({"header"} if region else set())
        if opens or own or inside:
            labels = (*labels, (path, opens, bool(own or inside), own))
        stack.append((name, path, region, dropped or final or bool(inside), final, labels))
        paths.append(path)
    flush()
    return blocks, paths


def _vector_hash(page: int, count: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{page}:{count}")


def _sketch(blocks: list[Block]) -> list[int]:
    """SKETCHES text runs, each drawn with a chance by its length and alike on every page."""
    drawn = [(math.inf, 0)] * SKETCHES
    for text in {b.text for b in blocks}:
        for k in range(SKETCHES):
            h = xxhash.xxh3_64_intdigest(text, seed=k)
            drawn[k] = min(drawn[k], (-math.log((h + 1) / 2.0**64) / len(text), h >> 1))
    return [h for _, h in drawn]


def _final(b: Block) -> bool:
    """Whether an element around the block is no article text for good, and no wrapper by its class."""
    return any(final for *_, final in b.labels)


def _tokens(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch and host: each token's occurrence-vector sums, and the least and
    greatest of its pages' sketches. `holder` is the nearest element above a text
    run's element that stands once on the page; running text (`chars`) counts to it."""
    for pdf in it:
        sums: dict[tuple, list] = {}
        for host, page, source in zip(pdf["host"], pdf["page"], pdf["html"]):
            blocks, paths = parse(source if isinstance(source, str) else "")
            on_page = Counter(paths)
            counts: dict[tuple[int, bool], list[int]] = {(token(p), False): [n, 0, 0] for p, n in on_page.items()}
            for b in blocks:
                holder = b.path.rpartition("/")[0]
                while on_page[holder] > 1:
                    holder = holder.rpartition("/")[0]
                above = token(holder)
                chars = 0 if _final(b) else len(b.text) - 2 * b.link_chars
                here = counts.setdefault((token(b.path, b.text), True), [0, 0, above])
                here[0] += 1
                here[1] += chars
                if (above, False) in counts:
                    counts[above, False][1] += chars
            sketch = _sketch(blocks)
            for key, (n, chars, above) in counts.items():
                v = _vector_hash(page, n)
                s = sums.setdefault((host, *key), [0, 0, 0, 0, 0, sketch, sketch, above])
                s[0] += v >> 32
                s[1] += v & 0xFFFFFFFF
                s[2] += 1
                s[3] += n
                s[4] += chars
                s[7] = max(s[7], above)
                if s[5] != sketch or s[6] != sketch:
                    s[5], s[6] = list(map(min, s[5], sketch)), list(map(max, s[6], sketch))
        rows = [(*key, s[7], *s[:5], *s[5], *s[6]) for key, s in sums.items()]
        yield pd.DataFrame(rows, columns=["host", "token", "is_text", "holder", *_SUMS, *_LEAST, *_GREATEST])


_SUMS = ["high", "low", "pages", "total", "chars"]
_LEAST, _GREATEST = [f"least_{k}" for k in range(SKETCHES)], [f"greatest_{k}" for k in range(SKETCHES)]


def templates(pages: DataFrame) -> DataFrame:
    """One row per host with a template: host, `fixed` (tokens of fixed text) and
    `containers` (elements that hold varying running text, most first).

    `pages`: host, page (a number unlike that of any other page), html.
    """
    columns = ", ".join(f"{c} long" for c in ("holder", *_SUMS, *_LEAST, *_GREATEST))
    counted = pages.mapInPandas(_tokens, f"host string, token long, is_text boolean, {columns}")
    tokens = counted.groupBy("host", "token", "is_text").agg(
        F.max("holder").alias("holder"), *[F.sum(c).alias(c) for c in _SUMS], *[F.min(c).alias(c) for c in _LEAST], *[F.max(c).alias(c) for c in _GREATEST]
    )
    agree = sum((F.col(a) == F.col(b)).cast("int") for a, b in zip(_LEAST, _GREATEST))
    tokens = tokens.where((F.col("pages") >= 2) & (agree < COPIES_AGREE)).select("host", "token", "is_text", "holder", *_SUMS)
    tokens = materialize(tokens, "tokens")
    vector = ["host", "high", "low", "pages", "total"]
    classes = tokens.groupBy(*vector).agg(F.count("*").alias("size"), F.sum((~F.col("is_text")).cast("int")).alias("elements"))
    classes = classes.where(F.col("elements") > 0)
    fixed = tokens.where("is_text").join(classes.where(F.col("size") >= MIN_CLASS_TOKENS).select(*vector), vector)
    of_holder = fixed.groupBy("host", F.col("holder").alias("token")).agg(F.sum("chars").alias("fixed_chars"))
    # An element that stands once on each of its pages is a place of the template.
    held = tokens.where(~F.col("is_text") & (F.col("pages") == F.col("total"))).join(of_holder, ["host", "token"], "left")
    varying = F.col("chars") - F.coalesce("fixed_chars", F.lit(0))
    held = held.where(varying > 0).groupBy("host").agg(F.sort_array(F.collect_list(F.struct((varying / F.col("pages")).alias("chars"), "token")), asc=False)["token"].alias("containers"))
    return held.join(fixed.groupBy("host").agg(F.collect_set("token").alias("fixed")), "host", "left")


def main_text(source: str, fixed: frozenset[int] = frozenset(), containers: Sequence[int] = ()) -> str:
    """The article's blocks joined by a blank line.

    Fixed text of the template is left out, unless nothing else is there. The
    first of `containers` that the page holds decides the place; without one,
    the names of elements and classes do.
    """
    blocks, _ = parse(source)
    own = _inside(blocks, fixed, containers)
    if not own:
        own = [b for b in blocks if not b.dropped]
        for region in ("article", "main"):
            if of_region := [b for b in own if b.region == region]:
                own = of_region
                break
    if fixed:
        own = [b for b in own if token(b.path, b.text) not in fixed] or own
    return "\n\n".join(b.text for b in own)


def _inside(blocks: list[Block], fixed: frozenset[int], containers: Sequence[int]) -> list[Block]:
    """Blocks in the page's container, or in the article around it, without the parts labelled within."""
    if not len(containers):
        return []
    above = {path: {token(p): p for p in _above(path)} for path in {b.path for b in blocks}}
    for c in containers:
        holding = [b for b in blocks if c in above[b.path] and not _final(b)]
        if all(token(b.path, b.text) in fixed for b in holding):
            continue
        place = above[holding[0].path][c]
        regions = [path for path, opens, *_ in holding[0].labels if opens and (place == path or place.startswith(path + "/"))]
        place = regions[-1] if regions else place
        within = [b for b in blocks if b.path == place or b.path.startswith(place + "/")]
        return [b for b in within if not any(part and path.startswith(place + "/") for path, _, part, _ in b.labels)]
    return []


def _above(path: str) -> Iterator[str]:
    while path:
        yield path
        path = path.rpartition("/")[0]


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text (empty if the page has none) and n_chars.

    A null page counts as empty; a null or hostless url belongs to the host ''.
    Repeated rows give repeated result rows (and count once in their host's
    vectors only if the id or url differs). Columns besides the three named are
    not looked at; an empty table gives an empty result.
    """
    host = F.lower(F.regexp_extract(F.coalesce(url_col, F.lit("")), _HOST, 1))
    rows = pages.select(carried(id_col), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    found = materialize(templates(rows.select("host", F.xxhash64("id", "url").alias("page"), "html")), "templates")
    size = found.agg(F.sum(F.size(F.coalesce("fixed", F.array().cast("array<bigint>"))) + F.size("containers") + 10)).first()[0] or 0
    joined = rows.join(F.broadcast(found) if size <= MAX_BROADCAST_TOKENS else found, "host", "left")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            texts = []
            for source, fixed, containers in zip(pdf["html"], pdf["fixed"], pdf["containers"]):
                known = frozenset(fixed.tolist()) if isinstance(fixed, np.ndarray) else frozenset()
                texts.append(main_text(source if isinstance(source, str) else "", known, containers.tolist() if isinstance(containers, np.ndarray) else ()))
            yield pd.DataFrame({"id": pdf["id"].to_numpy(), "url": pdf["url"].to_numpy(), "text": texts, "n_chars": [len(t) for t in texts]})

    out = joined.select("id", "url", "html", "fixed", "containers").mapInPandas(run, "id string, url string, text string, n_chars long")
    return restored(out, id_col, pages).withColumnRenamed("url", url_col)
