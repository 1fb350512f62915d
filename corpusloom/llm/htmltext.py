"""Main text of pages by the maximum-scoring subsequence of their tokens.

A page is read once into blocks of text. Words score by where they stand and tags negative; a linear scan finds the contiguous run of blocks
of the highest sum, the content region, and the run's blocks of negative words are left out of the text.

A word's weight adds up evidence of the element that its block is in, of the named elements around it, and of their class, id and role words: log odds of
standing in content, learned from labelled pages, those of a bounded sample whose own markup says which region is the content (an article or
main element). Names that stand for menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments have a prior of
``AGAINST``, as if ``PRIOR_WORDS`` words had been seen, and whatever is against a word so strongly outweighs everything for it. Containers
such as div or section are no evidence. Tags cost by how often they stand in content.

Null or empty html gives an empty text; malformed, unclosed and truncated markup is read as far as it goes; repeated rows are
read one by one and teach once; an empty table stays empty; extra columns pass through and those named text and n_chars are replaced. Every page
is read whole, in one task.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import stash, table

PAGES, AGAINST, FOR, PRIOR_WORDS = 300, -4.0, 1.0, 50
#: Evidence counts up to so much; a word is out if one piece is at most ``OUT``.
MOST, OUT = 3.0, -2.0
COST = 0.5
#: Elements that break text into blocks.
_BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split())
#: Elements whose content is no main text, and elements without content.
_OUTSIDE = frozenset("nav footer aside form noscript template iframe button select option dialog menu search head title textarea svg object canvas audio video map datalist".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id and role that mark such content.
_HINTS = frozenset("nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription share sharing social related recommended recommendations comment comments disqus reply replies respond discussion widget toolbar pagination pager copyright login signin signup search skip contentinfo complementary".split())
_HEADS = frozenset(("header", "head", "topbar"))
_KEEPS = frozenset(("with", "has", "no", "without"))
_REGIONS = ("article", "main")
#: Elements whose name is evidence for what stands anywhere within them.
_NAMED = _OUTSIDE | frozenset(("header", "article", "main", "figure", "blockquote", "address", "details", "table", "pre"))
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style)\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^>]*(?:>|\Z)", re.S | re.I
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?<![\w=-])(hidden)(?![\w-])")
_PART = re.compile(r"[a-z]+|[0-9]+")


@dataclass
class Weights:
    """Evidence by sign (``in p``, ``el nav``, ``is sidebar``), a linked word's weight at most, and a tag's by name (``other`` for the rest)."""

    signs: dict[str, float] = field(default_factory=dict)
    linked: float = 0.1
    tags: dict[str, float] = field(default_factory=dict)
    other: float = -0.25

    def word(self, signs: tuple[str, ...]) -> float:
        of = [self.signs.get(s, prior(s)) for s in signs]
        worst = min((w for s, w in zip(signs, of, strict=True) if not s.startswith("in ")), default=0.0)
        return worst if worst <= OUT else max(-MOST, min(MOST, FOR + sum(of)))


@dataclass
class Block:
    text: str
    signs: tuple[str, ...]
    region: bool  #: within an article or main element
    words: int
    linked: int
    tags: list[str]  #: read since the block before


def prior(sign: str) -> float:
    kind, name = sign.split(" ", 1)
    if kind == "el":
        return AGAINST if name in _OUTSIDE or name == "header" else FOR if name in _REGIONS else 0.0
    return AGAINST if kind == "is" and (name in _HINTS or name in _HEADS or name == "hidden") else 0.0


def _signs(name: str, rest: str, inside: bool) -> set[str]:
    """What an element's name, class, id and role say of all within it; ``inside`` a region, headers are its own."""
    out = {f"el {name}"} if name in _NAMED and not (name == "header" and inside) else set()
    if not rest or name in ("html", "body", "main"):
        return out
    for m in _ATTRIBUTE.finditer(rest):
        if m[5]:
            out.add("is hidden")
            continue
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            out.add("is hidden")
        if key in ("class", "id", "role"):
            for word in value.split():
                parts = set(_PART.findall(word))
                if not parts & _KEEPS:
                    out.update(f"is {p}" for p in parts if p.isalpha() and not (inside and p in _HEADS))
    return out


def blocks(page: str) -> list[Block]:
    """The page's blocks in order."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = []  # name, signs of all elements down to it
    parts: list[str] = []
    tags: list[str] = []
    links = linked = inside = 0
    at = 0

    def close() -> None:
        nonlocal tags, linked, parts
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            signs = tuple(sorted(stack[-1][1])) if stack else ()
            out.append(Block(text, (f"in {stack[-1][0] if stack else ''}", *signs), inside > 0, text.count(" ") + 1, linked, tags))
            tags = []
        parts, linked = [], 0

    def pop(to: int) -> None:
        nonlocal inside
        inside -= sum(name in _REGIONS for name, _ in stack[to:])
        del stack[to:]

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            parts.append(piece)
            if links:
                linked += len(piece.split())
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        tags.append(name)
        if name in ("br", "hr", "img", "wbr"):
            if name == "hr":
                close()
            elif name == "br":
                parts.append(" ")
            continue
        if name in _VOID:
            continue
        if m["end"]:
            if name == "a":
                links = max(0, links - 1)
            if name in _BLOCKS:
                close()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if name not in _BLOCKS and any(s[0] in _BLOCKS for s in stack[k:]):
                        break
                    pop(k)
                    break
            continue
        if name == "a":
            links += 1
        if name in _BLOCKS:
            close()
            # A new block ends an open paragraph; a new item, cell or row ends the one before.
            if stack and (stack[-1][0] == "p" or stack[-1][0] == name and name in ("li", "td", "th", "tr", "dd", "dt", "option")):
                pop(len(stack) - 1)
        signs = _signs(name, m["rest"], inside > 0)
        if (name in _BLOCKS or any(prior(s) <= OUT for s in signs)) and not m["rest"].endswith("/"):
            stack.append((name, frozenset(signs | stack[-1][1] if stack else signs)))
            inside += name in _REGIONS
    if at < len(page):
        parts.append(page[at:])
    close()
    return out


def region(found: list[Block], weights: Weights) -> tuple[int, int, list[float]]:
    """The content region as a range of blocks, the maximum-scoring run; and each block's weight of a word."""
    known: dict[tuple[str, ...], float] = {}
    best = here = 0.0
    start = lo = hi = 0
    each = []
    for k, b in enumerate(found):
        if (weight := known.get(b.signs)) is None:
            weight = known[b.signs] = weights.word(b.signs)
        each.append(weight)
        here += sum(weights.tags.get(t, weights.other) for t in b.tags)
        if here <= 0:
            here, start = 0.0, k
        here += weight * (b.words - b.linked) + min(weight, weights.linked) * b.linked
        if here > best:
            best, lo, hi = here, start, k + 1
    return lo, hi, each


def extract(page: str | None, weights: Weights) -> str:
    if not page:
        return ""
    found = blocks(page)
    lo, hi, each = region(found, weights)
    return "\n".join(b.text for b, w in zip(found[lo:hi], each[lo:hi], strict=True) if w > 0)


def counts(page: str) -> dict[str, tuple[int, int]]:
    """Of a page that marks its content: by sign (and ``tag`` and ``link``) how many words (or tags) stand in it and elsewhere; nothing of any other page.

    Linked words tell of links alone: a list isn't against its words because menus are lists of links.
    """
    found = blocks(page)
    out: dict[str, list[int]] = {}
    if not any(b.region for b in found):
        return {}
    for b in found:
        k = 0 if b.region and all(prior(s) > OUT for s in b.signs) else 1
        for s in b.signs:
            out.setdefault(s, [0, 0])[k] += b.words - b.linked
        out.setdefault("link", [0, 0])[k] += b.linked
        for t in b.tags:
            out.setdefault(f"tag {t}", [0, 0])[k] += 1
    return {s: (a, b) for s, (a, b) in out.items()}


def fit(known: Iterable[tuple[str, int, int]]) -> Weights:
    """Weights from the sums of ``counts``."""
    of = {s: (a, b) for s, a, b in known}
    links, tags = of.pop("link", (0, 0)), {s[4:]: c for s, c in of.items() if s.startswith("tag ")}
    if not any(a for a, _ in of.values()):
        return Weights()
    signs = {}
    for s, (a, b) in of.items():
        if not s.startswith("tag "):
            odds = max(-MOST, min(MOST, log((a + 1) / (b + 1))))
            signs[s] = ((a + b) * odds + PRIOR_WORDS * prior(s)) / (a + b + PRIOR_WORDS)
    # A tag of the content costs a part of a word, so that short blocks hold together; one of the rest costs more.
    weigh = lambda a, b: -COST * (0.25 + 1.5 * (b + 1) / (a + b + 2))
    share = (links[0] + 1) / (sum(links) + 2)
    return Weights(signs, max(0.0, share - 0.5), {t: weigh(*c) for t, c in tags.items()}, weigh(0, 0))


def learn(pages: DataFrame, limit: int = PAGES) -> Weights:
    """From the ``limit`` different pages of lowest seeded hash, read whole on the executors; their counts reach the driver."""
    marked = pages.select(F.xxhash64(F.lit(7), "page_id", "html").alias("h"), F.col("html").cast("string").alias("html"))
    drawn = marked.select("h").distinct().orderBy("h").limit(limit)
    one = stash(marked.join(F.broadcast(drawn), "h", "left_semi").groupBy("h").agg(F.first("html").alias("html")))

    def of(rows: pa.Array) -> pa.Array:
        found = [counts(r.as_py() or "") for r in rows]
        kind = pa.list_(pa.struct([("sign", pa.string()), ("a", pa.int64()), ("b", pa.int64())]))
        return pa.array([[{"sign": s, "a": a, "b": b} for s, (a, b) in sorted(c.items())] for c in found], kind)

    each = one.select(F.explode(F.arrow_udf(of, "array<struct<sign:string,a:long,b:long>>")(F.col("html"))).alias("c"))
    return fit([tuple(r) for r in each.groupBy("c.sign").agg(F.sum("c.a"), F.sum("c.b")).collect()])


def main_text(pages: DataFrame, weights: Weights) -> DataFrame:
    """Adds text and n_chars."""
    def of(rows: pa.Array) -> pa.Array:
        return pa.array([extract(r.as_py(), weights) for r in rows], pa.string())

    keep = [F.col(f"`{c}`") for c in pages.columns if c not in ("text", "n_chars")]
    return pages.select(*keep, F.arrow_udf(of, "string")(F.col("html")).alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op9_html(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_text(pages, learn(pages)).select("page_id", "url", "text", "n_chars")
