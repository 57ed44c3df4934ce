"""Main text of web pages: subtrees that recur over a host's pages are site template and go; kind rules judge only what recurs nowhere."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from gridweave.sources.scratch import written
from gridweave.sources.workers import map_arrow

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is text up to their end tag, whatever it holds.
RAW = frozenset("script style textarea title noscript xmp iframe noframes template".split())
#: Elements that show no text of their own; they are no part of a subtree's hash either.
UNSEEN = frozenset("head script style noscript template iframe noframes svg canvas object embed audio video map title".split())
#: Elements that are never part of an article.
DROPPED = UNSEEN | frozenset("nav footer aside form button select option input textarea dialog menu".split())
BLOCK = frozenset("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: What an open ``p`` ends at.
_ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: Elements that end at the start of another of their kind, by the kind; the scopes that they cannot leave.
_KINDS = {"li": "item", "dt": "term", "dd": "term", "tr": "row", "td": "cell", "th": "cell", "option": "choice"}
_ENDED = {"li": ("item",), "dt": ("term",), "dd": ("term",), "tr": ("cell", "row"), "td": ("cell",), "th": ("cell",), "option": ("choice",)}
_SCOPES = frozenset("ul ol dl table select".split())
#: Words of a class, id or role that mark menus, headers, footers, sidebars, notices, adverts, forms and comments of readers.
_MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu\w*|breadcrumbs?|footer|masthead|sidebar|side-bar|widget\w*|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|"
    r"newsletter|subscribe|subscription|signup|login|search|share|sharing|social|related|recommended|comments?|respond|replies|disqus|pagination|pager|toolbar|skip-?link|copyright|disclaimer|complementary|contentinfo)(?:$|[\s_-])",
    re.I,
)
_START = re.compile(r"([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*+(?:\"[^\"]*\"|'[^']*'|(?![\"'])))*+)>")
#: The same where quotes do not match up: a tag then ends at its first ``>``.
_BARE_START = re.compile(r"([a-zA-Z][^\s/>]*+)([^>]*+)>")
_END = re.compile(r"/([a-zA-Z][^\s/>]*+)[^>]*+>")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(\"[^\"]*\"|'[^']*'|[^\s\"'>]++))?")
_SIGNS = frozenset("!?")
_LONG_NUMBER = re.compile(r"&#(?:([xX])([0-9a-fA-F]{8,})|([0-9]{8,}));?")
#: Odd multipliers of the three orders in which a page's shingles are drawn for comparison.
_ORDERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@dataclass
class Node:
    tag: str
    marks: str = ""
    hidden: bool = False
    children: list = field(default_factory=list)
    holds: bool = False  # the page's first-order heading or main element is somewhere below


def _number(m: re.Match) -> str:
    """A numeric reference of many digits: without its leading zeros, or the replacement character."""
    digits = (m[2] or m[3]).lstrip("0") or "0"
    return f"&#{m[1] or ''}{digits};" if len(digits) < 8 else "�"


def decode(text: str) -> str:
    """``text`` with its character references resolved, however long their numbers are."""
    return unescape(_LONG_NUMBER.sub(_number, text)) if "&" in text else text


@lru_cache(maxsize=1024)
def _names(tag: str) -> tuple[str, ...]:
    """Under which names the places of a tag are kept: its own, its kind's, and those of the kinds that it is a scope of."""
    return (
        tag,
        *(["#p"] if tag in _ENDS_P or tag in ("li", "td", "th", "dd", "button") else []),
        *(["#" + _KINDS[tag]] if tag in _KINDS else ["#item", "#term", "#row", "#cell", "#choice"] if tag in _SCOPES else []),
    )


class _Stack:
    """Open elements, and for each tag and kind the places where it is open, so that no search walks over others."""

    def __init__(self) -> None:
        self.nodes = [Node("#root")]
        self.places: dict[str, list[int]] = defaultdict(list)

    def push(self, node: Node) -> None:
        for name in _names(node.tag):
            self.places[name].append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, depth: int) -> None:
        for node in reversed(self.nodes[depth:]):
            for name in _names(node.tag):
                self.places[name].pop()
        del self.nodes[depth:]

    def end_paragraph(self) -> None:
        where = self.places["#p"]
        if where and self.nodes[where[-1]].tag == "p":
            self.cut(where[-1])

    def end_kind(self, kind: str) -> None:
        where = self.places["#" + kind]
        if where and _KINDS.get(self.nodes[where[-1]].tag) == kind:
            self.cut(where[-1])

    def end(self, tag: str) -> None:
        if tag == "p":
            self.end_paragraph()
        elif self.places[tag]:
            self.cut(self.places[tag][-1])


def parse(html: str) -> Node:
    """Tree of elements and texts, in one pass forward over the text.

    Unclosed elements end where their parents end, stray end tags are passed over. A comment or raw element without an end goes on to
    the end of the page; what follows a ``<`` that begins a tag and never meets a ``>`` is dropped, as browsers do. If the quotes in a tag
    do not match up, that tag and later ones end at their first ``>``.
    """
    stack = _Stack()
    start_tag, at, last = _START, 0, html.rfind(">")

    def say(text: str) -> None:
        if text:
            stack.nodes[-1].children.append(decode(text))

    while True:
        open_ = html.find("<", at)
        if open_ < 0:
            say(html[at:])
            return stack.nodes[0]
        begin = html[open_ + 1 : open_ + 2]
        if begin == "/" and (m := _END.match(html, open_ + 1)):
            say(html[at:open_])
            at = m.end()
            stack.end(m[1].lower())
            continue
        if begin in _SIGNS:
            say(html[at:open_])
            if html.startswith("<!--", open_):
                close, width = html.find("-->", open_ + 4), 3
            elif html.startswith("<![CDATA[", open_):
                close, width = html.find("]]>", open_ + 9), 3
                say(html[open_ + 9 : close if close >= 0 else len(html)])
            else:
                close, width = html.find(">", open_ + 2), 1
            if close < 0:
                return stack.nodes[0]
            at = close + width
            continue
        letter = html[open_ + 2 : open_ + 3] if begin == "/" else begin
        if not (letter.isascii() and letter.isalpha()):
            say(html[at : open_ + 1])  # no tag: a lone sign
            at = open_ + 1
            continue
        say(html[at:open_])
        if last < open_:
            return stack.nodes[0]
        m = start_tag.match(html, open_ + 1)
        if not m:
            start_tag = _BARE_START
            m = start_tag.match(html, open_ + 1)
        at = m.end()
        tag = m[1].lower()
        if tag in _ENDS_P:
            stack.end_paragraph()
        for kind in _ENDED.get(tag, ()):
            stack.end_kind(kind)
        marks, hidden = "", False
        if m[2] and m[2].strip(" /"):
            for name, value in _ATTRIBUTE.findall(m[2]):
                name = name.lower()
                if name in ("class", "id", "role"):
                    marks += " " + value.strip("\"'")
                elif name == "hidden" or name == "aria-hidden" and "true" in value or name == "style" and re.search(r"display\s*:\s*none", value):
                    hidden = True
        node = Node(tag, marks, hidden)
        stack.nodes[-1].children.append(node)
        if tag in ("h1", "main") or "main" in marks.lower().split():
            for above in reversed(stack.nodes):
                if above.holds:
                    break
                above.holds = True
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|$)[^>]*>?", re.I).search(html, at)
            if tag in ("textarea", "title"):
                node.children.append(decode(html[at : end.start() if end else len(html)]))
            at = end.end() if end else len(html)
        elif tag not in VOID and not m[2].rstrip().endswith("/"):
            stack.push(node)


def left_out(node: Node, inside: bool) -> bool:
    """Whether an element is no part of an article by its kind.

    A header with a heading in an article belongs to it. A class and a form say nothing about an element that holds the page's
    first-order heading or its main element: such are wrappers of the page.
    """
    if node.tag in DROPPED and not (node.tag == "form" and node.holds):
        return True
    if node.tag == "header":
        return not (inside and any(isinstance(c, Node) and re.fullmatch("h[1-6]", c.tag) for c in node.children))
    return bool(node.marks and not node.holds and node.tag not in ("html", "body") and _MARKS.search(node.marks))


def is_main(node: Node) -> bool:
    """Whether a page marks an element as its article or main part."""
    return node.tag in ("article", "main") or "main" in node.marks.lower().split()


@dataclass(frozen=True)
class Block:
    text: str
    inside: bool  # of a part that the page marks as its article or main part
    ruled: bool  # left out by its kind, or that of an element around it


@dataclass(frozen=True)
class Subtree:
    """The blocks from ``first`` to before ``end``: hash with the tags around it, place among its siblings from either end (none for a
    first-order heading, which stands first in any article), whether in a main part."""

    hash: int
    first: int
    end: int
    head: int | None
    tail: int | None
    inside: bool


def _hash(text: str) -> int:
    return xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


def blocks(root: Node) -> tuple[list[Block], list[Subtree]]:
    """Blocks in page order and the subtrees that cover them: runs of text, and elements with two parts or more.

    Of elements around the same blocks the innermost stands for all, as it recurs wherever they do. A subtree's hash covers its tag,
    the attributes that name it, its visible texts and subtrees in order, and the tags around it. The whole page is none.
    """
    out: list[Block] = []
    found: list[Subtree] = []
    pieces: list[str] = []
    # open block elements: their parts as (hash, first block, end, inside, whether a heading), what they are, the hash of the tags around and of them, whether inside
    frames: list[tuple[list, Node, int, bool]] = [([], root, 0, False)]

    def close(inside: bool, ruled: bool) -> None:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            frames[-1][0].append((_hash("#text|" + text), len(out), len(out) + 1, inside, False))
            out.append(Block(text, inside, ruled))

    def leave() -> None:
        parts, node, around, inside = frames.pop()
        if len(parts) > 1:
            for k, (own, first, end, within, title) in enumerate(parts):
                found.append(Subtree((own * 31 + around) & (1 << 64) - 1, first, end, None if title else k, None if title else len(parts) - 1 - k, within))
            parts = [(_hash(f"{node.tag}|{node.marks}|" + ",".join(str(p[0]) for p in parts)), parts[0][1], parts[-1][2], inside, False)]
        if frames:
            frames[-1][0].extend((own, first, end, inside, title or node.tag == "h1") for own, first, end, _, title in parts)

    walk: list[tuple] = [("open", c, False, False) if isinstance(c, Node) else ("text", c, False, False) for c in reversed(root.children)]
    while walk:
        what, node, inside, ruled = walk.pop()
        if what == "text":
            pieces.append(node)
        elif what == "close":
            close(inside, ruled)
            leave()
        elif what == "inline":  # the end of a main part or of something left out, in running text
            close(inside, ruled)
        elif not (node.hidden or node.tag in UNSEEN):
            now, out_ = inside or is_main(node), ruled or left_out(node, inside)
            block = node.tag in BLOCK
            if block or now != inside or out_ != ruled:
                close(inside, ruled)
                walk.append(("close" if block else "inline", node, now, out_))
            if block:
                frames.append(([], node, (frames[-1][2] * 31 + _hash(node.tag)) & (1 << 64) - 1, inside))
            walk.extend(("text" if isinstance(c, str) else "open", c, now, out_) for c in reversed(node.children))
    close(False, False)
    leave()
    return out, found


def _companions(found: list[Block], subtrees: list[Subtree]) -> np.ndarray:
    """For each subtree and each of three orders at random, the first of the blocks' shingles beside it: 16 bytes from the start of a word.

    Pages that share most of their text mostly agree on it, though each may differ somewhere; pages with different articles around a
    common box do not.
    """
    data = np.frombuffer("\n".join(b.text for b in found).encode("utf-8", "surrogatepass") + bytes(16), np.uint8)
    breaks = np.flatnonzero((data[:-16] == 32) | (data[:-16] == 10))
    words = np.concatenate([[0], breaks + 1])
    starts = np.searchsorted(words, np.concatenate([[0], np.flatnonzero(data[:-16] == 10) + 1]))
    windows = np.lib.stride_tricks.sliding_window_view(data, 16)[words].view("<u8")
    with np.errstate(over="ignore"):
        shingles = windows[:, 0] * _ORDERS[0] ^ windows[:, 1] * _ORDERS[1]
        shingles = (shingles ^ (shingles >> np.uint64(29))) * _ORDERS[2]
        mixed = shingles[:, None] * _ORDERS
        drawn = np.minimum.reduceat(mixed ^ (mixed >> np.uint64(32)), starts)
    none = np.full((1, 3), np.iinfo(np.uint64).max, np.uint64)
    before = np.concatenate([none, np.minimum.accumulate(drawn)])
    after = np.concatenate([np.minimum.accumulate(drawn[::-1])[::-1], none])
    first, end = (np.array([getattr(s, name) for s in subtrees], np.int64) for name in ("first", "end"))
    return np.minimum(before[first], after[end]).view(np.int64)


def host_of(url: str | None) -> str:
    rest = (url or "").partition("://")[2]
    return re.split(r"[/?#]", rest, maxsplit=1)[0].lower()


def _key(url: Column, html: Column) -> Column:
    """128 bits of a row's content, by which templates find back to it: rows with equal content have equal templates."""
    return F.struct(F.xxhash64(url, html).alias("a"), F.xxhash64(html, F.lit(1), url).alias("b"))


_SUBTREE = pa.struct([("k", pa.int64()), ("head", pa.int32()), ("tail", pa.int32()), ("inside", pa.bool_()), ("beside", pa.list_(pa.int64()))])


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def number_of(host: str, subtree: Subtree) -> int:
    """The number under which a host's subtree is counted."""
    return _signed(_hash(f"{subtree.hash}|{subtree.inside}|{host}"))


def page_subtrees(pages: DataFrame) -> DataFrame:
    """Of ``pages`` (``key``, ``url``, ``html``): ``key``, ``host``, ``page`` (hash of all its text) and ``subtrees``, each number once in a page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = [], []
            hosts = [host_of(u) for u in batch.column(1).to_pylist()]
            for host, html in zip(hosts, batch.column(2)):
                found, subtrees = blocks(parse(html.as_py() or ""))
                subtrees = list({(s.hash, s.inside): s for s in reversed(subtrees)}.values())
                texts.append(_signed(_hash("\n".join(b.text for b in found))))
                beside = _companions(found, subtrees).tolist() if subtrees else []
                rows.append([{"k": number_of(host, s), "head": s.head, "tail": s.tail, "inside": s.inside, "beside": b} for s, b in zip(subtrees, beside)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hosts, pa.string()), pa.array(texts, pa.int64()), pa.array(rows, pa.list_(_SUBTREE))], names=["key", "host", "page", "subtrees"])

    return map_arrow(pages, run, "key struct<a:bigint,b:bigint>, host string, page bigint, subtrees array<struct<k:bigint,head:int,tail:int,inside:boolean,beside:array<bigint>>>")


def templates(subtrees: DataFrame, least_pages: int, least_inside: int, share: float, share_placed: float, differ: float, stray: float) -> DataFrame:
    """The numbers ``k`` of those subtrees that are template of their host, from ``page_subtrees``."""
    each = subtrees.select("host", "page", F.explode("subtrees").alias("s")).select("host", "page", "s.*")
    # pages with equal text count once; counts are added up before the shuffle by subtree, so a host of any size is no hot key
    often = each.select("k", "page", "inside").distinct().groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.first("inside").alias("inside"))
    often = written(often.where(F.col("n") >= F.when(F.col("inside"), least_inside).otherwise(least_pages)).select("k", "n"), "recurring")
    texts = subtrees.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("texts"))
    judged = (
        each.join(often, "k")
        .groupBy("k", "page", "n", "host", "inside")
        .agg(F.min(F.struct("head", "tail", "beside")).alias("s"))
        .groupBy("k", "n", "host", "inside")
        .agg(F.least(F.var_pop("s.head"), F.var_pop("s.tail")).alias("stray"), F.sort_array(F.array(*[F.approx_count_distinct(F.col("s.beside")[i]) for i in range(3)]))[1].alias("others"))
        .join(texts, "host")
    )
    placed = (F.col("n") >= F.col("texts") * F.when(F.col("inside"), share_placed).otherwise(0.0)) & (F.col("stray") <= stray) & (F.col("others") >= F.col("n") * differ)
    return judged.where((F.col("n") >= F.col("texts") * share) | placed).select("k")


def among(numbers: list[int], held: np.ndarray) -> np.ndarray:
    """Which numbers are in a sorted array."""
    wanted = np.array(numbers, np.int64)
    return held[np.minimum(np.searchsorted(held, wanted), len(held) - 1)] == wanted if len(held) else np.zeros(len(wanted), bool)


def text_of(html: str, host: str, template: Callable[[list[int]], Iterable[bool]], rules: bool = True) -> str:
    """Text of a page of ``host`` without the blocks of subtrees whose numbers are ``template`` and, with ``rules``, those outside its main part or left out by kind.

    If templates leave a marked part nothing, the rest of the page is taken, and if they leave that nothing either, only the rules decide.
    """
    found, subtrees = blocks(parse(html))
    covered = np.zeros(len(found) + 1, np.int64)
    for s, hit in zip(subtrees, template([number_of(host, s) for s in subtrees])):
        if hit:
            covered[s.first] += 1
            covered[s.end] -= 1
    gone = np.cumsum(covered) > 0
    if not rules:
        return " ".join(b.text for b, g in zip(found, gone) if not g)
    own = [(b, bool(g)) for b, g in zip(found, gone) if not b.ruled]
    main = [(b, g) for b, g in own if b.inside] or own
    kept = [b for b, g in main if not g] or [b for b, g in own if not g and not b.inside] or [b for b, _ in main]
    return " ".join(b.text for b in kept)


def main_text(
    pages: DataFrame, least_pages: int = 5, least_inside: int = 20, share: float = 0.5, share_placed: float = 0.2, differ: float = 0.5, stray: float = 0.25, counts: bool = True, rules: bool = True, most_held: int = 1_000_000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per row of ``pages``: id, ``url``, ``text`` and ``n_chars`` (code points).

    All subtrees of all pages are counted per host, by the number of different texts (of whole pages) around them: in menus, in marked main
    parts and outside. One is template, and its blocks go, if it recurs over ``least_pages`` or more - inside a part that its page
    marks as article or main, ``least_inside`` - and either on ``share`` of the host's texts, or (inside, on ``share_placed`` of them) always in the
    same place beside different articles: its number among its siblings, from the first or the last, has a variance of at most ``stray``, and the
    blocks beside it (``_companions``) are different on ``differ`` of its pages. Copied articles have like companions, and passages that articles share
    have no fixed place, so both are content. What is no template is judged by kind: menus, headers, footers, sidebars, notices,
    adverts, forms, scripts, styles and comments go, and what lies beside a marked main part. First-order headings have no fixed place. ``counts`` and ``rules`` switch either half off.

    Character references are decoded; white space in a block (as Unicode has it) becomes one space; blocks are joined by one space.
    Null html is empty, a null url has the empty host; repeated rows count as one page for templates and are returned as often as
    they come; null ids stay; no rows give no rows; other columns are not read. Pages are read in time linear in their length, twice.
    Up to ``most_held`` template numbers (8 bytes each) are held by every task; more are joined to the pages instead, with the same result.
    """
    kept = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), _key(F.col(url_col), F.col(html_col)).alias("key"))
    known, own = np.zeros(0, np.int64), F.lit(None).cast("array<bigint>")
    if counts:
        subtrees = written(page_subtrees(kept.select("key", "url", "html")), "subtrees")
        template = written(templates(subtrees, least_pages, least_inside, share, share_placed, differ, stray), "templates")
        if template.count() <= most_held:
            known = np.sort(np.array([r["k"] for r in template.collect()], np.int64))
        else:
            each = subtrees.select("key", F.explode(F.transform("subtrees", lambda s: s["k"])).alias("k"))
            kept, own = kept.join(each.join(template, "k", "left_semi").groupBy("key").agg(F.collect_set("k").alias("own")), "key", "left"), F.col("own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for url, html, numbers in zip(batch.column(1), batch.column(2), batch.column(3)):
                held = known if numbers.as_py() is None else np.sort(np.array(numbers.as_py(), np.int64))
                texts.append(text_of(html.as_py() or "", host_of(url.as_py()), lambda ks, held=held: among(ks, held), rules))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, "url", "text", "n_chars"])

    return map_arrow(kept.select("_id", "url", "html", own.alias("own")), run, f"`{id_col}` {dict(pages.dtypes)[id_col]}, url string, text string, n_chars bigint")
