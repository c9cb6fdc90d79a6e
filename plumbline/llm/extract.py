"""Main text of web pages: the text of their blocks, less chrome and what the pages of a host repeat.

A page is read as blocks of text. Each element has marks of its own: by its tag or role (menus, headers, footers, asides,
forms, hidden parts), by the words of its class and id (adverts, notices, sidebars), or as a place of comments. Marks are
weak evidence. None counts on an element that holds the article (the longest `article`, else `main`, else an element named as
content), so a wrapper named "with-sidebar" loses nothing; a name counts neither beside a content name or a word such as "no",
"has" or "with", nor on an element with more than half of the page's words. A marked inline element takes its text along.

The blocks that are left are the page's token stream, block tags included. The streams of a host's pages are concatenated; a
suffix array with the lengths of the common prefixes of neighbours gives the intervals of suffixes that begin with the same
DEPTH tokens, so the substrings that distinct pages share. A block with fewer tokens is a substring of its own. Hosts of more than
SHARD pages or SHARD_BYTES bytes are dealt to shards, each with a suffix array. A substring that a share of the host's pages
holds is held by that share of the pages of some shard, so each shard tells only what it finds at that share, and these
candidates are then counted in all shards: results do not depend on the shards.

A substring is repeated if two pages and LEAST_SHARE of the host's pages hold it. A page has content of its own if at least OWN
of its tokens lie in no repeated substring; else it is a copy. A repeated substring is boilerplate if as many pages with content
of their own hold it, so copies alone make none and keep their text. Article text, and a block shorter than DEPTH, need more: three such
pages that are ARTICLE_SHARE of the host's pages. What is covered by boilerplate goes, whole blocks or runs of DEPTH tokens
and more inside of a block; all other text stays, also outside of the article. Only where the text that is left between two
parts of the article has fewer than DEPTH words, too few for a substring, the tags decide and it goes.

Pages are parsed once, into a table in the shared folder that is bucketed by shard; all later steps read it without a
shuffle.

Defined cases: null and empty html give the empty text; unclosed, crossed and cut tags are taken as they come (an inline element
ends with its block); a null url is a host of its own name (the empty one); of equally long articles the first counts; every row
is a page, so rows that repeat an id are reported each and count as copies; a header inside of the article goes; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded, fresh_name, gram_hashes, mix, signed, stage
from plumbline.session import scratch_dir

DEPTH = 8
SHARD = 256
SHARD_BYTES = 1 << 24
FILE_BYTES = 1 << 24
FILE_BUCKETS = 8
OWN = 0.2
LEAST_PAGES = 2
LEAST_SHARE = 1 / 64
ARTICLE_PAGES = 3
ARTICLE_SHARE = 0.5

TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|template|noscript|textarea|svg|iframe|object|select|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
    r".*?(?:</(?P=raw)\s*>|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|itemprop|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br img input".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME_TAGS = frozenset("nav header footer aside form button menu dialog head fieldset".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar alertdialog".split())
CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu menus "
    "breadcrumb breadcrumbs sidebar sidebars aside header masthead footer foot cookie cookies consent gdpr notice notices banner banners popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "comment comments commentlist disqus reply replies respond widget widgets pagination pager toolbar copyright skip outbrain "
    "taboola paywall form search toc hidden teaser teasers trending".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist disqus reply replies respond".split())
NOT_A_NAME = frozenset("no not has have with without".split())
CONTENT_NAMES = frozenset("article content main post entry story articlebody maincontent postcontent entrycontent".split())
NAME_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")


def names_in(value: str) -> set[str]:
    """The words of a class or id: cut at everything but letters and where capitals begin."""
    out: set[str] = set()
    for word in value.split():
        parts = [p.lower() for p in NAME_PARTS.findall(word)]
        out.update(parts)
        out.add("".join(parts))
    return out


TAG, NAME, COMMENT = 1, 2, 4  # what an element's own marks come from


@dataclass
class Element:
    tag: str
    parent: int
    marks: int
    kind: str  # article, main or content if it is such a region
    words: int = 0  # in it and all that lies inside
    holds: bool = False  # the article is it or lies inside


@dataclass
class Block:
    tag: str
    element: int
    text: str


@dataclass
class Page:
    elements: list[Element] = field(default_factory=lambda: [Element("", -1, 0, "")])
    blocks: list[Block] = field(default_factory=list)

    def above(self, e: int) -> Iterator[Element]:
        while e >= 0:
            yield self.elements[e]
            e = self.elements[e].parent

    def article(self) -> int:
        """The element that is the article: of the best kind that has text the one with most words; -1 if none.

        One inside of a marked element counts only if no other has text and it has half of the page's words.
        """
        for block in self.blocks:
            n = block.text.count(" ") + 1
            for element in self.above(block.element):
                element.words += n
        every = self.elements[0].words
        regions = [k for k, e in enumerate(self.elements) if e.kind and e.words]
        free = [k for k in regions if not any(e.marks for e in self.above(k))]
        for found in (free, [k for k in regions if 2 * self.elements[k].words >= every]):
            for kind in ("article", "main", "content"):
                same = [k for k in found if self.elements[k].kind == kind]
                if same:
                    return max(same, key=lambda k: (self.elements[k].words, -k))
        return -1

    def kept_blocks(self) -> list[tuple[str, bool, str]]:
        """Tag, whether in the article, and text of the blocks that are not chrome."""
        article = self.article()
        for element in self.above(article):
            element.holds = True
        every = self.elements[0].words
        state: list[tuple[bool, bool]] = []  # chrome, in the article
        for k, e in enumerate(self.elements):
            chrome, inside = state[e.parent] if k else (False, False)
            if not e.holds:
                chrome |= bool(e.marks & (TAG | COMMENT)) or bool(e.marks & NAME and 2 * e.words <= every)
                chrome |= inside and e.kind == "article"  # a comment or a teaser
            state.append((chrome, inside or k == article))
        return [(b.tag, state[b.element][1], b.text) for b in self.blocks if not state[b.element][0]]


def marks_of(tag: str, rest: str) -> tuple[int, str]:
    """The marks of an element and the kind of region that it is, by its tag and attributes."""
    marks, kind = TAG if tag in CHROME_TAGS else 0, tag if tag in ("article", "main") else ""
    named: set[str] = set()
    for a in ATTRIBUTE.finditer(rest):
        key, value = a[1].lower(), a[2] or a[3] or a[4] or ""
        if key == "role":
            marks |= TAG if value.lower() in CHROME_ROLES else 0
            kind = kind or {"article": "article", "main": "main"}.get(value.lower(), "")
        elif key in ("class", "id"):
            for word in value.split():
                names = names_in(word)
                named |= names & CONTENT_NAMES if names & NOT_A_NAME else names
        elif key == "itemprop":
            kind = "article" if value.lower() == "articlebody" else kind
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            marks |= TAG
        elif key == "style" and "display:none" in value.replace(" ", "").lower():
            marks |= TAG
    if tag not in ("html", "body", "article", "main"):
        if named & CHROME_NAMES and not named & CONTENT_NAMES:
            marks |= COMMENT if named & COMMENT_NAMES else NAME
        elif named & CONTENT_NAMES and not named & CHROME_NAMES:
            kind = kind or "content"
    return marks, kind


def read_page(source: str) -> Page:
    page, stack, held = Page(), [0], []
    elements = page.elements
    dropped: list[str] = []  # open inline elements from the outermost marked one on

    def flush(tag: str) -> None:
        dropped.clear()
        if not held:
            return
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            page.blocks.append(Block(tag, stack[-1], text))

    last = "body"
    for m in TOKENS.finditer(source):
        if m["text"] is not None:
            held.append(" " if dropped else m["text"])
        elif m["data"] is not None:
            held.append(" " if dropped else entities.escape(m["data"], quote=False))
        elif m["tag"]:
            tag, rest = m["tag"].lower(), m["rest"] or ""
            if tag in INLINE:
                if tag == "br":
                    held.append(" ")
                elif tag in VOID:
                    continue
                elif not m["close"]:
                    if dropped or (rest and not rest.endswith("/") and marks_of(tag, rest)[0]):
                        dropped.append(tag)
                elif tag in dropped:
                    del dropped[len(dropped) - 1 - dropped[::-1].index(tag) :]
                continue
            flush(last)
            last = tag
            if m["close"]:
                for k in range(len(stack) - 1, 0, -1):
                    if elements[stack[k]].tag == tag:
                        del stack[k:]
                        break
                continue
            if tag in VOID or rest.endswith("/"):
                continue
            if tag in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "tr", "th", "dd", "dt", "option"):
                # Often unclosed: it ends where its like begins, and holds no state unless it is named.
                while len(stack) > 1 and elements[stack[-1]].tag == tag:
                    stack.pop()
                if not rest:
                    continue
            elements.append(Element(tag, stack[-1], *marks_of(tag, rest)))
            stack.append(len(elements) - 1)
    flush(last)
    return page


def suffix_ranks(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of the tokens, sorted by their first `depth` (a power of two), and the rank of each suffix.

    Suffixes with equal ranks begin with the same `depth` tokens, or are the same as far as the text goes.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    length = 1
    while length < depth:
        follow = np.zeros(len(rank), np.int64)
        follow[:-length] = rank[length:] + 1 if length < len(rank) else 0
        rank = np.unique(rank * (len(rank) + 2) + follow, return_inverse=True)[1].astype(np.int64)
        length *= 2
    return np.argsort(rank, kind="stable"), rank


def prefix_lengths(tokens: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """How many tokens, up to `depth`, each suffix in the suffix array has in common with the one before it."""
    out = np.zeros(len(order), np.int64)
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in range(depth):
        a, b = order[:-1] + k, order[1:] + k
        same &= (a < len(tokens)) & (b < len(tokens))
        same[same] = tokens[a[same]] == tokens[b[same]]
        out[1:] += same
    return out


def shared_substrings(streams: list[np.ndarray], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every substring of `depth` tokens in the streams: a stream and a place that hold it, and how many streams do."""
    sizes = np.array([len(t) for t in streams])
    # Streams are parted by tokens of their own, so no substring reaches over an edge.
    codes = np.unique(np.concatenate([np.empty(0, np.uint64), *streams]), return_inverse=True)[1].astype(np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    flat = np.empty(int(sizes.sum()) + len(streams), np.int64)
    at = np.arange(len(codes)) + np.repeat(np.arange(len(streams)), sizes)
    flat[at] = codes
    flat[begins + sizes] = -1 - np.arange(len(streams))
    order, _ = suffix_ranks(flat, depth)
    interval = np.cumsum(prefix_lengths(flat, order, depth) < depth) - 1
    owner = np.repeat(np.arange(len(streams)), sizes + 1)[order]
    whole = order + depth <= (begins + sizes)[owner]
    order, interval, owner = order[whole], interval[whole], owner[whole]
    named, first, interval = np.unique(interval, return_index=True, return_inverse=True)
    n = holders(interval, owner, len(named))
    return owner[first], order[first] - begins[owner[first]], n


def among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are in `known`, which is sorted."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


BASE = 0x9E3779B97F4A7C15
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


@lru_cache(maxsize=2)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of BASE and of its inverse modulo 2^64."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        factors = np.full(size + 1, base, np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors))
    return out[0], out[1]


def token_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every token between single spaces: differences of the running sums of a polynomial, all tokens at once."""
    if not data:
        return np.empty(0, np.uint64)
    codes = np.frombuffer(data, np.uint8)
    up, down = powers(max(1 << 17, 1 << len(codes).bit_length()))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_BYTES[codes] * up[: len(codes)], out=sums[1:])
    spaces = np.flatnonzero(codes == 32)
    first, last = np.append(0, spaces + 1), np.append(spaces, len(codes))
    return mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))


def window_hashes(tokens: np.ndarray) -> np.ndarray:
    """An even hash of every DEPTH consecutive tokens."""
    if len(tokens) < DEPTH:
        return np.empty(0, np.uint64)
    return gram_hashes(tokens, DEPTH) & ~np.uint64(1)


def holders(keys: np.ndarray, pages: np.ndarray, n_keys: int) -> np.ndarray:
    """How many distinct pages hold each of the keys 0 to n_keys - 1."""
    width = int(pages.max()) + 1 if len(pages) else 1
    return np.bincount(np.unique(keys * width + pages) // width, minlength=n_keys)


Blocks = list[tuple[str, bool, str]]


class Stream:
    """The tokens of a page that are compared with other pages, and its substrings: a key, the place and the length of each.

    Keys of substrings of DEPTH tokens are even, keys of whole blocks with fewer tokens odd.
    """

    def __init__(self, blocks: Blocks):
        self.blocks = blocks
        self.tokens = token_hashes(" ".join(f"<{tag}> {text}" for tag, _, text in blocks).encode("utf-8", "surrogatepass"))
        ends = np.cumsum([text.count(" ") + 2 for _, _, text in blocks]).tolist()
        # First and last + 1 of the words of each block; its tag comes before.
        self.places = [(a + 1, b) for a, b in zip([0, *ends], ends, strict=False)]
        self.windows = window_hashes(self.tokens)
        short = [(k, a - 1, b) for k, (a, b) in enumerate(self.places) if b - a + 1 < DEPTH]
        keys = [xxhash.xxh3_64_intdigest(blocks[k][2].encode("utf-8", "surrogatepass")) | 1 for k, _, _ in short]
        self.short = np.array(keys, np.uint64)
        self.short_at = np.array([x[1:] for x in short], np.int64).reshape(-1, 2)

    def keys(self) -> np.ndarray:
        return np.concatenate([self.windows, self.short])

    def covered(self, known: np.ndarray) -> np.ndarray:
        """Which tokens lie in substrings whose keys are known."""
        edge = np.zeros(len(self.tokens) + 1, np.int64)
        hit = np.flatnonzero(among(self.windows, known))
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + DEPTH, -1)
        at = self.short_at[among(self.short, known)]
        np.add.at(edge, at[:, 0], 1)
        np.add.at(edge, at[:, 1], -1)
        return np.cumsum(edge[:-1]) > 0


CODEC = "zstd"


def packed(blocks: Blocks) -> bytes:
    data = json.dumps(blocks, ensure_ascii=False, separators=(",", ":")).encode("utf-8", "surrogatepass")
    return len(data).to_bytes(8, "little") + pa.Codec(CODEC, 9).compress(data, asbytes=True)


def unpacked(data: bytes) -> Blocks:
    raw = pa.Codec(CODEC).decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), asbytes=True)
    return [tuple(b) for b in json.loads(raw.decode("utf-8", "surrogatepass"))]


def parsed(rows: DataFrame) -> DataFrame:
    """page_id, url, host, bytes and the packed blocks of every row; a page is parsed here and nowhere else."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [packed(read_page(h.as_py() or "").kept_blocks()) for h in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(blocks, pa.binary())], ["page_id", "url", "host", "blocks"])

    return rows.select("page_id", "url", "host", "html").mapInArrow(parse, "page_id long, url string, host string, blocks binary")


def by_host(table: pa.Table) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for k, host in enumerate(table.column("host").to_pylist()):
        out.setdefault(host, []).append(k)
    return out


def known_keys(table: pa.Table) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The keys of each host, sorted, and the number beside each."""
    out = {}
    for host, rows in by_host(table).items():
        mine = table.take(pa.array(rows, pa.int64()))
        h, n = (np.concatenate([np.array(x, np.int64) for x in mine.column(c).to_pylist()]) for c in ("hs", "ns"))
        order = np.argsort(h.view(np.uint64))
        out[host] = h.view(np.uint64)[order], n[order]
    return out


NONE = np.empty(0, np.uint64), np.empty(0, np.int64)

KEYS = "host string, h long, n long"


def _key_rows(hosts: list[str], h: list[np.ndarray], n: list[np.ndarray]) -> pa.Table:
    names = pa.array(hosts, pa.string()).take(pa.array(np.repeat(np.arange(len(h)), [len(x) for x in h]), pa.int64()))
    keys = signed(np.concatenate([np.empty(0, np.uint64), *h]))
    return pa.table([names, pa.array(keys, pa.int64()), pa.array(np.concatenate([np.empty(0, np.int64), *n]), pa.int64())], ["host", "h", "n"])


def least_pages(pages: int, parts: int) -> int:
    """How many of a shard's pages hold a substring at least, if the host's pages hold it often enough."""
    return max(1 if parts > 1 else LEAST_PAGES, int(np.ceil(LEAST_SHARE * pages)))


def candidates(table: pa.Table) -> pa.Table:
    """host, h, n: the substrings that enough pages of a shard hold, of all shards in a bucket, from their suffix arrays."""
    hosts, found, counts = [], [], []
    blocks, part, parts = table.column("blocks"), table.column("part").to_pylist(), table.column("parts").to_pylist()
    for host, rows in by_host(table).items():
        for shard in sorted({part[k] for k in rows}):
            own = [k for k in rows if part[k] == shard]
            streams = [Stream(unpacked(blocks[k].as_py())) for k in own]
            page, place, n = shared_substrings([s.tokens for s in streams])
            told = np.flatnonzero(n >= least_pages(len(own), parts[own[0]]))
            found.append(np.array([streams[p].windows[q] for p, q in zip(page[told], place[told], strict=True)], np.uint64))
            short, where = np.unique(np.concatenate([s.short for s in streams]), return_inverse=True)
            n_short = holders(where, np.repeat(np.arange(len(own)), [len(s.short) for s in streams]), len(short))
            told_short = np.flatnonzero(n_short >= ARTICLE_SHARE * len(own))
            found.append(short[told_short])
            counts += [n[told], n_short[told_short]]
            hosts += [host, host]
    return _key_rows(hosts, found, counts)


def counted(own_only: bool):
    """host, h, n: how many pages of a bucket hold each known key of their host; `own_only`: pages with content of their own."""

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        hosts, found, counts = [], [], []
        told = known_keys(right)
        for host, rows in by_host(left).items():
            if host not in told:
                continue
            known, _ = told[host]
            n = np.zeros(len(known), np.int64)
            for k in rows:
                stream = Stream(unpacked(left.column("blocks")[k].as_py()))
                keys = np.unique(stream.keys())
                keys = keys[among(keys, known)]
                if len(keys) and (not own_only or np.count_nonzero(~stream.covered(known)) >= OWN * len(stream.tokens)):
                    n[np.searchsorted(known, keys)] += 1
            hosts.append(host)
            found.append(known[n > 0])
            counts.append(n[n > 0])
        return _key_rows(hosts, found, counts)

    return count


def kept_words(words: list[str], covered: np.ndarray) -> list[str]:
    """The words of a block less its covered runs, given what is covered of its tag and its words.

    A shorter run at an end is a word or two that happen to stand beside boilerplate; it stays.
    """
    if covered[1:].all():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    stays = np.ones(len(covered), bool)
    for first, last in zip(edges[::2], edges[1::2], strict=True):
        if last - first >= DEPTH:
            stays[first:last] = False
    return [w for w, s in zip(words, stays[1:], strict=True) if s]


def text_of(stream: Stream, known: np.ndarray, common: np.ndarray) -> str:
    """The text of a page, given the keys of the boilerplate that counts outside of the article and everywhere."""
    everywhere = stream.covered(common)
    outside = everywhere | stream.covered(known)
    article = any(inside for _, inside, _ in stream.blocks)
    out: list[str] = []
    aside: list[str] = []
    n_aside = 0
    for (_, inside, text), (first, last) in zip(stream.blocks, stream.places, strict=True):
        covered = (everywhere if inside else outside)[first - 1 : last]
        n = last - first
        if covered.any():
            words = kept_words(text.split(" "), covered)
            text, n = " ".join(words), len(words)
        if not n:
            continue
        if article and not inside:
            aside.append(text)
            n_aside += n
            continue
        out += [*(aside if n_aside >= DEPTH else []), text]
        aside, n_aside = [], 0
    return " ".join(out + (aside if n_aside >= DEPTH else []))


def main_texts(left: pa.Table, right: pa.Table) -> pa.Table:
    """page_id, url, text of a bucket's pages, given the boilerplate of their hosts and how many pages hold it."""
    texts = [""] * left.num_rows
    total = left.column("pages").to_pylist()
    told = known_keys(right)
    for host, rows in by_host(left).items():
        known, n = told.get(host, NONE)
        common = known[n >= max(ARTICLE_PAGES, ARTICLE_SHARE * (total[rows[0]] or len(rows)))]
        known = known[known % 2 == 0]
        for k in rows:
            texts[k] = text_of(Stream(unpacked(left.column("blocks")[k].as_py())), known, common)
    return pa.table({"page_id": left.column("page_id"), "url": left.column("url"), "text": pa.array(texts, pa.string())})


def bucketed(dealt: DataFrame, files: int) -> DataFrame:
    """The rows as a table that needs no shuffle to be grouped by bucket: all rows of one are in one of its files.

    The catalogue keeps no entry.
    """
    spark, name = dealt.sparkSession, fresh_name("pages")
    writer = dealt.repartition(files, "bucket").write.option("path", scratch_dir(spark, "page-blocks"))
    writer.option("compression", "uncompressed").bucketBy(files, "bucket").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external one: its files stay
    return table


def extract(pages: DataFrame, shard: int = SHARD) -> DataFrame:
    """page_id, url and text of every row."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    rows = rows.withColumn("host", host)
    sizes = rows.groupBy("host").agg(F.count("*").alias("pages"), F.coalesce(F.sum(F.octet_length("html").cast("long")), F.lit(0)).alias("bytes"))
    parts = F.greatest(F.ceil(F.col("pages") / shard), F.ceil(F.col("bytes") / SHARD_BYTES), F.lit(1)).cast("int")
    sizes = stage(sizes.withColumn("parts", parts), "host-sizes")
    total = sizes.agg(F.coalesce(F.sum(F.col("bytes").cast("decimal(38,0)")), F.lit(0))).first()[0]
    files = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(total) // FILE_BYTES + 1)
    bucket = F.pmod(F.xxhash64("host", "part"), F.lit(FILE_BUCKETS * files)).cast("int")
    several = bounded(sizes.where("parts > 1").select("host", "pages", "parts"), "large-hosts")
    dealt = parsed(rows).withColumn("rid", F.monotonically_increasing_id()).join(several, "host", "left")
    dealt = dealt.withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int")).drop("rid")
    table = bucketed(dealt.withColumn("bucket", bucket), files)
    groups = table.groupBy("bucket")
    places = sizes.select("host", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    places = places.withColumn("bucket", bucket).select("host", "bucket").distinct()

    def dealt_keys(keys: DataFrame):
        """A host's keys as rows of arrays, for every bucket that has pages of it."""
        lists = keys.groupBy("host", F.pmod("h", F.lit(64)).alias("slice"))
        lists = lists.agg(F.collect_list(F.struct("h", "n")).alias("k")).select("host", F.col("k.h").alias("hs"), F.col("k.n").alias("ns"))
        return lists.join(places, "host").select("bucket", "host", "hs", "ns").groupBy("bucket")

    def often(found: DataFrame) -> DataFrame:
        """The keys that enough of a host's pages hold."""
        counts = found.groupBy("host", "h").agg(F.sum("n").alias("n")).join(sizes.select("host", "pages"), "host")
        least = F.greatest(F.lit(LEAST_PAGES), F.col("pages") * F.lit(LEAST_SHARE))
        least_short = F.greatest(F.lit(ARTICLE_PAGES), F.col("pages") * F.lit(ARTICLE_SHARE))
        return counts.where(F.col("n") >= F.when(F.col("h") % 2 == 0, least).otherwise(least_short)).select("host", "h", "n")

    told = stage(groups.applyInArrow(candidates, KEYS).groupBy("host", "h").agg(F.max("n").alias("n")), "page-candidates")
    repeated = stage(often(groups.cogroup(dealt_keys(told)).applyInArrow(counted(False), KEYS)), "page-repeats")
    boilerplate = stage(often(groups.cogroup(dealt_keys(repeated)).applyInArrow(counted(True), KEYS)), "page-boilerplate")
    return groups.cogroup(dealt_keys(boilerplate)).applyInArrow(main_texts, "page_id long, url string, text string")
