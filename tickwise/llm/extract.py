"""Main text of web pages, by a suffix array over the pages of a host.

Pages are read into blocks (text between block-level tags, character
references decoded, white space folded) and into one token stream each: words
and tag names. The streams of a group of pages are laid end to end and their
suffixes are sorted by prefix doubling up to ``MIN_RUN`` tokens, which tells
the runs of so many tokens that several pages have. A run is repeated if at
least ``MIN_PAGES`` distinct pages of its host have it, and at least ``SHARE``
of the host's distinct pages: a template is on many pages, a passage that one
page quotes from another is not. Tokens of repeated runs are boilerplate, the
rest are the page's unique runs. A block with ``COVERED`` or more of its words
covered goes.

A structural check follows, since repetition alone cannot tell a menu that is
used once from an article that is quoted often: text inside a declared
``article`` or ``main`` stays even if it repeats, and text inside menus,
headers, footers, sidebars, notices, adverts, forms and comments (by tag, role
or class name) goes even if it does not. The innermost of these elements
decides: an ``article`` in a container that is boilerplate by its class, id or
as a form is declared all the same, but on each page only the declared parts
within the fewest such containers count, so comments and teasers that are
articles of their own do not. Where a page declares its main part, nothing
outside of it is kept.

Scale: pages are dealt to groups of about ``group_bytes`` of html, and the
parsed pages are shuffled to them. Hosts that fit into a group are whole in one,
whose suffix array decides them at once. The pages of a larger host are dealt to
groups by a hash of their content. A run that a share of the host's pages has
is had by the same share of some group's pages, so each group names only the
runs that about half so many of its own pages have (a group of up to 50 pages
names all); what the groups name is added up over the host. The other groups can
add little, and where that would decide, every group of the host counts the run.
So the result does not depend on the groups. Copies of one page that alone
exceed a group are spread, and count once. The lists of large hosts and of such
copies have at most one row for each ``group_bytes`` of input; up to
``MAX_BROADCAST`` rows they are broadcast, longer ones are joined by a shuffle.
Pages of small hosts are parsed once, those of large ones twice (three times if
runs are left open). A run is known by a 64-bit hash of its tokens.

Defined cases: null or empty html has empty text and no characters; a null URL
counts as host ``''``; pages of a host that are equal but for what stands inside
their tags (equal rows, or copies under other ids) count as one and do not cover
each other; cut-off pages end where they end; unclosed comments, scripts and
tags run to the end of the page; a page larger than a group is a group's whole
work; other columns are not read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import row_number, stored
from tickwise.llm.textbytes import POSITION_WEIGHT, hash_runs, mix
from tickwise.llm.url_filter import host_of

MIN_RUN = 8
MIN_PAGES = 3
SHARE = 0.02
COVERED = 0.8
GROUP_BYTES = 4 << 20
MAX_BROADCAST = 1 << 18  # rows of four numbers
PAGE_COST = 256  # bytes that a page counts beside its html
ZONES = {"main": "M", "open": "O", "boilerplate": "B"}
ZONE_OF = {letter: zone for zone, letter in ZONES.items()}

# Elements whose text is never content.
HIDDEN = frozenset(
    "head script style noscript template svg math iframe object canvas audio video select button textarea title".split()
)
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr nobr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav footer aside form dialog menu".split())
MAIN = frozenset("article main".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Words of class names and ids that mark parts beside the article.
BOILERPLATE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus"
    " footer header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo related"
    " share sharing sidebar social sponsor sponsored subscribe widget".split()
)
_TOKEN = re.compile(r"<!--|<!\[CDATA\[|<(/?)([a-zA-Z][^\s/>]*)|<[!?]")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
# Words that may stand beside them in one class name or id, as in "site-footer".
NEUTRAL_NAMES = frozenset(
    "area articles bar block bottom box button buttons container form global icons inner left link links list main"
    " outer posts primary right secondary section site top unit wrap wrapper".split()
)
HEADER_NAMES = frozenset("header masthead".split())
_NAME_CUT = re.compile(r"[^a-z0-9]+")
_TAG_END = re.compile(r""">|"[^"]*"|'[^']*'""")


class Block:
    __slots__ = ("text", "zone")

    def __init__(self, text: str, zone: str):
        self.text, self.zone = text, zone  # main, open or boilerplate


def _tag_end(page: str, at: int) -> int:
    """End of the tag whose name ends at ``at``: the next ``>`` outside quotes."""
    close = page.find(">", at)
    if close < 0:
        return len(page)
    if '"' not in page[at:close] and "'" not in page[at:close]:
        return close
    for m in _TAG_END.finditer(page, at):
        if m[0] == ">":
            return m.start()
    return close


def _marks(value: str, inside_main: bool) -> bool:
    """Whether a class name or id consists of words that mark boilerplate."""
    for name in value.split():
        words = {w.rstrip("0123456789") for w in _NAME_CUT.split(name) if w and not w[0].isdigit()}
        marks = words & BOILERPLATE_NAMES
        if inside_main:  # an article's own header
            marks -= HEADER_NAMES
        if marks and words - marks <= NEUTRAL_NAMES:
            return True
    return False


def _boilerplate(tag: str, attributes: str, inside_main: bool) -> str | None:
    """``sealed`` for a part whose articles do not count either, ``boilerplate``
    for one that may hold the declared part, else None."""
    if tag == "form":
        return "boilerplate"
    if tag in BOILERPLATE or (tag == "header" and not inside_main):
        return "sealed"
    if not attributes or tag in ("html", "body", *MAIN):
        return None
    kind = None
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "role":
            if value in BOILERPLATE_ROLES:
                if value != "form":
                    return "sealed"
                kind = "boilerplate"
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "sealed"
        elif name in ("class", "id") and _marks(value, inside_main):
            kind = "boilerplate"
    return kind


def read_page(page: str) -> tuple[list[Block], list]:
    """Blocks of a page, and its stream: tag names, and (word count, block
    number) wherever a block's words stand."""
    blocks: list[Block] = []
    stream: list = []
    open_: list[tuple[str, str | None]] = []  # element, what it opens: main, boilerplate, sealed, hidden
    zones: list[str] = []  # what is open but for hidden, in order
    levels: list[int] = []  # boilerplate containers around each block of a declared part, else -1
    n_open: Counter[str] = Counter()
    depth = {"main": 0, "boilerplate": 0, "sealed": 0, "hidden": 0}
    parts: list[str] = []

    def close_block() -> None:
        if parts:
            words = entities.unescape("".join(parts)).split()
            parts.clear()
            if words:
                zone = "open" if not zones else "main" if zones[-1] == "main" and not depth["sealed"] else "boilerplate"
                blocks.append(Block(" ".join(words), zone))
                levels.append(depth["boilerplate"] if zone == "main" else -1)
                stream.append(words)

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        text_end = m.start() if m else n
        if text_end > at and not depth["hidden"]:
            parts.append(page[at:text_end])
        if not m:
            break
        found = m[0]
        if found == "<!--":
            end = page.find("-->", m.end())
            at = n if end < 0 else end + 3
            continue
        if found == "<![CDATA[":
            end = page.find("]]>", m.end())
            at = n if end < 0 else end + 3
            continue
        if not m[2]:
            end = page.find(">", m.end())
            at = n if end < 0 else end + 1
            continue
        tag, end = m[2].lower(), _tag_end(page, m.end())
        attributes = page[m.end() : end]
        at = end + 1
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            if m[1] or not _boilerplate(tag, attributes, depth["main"] > 0):
                if not m[1] or not open_ or open_[-1] not in ((tag, "boilerplate"), (tag, "sealed")):
                    continue
        close_block()
        if m[1]:
            stream.append("/" + tag)
            if n_open[tag]:  # else a stray closing tag
                name = None
                while name != tag:
                    name, what = open_.pop()
                    n_open[name] -= 1
                    if what:
                        depth[what] -= 1
                        if what != "hidden":
                            zones.pop()
            continue
        stream.append(tag)
        if tag in VOID or attributes.endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else n
            continue
        if tag == "p" and open_ and open_[-1] == ("p", None):
            open_.pop()
            n_open["p"] -= 1
        what = (
            "hidden"
            if tag in HIDDEN
            else "main"
            if tag in MAIN or 'role="main"' in attributes
            else _boilerplate(tag, attributes, depth["main"] > 0)
        )
        if tag == "body":  # an unclosed head ends here
            for _, kind in open_:
                if kind:
                    depth[kind] -= 1
            open_.clear()
            zones.clear()
            n_open.clear()
        open_.append((tag, what))
        n_open[tag] += 1
        if what:
            depth[what] += 1
            if what != "hidden":
                zones.append(what)
    if not depth["hidden"]:
        close_block()
    least = min((x for x in levels if x >= 0), default=0)
    for block, level in zip(blocks, levels, strict=True):
        if level > least:
            block.zone = "boilerplate"
    return blocks, stream


def pack_page(blocks: list[Block], stream: list) -> bytes:
    """A parsed page as lines: ``<`` and a tag name, or zone and text of a block."""
    block = iter(blocks)
    lines = []
    for item in stream:
        if isinstance(item, list):
            b = next(block)
            lines.append(ZONES[b.zone] + b.text)
        else:
            lines.append("<" + item)
    return "\n".join(lines).encode()


def blocks_of(packed: bytes) -> list[Block]:
    lines = packed.decode().split("\n") if packed else ()
    return [Block(line[1:], ZONE_OF[line[0]]) for line in lines if line[0] != "<"]


def run_ranks(tokens: np.ndarray, run: int) -> np.ndarray:
    """Rank of each suffix by its first ``run`` tokens, by prefix doubling."""
    n = len(tokens)
    rank, have = np.unique(tokens, return_inverse=True)[1], 1
    while have < run:  # rank of the first ``have`` tokens -> of twice as many
        step = min(have, run - have)
        after = np.zeros(n, dtype=np.int64)
        after[:-step] = rank[step:] + 1 if n > step else 0
        _, rank = np.unique(rank * (int(after.max()) + 1) + after, return_inverse=True)
        have += step
    return rank


def cover_of(starts: np.ndarray, run: int) -> np.ndarray:
    """Which tokens lie in a run that begins where ``starts`` says."""
    cover = np.zeros(len(starts) + run + 1, dtype=np.int32)
    at = np.flatnonzero(starts)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + run, -1)
    return np.cumsum(cover)[: len(starts)] > 0


def repeated(tokens: np.ndarray, page_of: np.ndarray, run: int = MIN_RUN, pages: int = 2) -> np.ndarray:
    """Which tokens lie in a substring of ``run`` tokens that starts on
    ``pages`` distinct pages. Tokens are numbers; each page ends with a number
    of its own."""
    if len(tokens) == 0:
        return np.zeros(0, dtype=bool)
    rank = run_ranks(tokens, run)
    return cover_of((document_counts(rank, page_of) >= pages)[rank], run)


def document_counts(runs: np.ndarray, page_of: np.ndarray) -> np.ndarray:
    """For each run number: on how many distinct pages it starts."""
    if not len(runs):
        return np.zeros(0, dtype=np.int64)
    width = int(page_of.max()) + 1
    pairs = np.unique(runs * width + page_of)
    return np.bincount(pairs // width, minlength=int(runs.max()) + 1)


def unnamed(pages: int) -> int:
    """The most pages that may have a run which a group of ``pages`` distinct
    pages does not name: less than ``SHARE`` of them, about half of that."""
    share = SHARE * pages
    return max(math.ceil(share / 2) - 1, min(1, math.ceil(share) - 1), 0)


def needed(pages: np.ndarray) -> np.ndarray:
    """Distinct pages that a repeated run has, on hosts of so many."""
    return np.maximum(MIN_PAGES, np.ceil(SHARE * pages)).astype(np.int64)


class Group:
    """The streams of a group of packed pages, end to end, as numbers."""

    def __init__(self, pages: list[bytes]):
        raw = b"".join(x + b"\n" for x in pages if x)
        data = np.frombuffer(raw, dtype=np.uint8)
        page_ends = np.cumsum([len(x) + 1 if x else 0 for x in pages], dtype=np.int64)
        ends = np.flatnonzero((data == 32) | (data == 10))
        starts = np.concatenate([np.zeros(1, dtype=np.int64), ends + 1])[: len(ends)]
        heads = np.concatenate([np.ones(1, dtype=bool), data[ends] == 10])[: len(ends)]  # first token of a line
        tag_line = data[starts] == ord("<")
        line = np.cumsum(heads) - 1
        is_tag = tag_line[heads][line] if len(ends) else tag_line
        begins_block = heads & ~is_tag
        block = np.where(is_tag, -1, np.cumsum(begins_block) - 1)
        starts = starts + begins_block  # behind the letter of the zone
        of_token = hash_runs(data, starts, ends)
        of_token[is_tag] = ~of_token[is_tag]
        known, numbers = np.unique(of_token, return_inverse=True)
        # a token of its own ends each page
        last = np.searchsorted(ends, page_ends, side="left")
        self.sizes = np.diff(last, prepend=0) + 1
        self.n_blocks = int(begins_block.sum())
        self.per_page = np.diff(np.concatenate([[0], np.cumsum(begins_block)])[last], prepend=0)
        self.tokens = np.insert(numbers.astype(np.int64), last, len(known) + np.arange(len(pages)))
        self.hash_of = known
        self.block = np.insert(block.astype(np.int64), last, -1)

    def of_tokens(self, of_pages: np.ndarray) -> np.ndarray:
        return np.repeat(of_pages, self.sizes)

    def shares(self, starts: np.ndarray, run: int) -> list[np.ndarray]:
        """For each page: share of each block's words that lie in runs at ``starts``."""
        if not len(self.per_page):
            return []
        cover = cover_of(starts, run)
        words = self.block >= 0
        total = np.bincount(self.block[words], minlength=self.n_blocks)
        share = np.bincount(self.block[words], weights=cover[words], minlength=self.n_blocks) / np.maximum(total, 1)
        return np.split(share, np.cumsum(self.per_page)[:-1])

    def places(self, run: int) -> np.ndarray:
        """Where runs start that hold a word and end within their page."""
        n = len(self.tokens) - run + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64)
        page_end = self.of_tokens(np.cumsum(self.sizes) - 1)  # where its last token stands
        before = np.concatenate([[0], np.cumsum(self.block >= 0)])
        at = np.arange(n)
        return at[(at + run <= page_end[:n]) & (before[run:] > before[:-run])]

    def runs(self, hosts: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``places``, a number of each one's host and run, and for each number a place."""
        at = self.places(run)
        if not len(at):
            return at, at, at
        of_host = np.unique(hosts, return_inverse=True)[1]
        rank = run_ranks(self.tokens, run)[at] * (int(of_host.max()) + 1) + self.of_tokens(of_host)[at]
        _, first, number = np.unique(rank, return_index=True, return_inverse=True)
        return at, number, at[first]

    def hashes(self, at: np.ndarray, run: int) -> np.ndarray:
        """A hash of the run at each place."""
        out = np.zeros(len(at), dtype=np.uint64)
        for j in range(run):
            out += self.hash_of[self.tokens[at + j]] * POSITION_WEIGHT[j + 17]
        return mix(out)


def covered_shares(group: Group, hosts: np.ndarray, contents: np.ndarray, run: int) -> list[np.ndarray]:
    """``shares`` of the runs that repeat, for pages of hosts that are whole in the group."""
    at, number, first = group.runs(hosts, run)
    starts = np.zeros(len(group.tokens), dtype=bool)
    if len(at):
        page_host, host_number = np.unique(hosts, return_inverse=True)
        pair = np.unique(np.stack([host_number, contents]), axis=1)
        least = needed(np.bincount(pair[0], minlength=len(page_host)))
        counts = document_counts(number, group.of_tokens(contents)[at])
        starts[at] = (counts >= least[group.of_tokens(host_number)[first]])[number]
    return group.shares(starts, run)


def covered_blocks(streams: list[list], run: int = MIN_RUN) -> list[np.ndarray]:
    """For pages of one host: share of each block's words that is covered."""
    pages = ["\n".join("O" + " ".join(x) if isinstance(x, list) else "<" + x for x in stream).encode() for stream in streams]
    seen: dict[bytes, int] = {}
    contents = [seen.setdefault(page, len(seen)) for page in pages]
    return covered_shares(Group(pages), np.zeros(len(pages), dtype=np.int64), np.array(contents, dtype=np.int64), run)


def main_text(blocks: list[Block], share: np.ndarray) -> tuple[str, int, int]:
    """Text that stays, blocks that repetition covers, and those of them that
    the structural check kept."""
    declared = any(b.zone == "main" for b in blocks)
    kept = []
    covered = restored = 0
    for b, s in zip(blocks, share.tolist(), strict=True):
        gone = s >= COVERED
        covered += gone
        if b.zone == "main":
            kept.append(b.text)
            restored += gone
        elif b.zone == "open" and not declared and not gone:
            kept.append(b.text)
    return "\n".join(kept), covered, restored


def read_group(pages: pa.Table) -> tuple[list[bytes], Group, np.ndarray, np.ndarray]:
    """Packed pages, their streams, hosts and a number of the content of each page."""
    packed = zip(pages.column("packed").to_pylist(), pages.column("n").to_pylist(), strict=True)
    read = [pa.decompress(x, n, codec="zstd", asbytes=True) if n else b"" for x, n in packed]
    hosts = pages.column("host").to_numpy()
    contents = np.unique(pages.column("content").to_numpy(), return_inverse=True)[1]
    return read, Group(read), hosts, contents


def texts(pages: pa.Table, packed: list[bytes], shares: list[np.ndarray]) -> pa.Table:
    out = [main_text(blocks_of(x), share) for x, share in zip(packed, shares, strict=True)]
    return pa.table(
        {
            "id": pages.column("id"),
            "url": pages.column("url"),
            "text": pa.array([t for t, _, _ in out], type=pa.string()),
            "n_covered": pa.array([c for _, c, _ in out], type=pa.int32()),
            "n_restored": pa.array([r for _, _, r in out], type=pa.int32()),
        }
    )


def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``html`` of each page replaced by its packed blocks and stream, and their length."""
    for batch in batches:
        packed = [pack_page(*read_page(x or "")) for x in batch.column("html").to_pylist()]
        kept = [name for name in batch.schema.names if name != "html"]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(name) for name in kept],
                pa.array([pa.compress(x, codec="zstd", asbytes=True) if x else b"" for x in packed], type=pa.binary()),
                pa.array([len(x) for x in packed], type=pa.int64()),
            ],
            names=[*kept, "packed", "n"],
        )


def beside(rows: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with the columns of a stored table, broadcast only if it is short."""
    return rows.join(F.broadcast(small) if small.count() <= MAX_BROADCAST else small, on, "left")


def dealt(pages: DataFrame, id_col: str, url_col: str, html_col: str, group_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The pages with their group's ``key``, and the large hosts. ``chunks`` is
    null on pages of small hosts; a page with ``extra`` is a spread copy."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.col(html_col).alias("html"),
        F.xxhash64(host_of(F.col(url_col))).alias("host"),
        F.xxhash64(F.regexp_replace(html, "<[^<>]*>", "<>")).alias("content"),
        row_number(pages).alias("row"),
    )
    size = F.coalesce(F.octet_length("html"), F.lit(0)) + F.lit(PAGE_COST)
    contents = stored(rows.groupBy("host", "content").agg(F.sum(size).alias("bytes"), F.min("row").alias("first")), "page-contents")
    bins = -(-(contents.agg(F.sum("bytes")).first()[0] or 0) // group_bytes) or 1
    share = lambda total: F.ceil(total / F.lit(group_bytes))
    hosts = contents.groupBy("host").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("pages"))
    hosts = stored(hosts.where(F.col("bytes") > group_bytes).select("host", "pages", share(F.col("bytes")).alias("chunks")), "page-hosts")
    copies = contents.where(F.col("bytes") > group_bytes).select("host", "content", "first", share(F.col("bytes")).alias("spread"))
    copies = stored(copies, "page-copies")
    placed = beside(beside(rows, hosts.select("host", "chunks"), ["host"]), copies, ["host", "content"])
    # the first copy counts and lies with the other pages
    extra = F.when(F.col("first") != F.col("row"), F.pmod(F.xxhash64("row"), F.col("spread")) + 1).otherwise(F.lit(0))
    key = F.when(F.col("chunks").isNull(), F.xxhash64(F.pmod("host", F.lit(bins)))).otherwise(
        F.xxhash64("host", F.pmod("content", F.col("chunks")), extra)
    )
    return placed.select("id", "url", "html", "host", "content", "chunks", (extra > 0).alias("extra"), key.alias("key")), hosts


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    run: int = MIN_RUN,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """One row per page: ``<id_col>, <url_col>, text``, and the numbers of
    blocks that repetition covered (``n_covered``) and that the check kept all
    the same (``n_restored``)."""
    placed, hosts = dealt(pages, id_col, url_col, html_col, group_bytes)
    id_type = placed.schema["id"].dataType.simpleString()
    parsed = f"id {id_type}, url string, host bigint, content bigint, extra boolean, key bigint, packed binary, n bigint"
    schema = f"id {id_type}, url string, text string, n_covered int, n_restored int"
    small = placed.where("chunks is null").drop("chunks").mapInArrow(parse, parsed)
    large = placed.where("chunks is not null").drop("chunks").mapInArrow(parse, parsed)

    def whole(group_pages: pa.Table) -> pa.Table:
        packed, group, page_hosts, contents = read_group(group_pages)
        return texts(group_pages, packed, covered_shares(group, page_hosts, contents, run))

    def counted(group_pages: pa.Table) -> tuple[Group, np.ndarray, np.ndarray, np.ndarray]:
        """The group of the pages that count, their hosts, and each run's place and count."""
        mine = group_pages.filter(pc.invert(group_pages.column("extra")))
        _, group, page_hosts, contents = read_group(mine)
        at, number, first = group.runs(page_hosts, run)
        return group, page_hosts, first, document_counts(number, group.of_tokens(contents)[at] if len(at) else at)

    def runs_table(key: int, run_hosts: np.ndarray, hashes: np.ndarray, counts: np.ndarray, most: int = 0) -> pa.Table:
        columns = [np.full(len(counts), key, dtype=np.int64), run_hosts, hashes.view(np.int64), counts.astype(np.int64)]
        columns.append(np.full(len(counts), most, dtype=np.int64))
        return pa.table([pa.array(x) for x in columns], names=["key", "host", "run", "n", "most"])

    def named(group_pages: pa.Table) -> pa.Table:
        """The runs of more than ``most`` pages of the group; and one row without a run."""
        key, host = (group_pages.column(c)[0].as_py() for c in ("key", "host"))
        group, page_hosts, first, counts = counted(group_pages)
        most = unnamed(len(pc.unique(group_pages.filter(pc.invert(group_pages.column("extra"))).column("content"))))
        own = pa.table({"key": [key], "host": [host], "run": pa.nulls(1, pa.int64()), "n": pa.nulls(1, pa.int64()), "most": [most]})
        often = counts > most
        first, counts = first[often], counts[often]
        return pa.concat_tables([own, runs_table(key, group.of_tokens(page_hosts)[first], group.hashes(first, run), counts, most)])

    def recounted(group_pages: pa.Table, asked: pa.Table) -> pa.Table:
        """How many of the group's pages have each run that is asked for."""
        if not asked.num_rows or not group_pages.num_rows:
            return runs_table(0, *[np.zeros(0, dtype=np.int64)] * 3)
        group, page_hosts, first, counts = counted(group_pages)
        hashes = group.hashes(first, run)
        mine = np.isin(hashes.view(np.int64), asked.column("run").to_numpy())
        return runs_table(0, group.of_tokens(page_hosts)[first[mine]], hashes[mine], counts[mine])

    def judged(group_pages: pa.Table, repeats: pa.Table) -> pa.Table:
        packed, group, _, _ = read_group(group_pages)
        starts = np.zeros(len(group.tokens), dtype=bool)
        if repeats.num_rows:
            at = group.places(run)
            starts[at] = np.isin(group.hashes(at, run).view(np.int64), repeats.column("run").to_numpy())
        return texts(group_pages, packed, group.shares(starts, run))

    found = small.groupBy("key").applyInArrow(whole, schema)
    if not hosts.isEmpty():
        numbers = "key bigint, host bigint, run bigint, n bigint, most bigint"
        names = stored(large.groupBy("key").applyInArrow(named, numbers), "page-runs")
        groups = names.where("run is null").select("key", "host")
        least = F.greatest(F.lit(MIN_PAGES), F.ceil(F.lit(SHARE) * F.col("pages")))
        # a run is on as many pages as were named, and at most ``most`` more for each group that does not name it
        silent = names.where("run is null").groupBy("host").agg(F.sum("most").alias("silent")).join(hosts, "host")
        sums = names.where("run is not null").groupBy("host", "run").agg(F.sum("n").alias("n"), F.sum("most").alias("most"))
        sums = sums.join(silent, "host").where(F.col("n") + F.col("silent") - F.col("most") >= least)
        sums = stored(sums.select("host", "run", (F.col("n") >= least).alias("repeats")), "page-run-sums")
        repeats, left = sums.where("repeats").select("host", "run"), sums.where("not repeats").select("host", "run")
        if not left.isEmpty():
            asked = left.join(groups, "host").select("key", "run")
            again = large.groupBy("key").cogroup(asked.groupBy("key")).applyInArrow(recounted, numbers)
            again = again.groupBy("host", "run").agg(F.sum("n").alias("n")).join(hosts, "host").where(F.col("n") >= least)
            repeats = repeats.union(again.select("host", "run").join(left, ["host", "run"], "left_semi"))
        told = repeats.join(groups, "host").select("key", "run")
        found = found.union(large.groupBy("key").cogroup(told.groupBy("key")).applyInArrow(judged, schema))
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_covered", "n_restored")
