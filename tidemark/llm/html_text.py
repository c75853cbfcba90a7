"""Main text of web pages by a suffix array of each host.

A page is cut into blocks, in page order. Elements rule blocks out (scripts, menus,
forms, adverts, comments) and may declare a main region. What then is text goes by the
host: the word streams of its distinct pages are laid end to end, their suffixes are
sorted, and neighbours with a common prefix of `depth` words or more are repeats. Runs
that repeats cover on enough of the host's pages are boilerplate; unique runs stay.

A host is split into parts of a bounded size, each with a suffix array of its own. A run
that stands on a share of all pages stands on that share of one part's pages at least, so
the parts name the candidates, and one more pass counts these exactly.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SLICE_ROWS, runs, staged

#: Elements whose content is no text of the page: to its end if they aren't closed, or
#: only if they are closed and don't close themselves.
TO_THE_END = frozenset("script style".split())
IF_CLOSED = frozenset("noscript template svg math iframe object canvas audio video textarea select title".split())
#: Quotes enclose a value only after a sign of equality.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^<>=]|=\s*+(?:"[^"]*"|'[^']*'|[^\s<>"'][^\s<>]*+)?+)*+)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never main text.
OUT = frozenset("head nav footer aside form menu dialog button fieldset label input".split())
MAIN = frozenset(("article", "main"))
ROLES_OUT = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar note status".split())
#: Words of class and id names that mark what is no main text.
NAMES_OUT = frozenset(
    "ad ads advert adverts advertisement adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert warning "
    "sidebar sidebars menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments commentlist reply replies respond disqus discussion "
    "newsletter subscribe signup login share sharing social related recommended popup modal overlay toolbar pagination pager widget".split()
)
#: Words that may stand beside those above; beside others they only rule out at the end of a name.
NEUTRAL = frozenset(
    "area article articles bar block body bottom box button buttons card container content feed form foot group head header holder inline inner item items left links list "
    "main module outer page panel post posts primary right row secondary section site slot top unit user view wrap wrapper".split()
)
#: Words after which a name tells of a layout, not of the element itself.
LAYOUT = frozenset("with without has no layout".split())
#: Words of class and id names of elements that hold the main text where no article or main does.
NAMES_MAIN = frozenset("article articlebody content maincontent main post entry story".split())
COMMENTS = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def named_out(names: str, of: frozenset[str]) -> bool:
    """Whether class or id names mark what is no main text. A name counts if all its other
    words are neutral, or if it ends with such a word: cookie-notice, post-footer,
    sidebar-left, but neither layout-with-sidebar nor side-effects."""
    for name in names.split():
        words = [w.lower() for w in NAME.findall(name)]
        hits = [w in of for w in words]
        if any(hits) and LAYOUT.isdisjoint(words) and (hits[-1] or all(h or w in NEUTRAL for h, w in zip(hits, words, strict=True))):
            return True
    return False


def is_out(tag: str, rest: str, in_main: bool, by_name: bool = True, loose: bool = False) -> bool:
    """Whether an element and all in it are no main text. loose: an element that is named as
    main text as well is, but for comments, whatever its other names say."""
    if tag in OUT or tag == "header" and not in_main:
        return True
    if not rest or "=" not in rest and "hidden" not in rest:
        return False
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(rest)}
    if found.get("role", "").lower() in ROLES_OUT or found.get("aria-hidden") == "true" or re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", rest):
        return True
    if "display:none" in found.get("style", "").replace(" ", ""):
        return True
    if tag in ("html", "body") or not (by_name or in_main):
        return False
    return named_out(f"{found.get('class', '')} {found.get('id', '')}", COMMENTS if tag in MAIN or loose and is_named(tag, rest) else NAMES_OUT)


def is_named(tag: str, rest: str) -> bool:
    """Whether an element says by its role, class or id that it holds the main text."""
    if tag not in ("div", "section", "td") or "=" not in rest:
        return False
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(rest)}
    words = {w.lower() for w in NAME.findall(f"{found.get('class', '')} {found.get('id', '')}")}
    return found.get("role", "").lower() == "main" or found.get("itemprop", "") == "articleBody" or not words.isdisjoint(NAMES_MAIN)


def blocks_of(page: str | None) -> list[tuple[str, str]]:
    """(place, text) of the page's blocks in order: 'main', 'named', 'out' or 'open'.

    White space in a block is one space, character references are decoded, markup
    is gone. Unclosed elements end with the element around them, or the page. Where the
    only main regions lie in elements that their names rule out, the names don't count; where
    nothing else is left, elements named as main text count in spite of their other names, such as
    those of a layout (content sidebar-right)."""
    page = page or ""
    found = _blocks(page, True)
    if all(k == "out" for k, _ in found) and found:
        again = _blocks(page, True, True)
        found = again if any(k != "out" for k, _ in again) else found
    if not any(k == "main" for k, _ in found) and re.search(r"<(?:article|main)\b", page, re.I):
        again = _blocks(page, False)
        return again if any(k == "main" for k, _ in again) else found
    return found


def _blocks(page: str, by_name: bool, loose: bool = False) -> list[tuple[str, str]]:
    found: list[tuple[str, str]] = []
    text: list[str] = []
    out_tag, out_depth, main_depth, at, place = "", 0, 0, 0, "open"
    named_tag, named_depth = "", 0
    unclosed: set[str] = set()

    def close() -> None:
        if not text:
            return
        raw = text[0] if len(text) == 1 else "".join(text)
        text.clear()
        if words := " ".join((html.unescape(raw) if "&" in raw else raw).split()):
            found.append((place, words))

    search = MARKUP.search
    while m := search(page, at):
        begins, past = m.span()
        if begins > at:
            text.append(page[at:begins])
        at = past
        end, tag, _ = m.groups()
        if not tag:
            continue
        ends, tag = bool(end), tag.lower()
        if not ends and tag not in unclosed and (tag in TO_THE_END or tag in IF_CLOSED and not m["rest"].endswith("/")):
            if close_tag := re.compile(rf"</{tag}\s*>", re.I).search(page, at):
                at = close_tag.end()
            elif tag in TO_THE_END:
                at = len(page)
            else:
                unclosed.add(tag)  # not looked for again
            continue
        if tag in BLOCK or tag in OUT:
            close()
        if out_tag:
            if tag == out_tag:
                out_depth += -1 if ends else not m["rest"].endswith("/")
                if out_tag == "p" and not ends:  # a paragraph ends where the next begins
                    out_depth -= 1
                    out_depth = 0 if not is_out(tag, m["rest"], main_depth > 0, by_name, loose) else out_depth
            elif out_tag == "p" and tag in BLOCK and tag != "br":
                out_depth = 0
            elif ends and tag in ("body", "html") or ends and tag in MAIN and main_depth:
                out_depth = 0
            if out_depth > 0:
                continue
            out_tag = ""
            if ends and tag not in MAIN:
                place = "main" if main_depth else "named" if named_depth else "open"
                continue
        if ends:
            if tag in MAIN and main_depth:
                main_depth -= 1
            elif named_depth and tag == named_tag:
                named_depth -= 1
        elif tag not in VOID:
            if is_out(tag, m["rest"], main_depth > 0, by_name, loose):
                if not m["rest"].endswith("/"):
                    close()
                    out_tag, out_depth = tag, 1
            elif tag in MAIN:
                main_depth += 1
            elif named_depth:
                named_depth += tag == named_tag
            elif is_named(tag, m["rest"]):
                named_tag, named_depth = tag, 1
        place = "out" if out_tag else "main" if main_depth else "named" if named_depth else "open"
    text.append(page[at:])
    close()
    return found


# --- suffix arrays

#: Bytes of pages, and pages, that a part of a host holds about; bytes that it holds at most.
PART_BYTES, PART_PAGES, MOST_PART_BYTES = 1 << 20, 200, 16 << 20
#: Hosts of several parts, and bytes of repeats, that may be sent to every task.
MOST_HOSTS, MOST_BYTES = 500_000, 32 << 20
MIX = np.uint64(0xD6E8FEB86659FD93)


def suffix_array(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of streams of word codes laid end to end, each closed by a mark of its own.

    Returns (text, order, lcp): the text of ranked codes, the places of its suffixes in
    order, and how many words each suffix shares with the one before. Ranks double their
    reach; only suffixes that still tie are sorted again. The ranks of every reach stay,
    and neighbours are compared by them from the longest down."""
    n, marks = len(words) + len(sizes), np.cumsum(sizes + 1) - 1
    text = np.zeros(n, dtype=np.int64)
    inner = np.ones(n, dtype=bool)
    inner[marks] = False
    kinds, text[inner] = np.unique(words, return_inverse=True)
    text[marks] = len(kinds) + np.arange(len(sizes))
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    head = np.append(True, text[order][1:] != text[order][:-1])
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    levels, reach = [rank.astype(np.int32)], 1
    while True:
        # Slots of suffixes that tie: those whose neighbour in order has the same rank.
        own = rank[order]
        same = own[1:] == own[:-1]
        slots = np.flatnonzero(np.append(same, False) | np.append(False, same))
        if not len(slots):
            break
        tied = order[slots]
        key = rank[tied] * (n + 1) + rank[tied + reach]  # a tie goes on for `reach` words, so a mark or more follows
        by = np.argsort(key, kind="stable")
        order[slots], key = tied[by], key[by]
        head = np.append(True, key[1:] != key[:-1])
        rank = rank.copy()
        rank[order[slots]] = np.maximum.accumulate(np.where(head, slots, 0))
        levels.append(rank.astype(np.int32))
        reach *= 2
    lcp = np.zeros(n, dtype=np.int64)
    a, b = order[:-1], order[1:]
    for k in reversed(range(len(levels))):
        at = lcp[1:]
        lcp[1:] = at + np.where(levels[k][np.minimum(a + at, n - 1)] == levels[k][np.minimum(b + at, n - 1)], 1 << k, 0)
    return text, order, lcp


def window_keys(codes: np.ndarray, depth: int) -> np.ndarray:
    """One number for each run of `depth` words: keys of half as many words, put together."""
    n = len(codes) - depth + 1
    if n < 1:
        return np.zeros(0, np.int64)
    key, reach = codes.astype(np.uint64) * MIX, 1
    with np.errstate(over="ignore"):
        while reach < depth:
            step = min(reach, depth - reach)
            low = key[: len(key) - step]
            odd = np.uint64((int(MIX) * (2 * reach + 1)) & 0xFFFFFFFFFFFFFFFF)  # another one for every reach, so that halves can't change places
            key, reach = (low ^ (low >> np.uint64(31))) * odd + key[step:], reach + step
    return key.view(np.int64)


def repeats(streams: list[np.ndarray], depth: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, pages) of the runs of `depth` words that stand in `least` streams or more."""
    sizes = np.array([len(s) for s in streams], dtype=np.int64)
    if least < 2:  # nothing needs to repeat
        keys = np.concatenate([np.unique(window_keys(s, depth)) for s in streams] or [np.zeros(0, np.int64)])
        return np.unique(keys, return_counts=True)
    if not sizes.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, order, lcp = suffix_array(np.concatenate(streams), sizes)
    tied = np.append(lcp[1:] >= depth, False)
    held = tied | (lcp >= depth)  # suffixes in an interval of common prefixes of `depth` words
    group, place = np.cumsum(lcp < depth)[held], order[held]
    owner = np.repeat(np.arange(len(streams)), sizes + 1)[place]
    pairs = np.unique(group * len(streams) + owner) // max(len(streams), 1)
    found, pages = np.unique(pairs, return_counts=True)
    first = place[np.searchsorted(group, found)][pages >= least]
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    stream = np.searchsorted(starts, first, side="right") - 1
    keys = [window_keys(streams[s][p : p + depth], depth)[0] for s, p in zip(stream.tolist(), (first - starts[stream]).tolist(), strict=True)]
    return np.array(keys, dtype=np.int64), pages[pages >= least]


#: Bytes that word codes are computed from at once, and the base of their polynomials.
CODE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def powers() -> list[np.ndarray]:
    """Powers of BASE and of its inverse, for CODE_BYTES places and one more."""
    if not _powers:
        for x in (BASE, pow(BASE, -1, 1 << 64)):
            _powers.append(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(CODE_BYTES, x, np.uint64)])))
    return _powers


def pieces(raw: bytes) -> Iterator[bytes]:
    """A text of words in pieces of CODE_BYTES at most, cut between words; a word that is
    longer still is cut itself."""
    at = 0
    while len(raw) - at > CODE_BYTES:
        cut = raw.rfind(b" ", at, at + CODE_BYTES)
        yield raw[at : cut if cut > at else at + CODE_BYTES]
        at = cut + 1 if cut > at else at + CODE_BYTES
    if at < len(raw):
        yield raw[at:]


def word_codes(texts: list[str]) -> list[np.ndarray]:
    """For each text of words with one space between, the codes of its words: polynomials
    over their bytes, all read off one running sum."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    place, inverse = powers()
    found: list[list[np.ndarray]] = [[] for _ in raw]
    held: list[tuple[int, bytes]] = []

    def flush() -> None:
        line = b" ".join(x for _, x in held) + b" "
        values = np.frombuffer(line, dtype=np.uint8)
        with np.errstate(over="ignore"):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((values.astype(np.uint64) + np.uint64(1)) * place[: len(values)], dtype=np.uint64)])
            ends = np.flatnonzero(values == 32)
            starts = np.append(0, ends[:-1] + 1)
            code = (total[ends] - total[starts]) * inverse[starts]
            code = ((code ^ (code >> np.uint64(32))) * MIX) >> np.uint64(32)
        at = np.cumsum([0, *(x.count(b" ") + 1 for _, x in held)])
        for (i, _), a, b in zip(held, at[:-1], at[1:], strict=True):
            found[i].append(code[a:b].astype(np.uint32))
        held.clear()

    size = 0
    for i, x in enumerate(raw):
        for piece in pieces(x):
            if held and size + len(piece) + 1 > CODE_BYTES:
                flush()
                size = 0
            held.append((i, piece))
            size += len(piece) + 1
    if held:
        flush()
    return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.zeros(0, np.uint32) for x in found]


# --- what the host tells of a page


@dataclass(frozen=True)
class Limits:
    """Shares of a host's distinct pages, and pages, from which a run is boilerplate.

    repeated: where nothing on the page says what its main text is. wide: anywhere, a
    declared main region included."""

    depth: int = 8
    repeated: float = 0.02
    least: int = 2
    wide: float = 0.5
    least_wide: int = 5


def covered(keys: np.ndarray, known: np.ndarray, n: int, depth: int) -> np.ndarray:
    """Which of n words lie in a run whose key is known (sorted)."""
    edge = np.zeros(n + 1, dtype=np.int64)
    if len(known) and len(keys):
        at = np.flatnonzero(known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + depth, -1)
    return np.cumsum(edge[:-1]) > 0


def verdict(blocks: list[tuple[str, str]], sizes: list[int], repeated: np.ndarray, wide: np.ndarray, trust_main: bool) -> tuple[str, int, int]:
    """(text, words that repeats cover and that are not in it, words that only the repeats
    took out). sizes: words of each block.

    Blocks of a declared region stand or go whole: they go if wide runs cover half of
    their words. Of other blocks the words that repeats cover go. Runs that would take
    most of what there is away are no boilerplate: such a page is a copy of others, and
    stays as it is."""
    ends = np.cumsum([0, *sizes])
    kinds = [k for k, _ in blocks]
    region = next((k for k in ("main", "named") if k in kinds), "") if trust_main else ""
    mine = np.repeat(np.array([k == region if region else k != "out" for k in kinds], dtype=bool), sizes)
    kept = mine
    if len(repeated) and repeated.any():
        if region:
            goes = [2 * int(wide[a:b].sum()) >= b - a for a, b in zip(ends[:-1], ends[1:], strict=True)]
            stay = mine & ~np.repeat(goes, sizes)
            kept = stay if 2 * stay.sum() >= mine.sum() else mine
        else:
            kept = mine & ~wide
            unique = kept & ~repeated
            kept = unique if 5 * unique.sum() >= kept.sum() else kept
    texts = []
    for (_, t), a, b in zip(blocks, ends[:-1], ends[1:], strict=True):
        own = kept[a:b]
        if own.all():
            texts.append(t)
        elif own.any():
            texts.append(" ".join(w for w, k in zip(t.split(" "), own.tolist(), strict=True) if k))
    return " ".join(texts), int((repeated & ~kept).sum()), int((mine & ~kept).sum())


PAGE = ("host", "part", "key", "url", "page")


def with_repeats(rows: DataFrame, table: DataFrame, make: Callable, schema: T.StructType) -> DataFrame:
    """Run make()(batch, lookup) over slices of rows (host, part, key, url, page), lookup
    giving a host's arrays of keys from table (host, parts, repeated, wide: sorted arrays).

    A table of up to MOST_BYTES is sent to every task. A larger one meets the pages of
    each part by a shuffle, its row ahead of them."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    size = table.agg(F.sum(8 * (F.size("repeated") + F.size("wide")) + F.octet_length("host") + 64)).first()[0] or 0
    if size <= MOST_BYTES:
        arrays = lambda r: (np.array(r["repeated"], dtype=np.int64), np.array(r["wide"], dtype=np.int64))
        known = rows.sparkSession.sparkContext.broadcast({r["host"]: arrays(r) for r in table.collect()}) if size else None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            f, lookup = make(), (known.value if known else {})
            for batch in batches:
                for i in range(0, batch.num_rows, SLICE_ROWS):
                    yield f(batch.slice(i, SLICE_ROWS), lambda h: lookup.get(h, none))

        return rows.select(*PAGE).mapInArrow(run, schema)
    ahead = table.select(
        "host", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in PAGE[2:]], F.lit(0).alias("kind"), "repeated", "wide"
    )
    both = ahead.unionByName(rows.select(*PAGE, F.lit(1).alias("kind")), allowMissingColumns=True)

    def run_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, host, arrays = make(), None, none
        for batch in batches:
            kinds = batch.column(5).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(kinds)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(a, b - a)
                if len(part) and kinds[a] == 0:
                    last = part.slice(len(part) - 1)  # rows ahead of no pages are passed over
                    host, arrays = last.column(0)[0].as_py(), tuple(np.array(last.column(i)[0].as_py(), dtype=np.int64) for i in (6, 7))
                    continue
                for i in range(0, len(part), SLICE_ROWS):
                    yield f(part.slice(i, SLICE_ROWS), lambda h: arrays if h == host else none)  # noqa: B023

    return both.repartition("host", "part").sortWithinPartitions("host", "part", "kind").mapInArrow(run_sorted, schema)


def _read(batch: pa.RecordBatch) -> Iterator[tuple[list[tuple[str, str]], np.ndarray]]:
    """The blocks of each page, and the word codes of its stream."""
    blocks = [blocks_of(page) for page in batch.column(PAGE.index("page")).to_pylist()]
    return zip(blocks, word_codes([" ".join(t for _, t in own) for own in blocks]), strict=True)


def host_repeats(rows: DataFrame, limits: Limits) -> DataFrame:
    """(host, parts, repeated, wide): keys of the runs that are boilerplate on a host."""
    depth, share = limits.depth, limits.repeated

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(i, SLICE_ROWS)
                raw = [c.tobytes() for _, c in _read(part)]
                digest = np.array([xxhash.xxh64_intdigest(x) for x in raw], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(5), pa.array(digest), pa.array(raw, pa.binary())], names=["host", "part", "parts", "digest", "words"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, 2):
            pages = dict(zip(part.column("digest").to_pylist(), part.column("words").to_pylist(), strict=True))
            parts, n = part.column("parts")[0].as_py(), len(pages)
            least = max(limits.least if parts == 1 else 1, int(np.ceil(share * n - 1e-9)))
            keys, seen = repeats([np.frombuffer(x, dtype=np.uint32) for x in pages.values()], depth, least)
            key = pa.array([None, *keys.tolist()], pa.int64())  # the row without a key holds the part's pages
            yield pa.RecordBatch.from_arrays([pa.array([part.column("host")[0].as_py()] * len(key), pa.string()), pa.array([parts] * len(key), pa.int32()), key, pa.array([n, *seen.tolist()], pa.int64())], names=["host", "parts", "key", "n"])

    streams = rows.select(*PAGE, "parts").mapInArrow(stream, "host string, part int, parts int, digest long, words binary")
    found = staged(streams.repartition("host", "part").sortWithinPartitions("host", "part").mapInArrow(count, "host string, parts int, key long, n long"), "repeats")
    total = found.where("key is null").groupBy("host").agg(F.sum("n").alias("pages"))
    exact = found.where("key is not null and parts = 1").select("host", "parts", "key", "n")
    # A key that a part names may stand in others, too: all pages of its host count.
    named = found.where("key is not null and parts > 1").select("host", "parts", "key").distinct()
    table = named.groupBy("host", "parts").agg(F.array_sort(F.collect_list("key")).alias("repeated")).withColumn("wide", F.array().cast("array<long>"))
    if not table.isEmpty():
        table = staged(table, "named")

        def make():
            def f(batch: pa.RecordBatch, lookup: Callable) -> pa.RecordBatch:
                hosts, digests, keys = [], [], []
                for host, (_, codes) in zip(batch.column(0).to_pylist(), _read(batch), strict=True):
                    own, known = window_keys(codes, depth), lookup(host)[0]
                    own = np.unique(own[known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own]) if len(known) else own[:0]
                    hosts += [host] * len(own)
                    digests.append(np.full(len(own), xxhash.xxh64_intdigest(codes.tobytes()), dtype=np.uint64).view(np.int64))
                    keys.append(own)
                flat = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))
                return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), flat(digests), flat(keys)], names=["host", "digest", "key"])

            return f

        hits = with_repeats(rows.where("parts > 1"), table, make, T.StructType.fromDDL("host string, digest long, key long"))
        counted = hits.distinct().groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).join(table.select("host", "parts"), "host")
        exact = exact.unionByName(counted.select("host", "parts", "key", "n"))
    share_of = lambda x, least: F.col("n") >= F.greatest(F.lit(least), F.col("pages") * x)
    known = exact.join(total, "host").where(share_of(share, limits.least)).withColumn("far", share_of(limits.wide, limits.least_wide))
    # On average a page has w runs, and each of these stands on a share of all pages: a host has w / share at most.
    keys = lambda c: F.array_sort(F.collect_list(c))
    return known.groupBy("host", "parts").agg(keys(F.col("key")).alias("repeated"), keys(F.when(F.col("far"), F.col("key"))).alias("wide"))


def numbered(pages: DataFrame, key: str, url: str, page: str) -> DataFrame:
    """(host, part, parts, key, url, page) of every page row; equal pages of a host have the same part."""
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    rows = pages.select(host.alias("host"), F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).alias("page"))
    size, n = F.sum(F.octet_length("page")), F.count(F.lit(1))
    parts = F.greatest(F.ceil(size / MOST_PART_BYTES), F.least(F.ceil(size / PART_BYTES), F.floor(n / PART_PAGES)), F.lit(1))
    large = staged(rows.groupBy("host").agg(F.coalesce(parts, F.lit(1)).cast("int").alias("parts")).where("parts > 1"), "hosts")
    large = F.broadcast(large) if large.count() <= MOST_HOSTS else large
    parts = F.coalesce("parts", F.lit(1))
    return rows.join(large, "host", "left").select("host", F.pmod(F.xxhash64("page"), parts).cast("int").alias("part"), "key", "url", "page", parts.alias("parts"))


def extract_text(pages: DataFrame, limits: Limits | None = None, trust_main: bool = True, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: key, url, text, n_covered (words of the page that its host's repeats
    cover and that are not in the text), n_cut (words that the repeats alone took out of it).

    With trust_main, a declared main region (article, main, or else a container named
    so) is the text but for blocks that half of the host's pages have; without, and on
    pages that declare none, all repeats go. Null and empty pages have no text; repeated
    rows give repeated results and count as one page of their host; a null url is the host
    ''; an empty table gives none; other columns are not read.
    """
    limits = limits or Limits()
    rows = numbered(pages, key, url, page)
    table = staged(host_repeats(rows, limits), "boilerplate")
    schema = T.StructType([T.StructField(key, pages.schema[key].dataType), T.StructField(url, pages.schema[url].dataType), *T.StructType.fromDDL("text string, n_covered long, n_cut long").fields])

    def make():
        def f(batch: pa.RecordBatch, lookup: Callable) -> pa.RecordBatch:
            out = []
            for host, (blocks, codes) in zip(batch.column(0).to_pylist(), _read(batch), strict=True):
                keys = window_keys(codes, limits.depth)
                sizes = [t.count(" ") + 1 for _, t in blocks]
                out.append(verdict(blocks, sizes, *[covered(keys, x, len(codes), limits.depth) for x in lookup(host)], trust_main))
            kinds = (pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), *[pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]], names=schema.names)

        return f

    return with_repeats(rows, table, make, schema)
