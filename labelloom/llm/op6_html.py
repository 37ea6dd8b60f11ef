"""Main text of web pages: markup says what it can, a suffix array over the pages of a host decides the rest.

Blocks inside an article (or else main) element are the text; blocks in menus, headers, footers, sidebars, notices, adverts, forms and comments,
by element, role or class, are not, wherever they stand. Where only a part of a class points that way (``related-work``, ``share-alike``), markup does not decide.
What stands outside the article, or in such an element, is a page's token stream, and on a page without article or main so is all that markup does not exclude.
A run of ``RUN`` words that stands on distinct pages of a host is a repeated run. Covered words are boilerplate; what markup leaves open is text as far as it is
uncovered. Words of an article are never dropped because other pages have them too: mirrors and quotations stay.

Repetition is settled over whole hosts: the streams of the pages of a host in one batch are concatenated and their suffixes sorted by their first ``RUN`` words,
so each run goes out once a batch, as its digest (128 bits, of host and words) with the least and greatest digest of its pages; the runs for which
these differ over all batches are joined back to the pages that hold them. No task gets a host, and no key more than a row for each batch.

Equal pages count as one page. Null html: empty text. Null url, or one without host: grouped under the empty host. Repeated rows get equal results.
"""
from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from labelloom.llm.common import arrow, column

RUN = 8
#: Pages that are parsed at once; bounds the temporaries of a task.
PART = 500

#: What markup names as other than the main text.
DROPPED = frozenset("head nav header footer aside form menu button select option dialog iframe object template noscript label fieldset datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NAMED = frozenset("""ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent notice notices sidebar
    menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments respond share sharing social related newsletter subscribe
    subscription popup modal overlay widget toolbar pagination pager""".split())
#: Words that say nothing of their own beside one of these in a class: comment-list, ad-slot-2, sidebar-left.
PLAIN = frozenset("""area bar block body bottom box btn button buttons center col column container content cta entry feed field fixed form global group head icon icons id inner
    item items js label layout left link links list local lower main meta middle mobile module new outer page panel post primary right row secondary section site slot small sticky
    sub text thread title top ui unit upper wrap wrapper""".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(script|style|textarea|svg|math|xmp|noembed)\b[^>]*+>.*?(?:</\1\s*>|\Z)|<(/?)([a-z][a-z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>"""
                   r"""|<[!?/a-z][^>]*+(?:>|\Z)|([^<]++|<)""", re.S | re.I)
ATTRIBUTE = re.compile(r"""([a-z-]+)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))|(?<![\w-])(hidden)(?![\w-])""", re.I)
SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")


#: What markup says of an element: nothing, that it may be other than the main text, that it is.
FREE, UNSURE, OUT = 0, 1, 2


def named(word: str) -> int:
    """What a word of a class or id says: it decides if it is, or ends in, a known one, or has only plain words beside it."""
    parts = [x.lower() for x in SPLIT.split(word) if x]
    if NAMED.isdisjoint(parts):
        return FREE
    return OUT if parts[-1] in NAMED or all(x in NAMED or x in PLAIN or x.isdigit() for x in parts) else UNSURE


def excluded(tag: str, attributes: str) -> int:
    if tag in DROPPED:
        return OUT
    if not attributes or attributes.isspace():
        return FREE
    found = FREE
    for name, a, b, c, hidden in ATTRIBUTE.findall(attributes):
        value = a or b or c
        name = name.lower()
        if hidden or name == "role" and value.lower() in ROLES or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return OUT
        if name in ("class", "id"):
            # an article goes only by a whole word of its class (a reader's comment), not by a part of one (share-alike)
            for word in value.split():
                found = max(found, named(word) if tag not in ("article", "main") else OUT if word.lower() in NAMED else FREE)
    return found


def blocks(source: str) -> list[tuple[str, int, str]]:
    """(text, FREE, UNSURE or OUT, "article", "main" or "") of each block in page order."""
    out: list[tuple[str, int, str]] = []
    held: list[str] = []
    stack: list[tuple[str, int, str]] = []  # open elements that are no inline ones
    open_count: dict[str, int] = {}
    out_of, where = FREE, ""

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((text, out_of, where))

    for m in TOKEN.finditer(source):
        if (text := m[5]) is not None:
            held.append(text)
            continue
        if m[3] is None:
            if m[1] is not None:
                held.append(" ")
            continue
        tag = m[3].lower()
        if tag in INLINE:
            continue
        if tag in VOID:
            held.append(" ")
            continue
        flush()
        if tag in ("p", "li", "html", "tr", "td", "th", "dt", "dd") or tag[0] == "h" and tag[1:].isdigit():
            if m[2] or not excluded(tag, m[4]):  # often left open: they break blocks, nothing more
                if not m[2] or not open_count.get(tag):
                    continue
        if tag == "body" and not m[2]:
            stack.clear()
            open_count.clear()
        if not m[2]:
            if m[4].endswith("/"):
                continue
            out_of = max(stack[-1][1] if stack else FREE, excluded(tag, m[4]))
            where = tag if tag in ("article", "main") and where != "article" else (stack[-1][2] if stack else "")
            stack.append((tag, out_of, where))
            open_count[tag] = open_count.get(tag, 0) + 1
        elif open_count.get(tag):
            while True:
                top = stack.pop()[0]
                open_count[top] -= 1
                if top == tag:
                    break
        _, out_of, where = stack[-1] if stack else ("", FREE, "")
    flush()
    return out


#: What becomes of a block: never text, text as far as it is not repeated, text.
NEVER, MAY, TEXT = 0, 1, 2


def parted(source: str) -> tuple[str | None, list[str], list[int]]:
    """The text if markup alone names it (else None), and the blocks, in page order, with what becomes of them; those that are no TEXT are the token stream."""
    some = blocks(source)
    kinds = {w for _, drop, w in some if w and drop == FREE}
    if not kinds:
        if re.search(r"<article\b|<main\b", source, re.I) and all(drop == OUT for _, drop, _ in some):
            return "", [t for t, _, _ in some], [NEVER] * len(some)
        return None, [t for t, _, _ in some], [NEVER if drop == OUT else MAY for _, drop, _ in some]
    inside = {"article"} if "article" in kinds else {"main", "article"}
    fates = [NEVER if drop == OUT or w not in inside else MAY if drop == UNSURE else TEXT for _, drop, w in some]
    if MAY in fates:
        return None, [t for t, _, _ in some], fates
    return " ".join(t for (t, _, _), fate in zip(some, fates) if fate == TEXT), [t for (t, _, _), fate in zip(some, fates) if fate == NEVER], [NEVER] * fates.count(NEVER)


def stream(side: list[str], fates: list[int]) -> list[str]:
    """The words whose repetition counts."""
    return [w for b, fate in zip(side, fates) if fate != TEXT for w in b.split(" ")]


def runs(streams: list[list[str]], run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of ``run`` words begin in the joined streams, equal ones side by side, and the first of each kind among these."""
    sizes = np.array([len(s) for s in streams], np.int64)
    owner = np.repeat(np.arange(len(streams)), sizes)
    n = len(owner)
    numbers: dict[str, int] = {}
    rank = np.array([numbers.setdefault(w, len(numbers)) for s in streams for w in s], np.int64)
    last = np.cumsum(sizes)[owner]  # no suffix reaches over the end of its stream
    length = 1
    while length < run:  # ranks of the first words, twice as many each time
        step = min(length, run - length)
        at = np.arange(n) + step
        inside = at < last
        pair = (rank + 1) * (n + 2)
        pair[inside] += rank[at[inside]] + 1
        _, rank = np.unique(pair, return_inverse=True)
        length += step
    whole = np.flatnonzero(np.arange(n) + run <= last)
    order = whole[np.argsort(rank[whole], kind="stable")]  # the suffix array, as far as it is needed
    group = rank[order]
    return order, np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(order) else np.zeros(0, int)


def over(begins: np.ndarray, n: int, run: int = RUN) -> np.ndarray:
    """Which of ``n`` words stand in a run that begins at one of ``begins``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, begins, 1)
    np.add.at(edge, begins + run, -1)
    return np.cumsum(edge)[:n] > 0


def covered(streams: list[list[str]], page: list[int], run: int = RUN) -> list[np.ndarray]:
    """For each stream which words belong to a run of ``run`` words or more that stands on distinct pages."""
    sizes = np.array([len(s) for s in streams])
    order, starts = runs(streams, run)
    if not len(starts):
        return [np.zeros(n, bool) for n in sizes]
    pages = np.repeat(np.array(page), sizes)[order]
    low, high = np.minimum.reduceat(pages, starts), np.maximum.reduceat(pages, starts)
    flags = over(order[np.repeat(low != high, np.diff(np.append(starts, len(order))))], int(sizes.sum()), run)
    return np.split(flags, np.cumsum(sizes)[:-1])


def digest(host: str, words: list[str]) -> tuple[int, int]:
    """128 bits of a run of words on a host, as two signed longs."""
    raw = np.frombuffer(xxhash.xxh3_128_digest(f"{host}\n{' '.join(words)}".encode()), np.int64)
    return int(raw[0]), int(raw[1])


def kinds_of(host: str, streams: list[list[str]], same: list[int], key: list[int], run: int) -> Iterator[tuple[int, int, int, int, list[int]]]:
    """(a, b, lo, hi, keys) of each kind of run: its digest, the least and greatest digest of its pages, and their keys."""
    order, starts = runs(streams, run)
    if not len(starts):
        return
    words = [w for s in streams for w in s]
    owner = np.repeat(np.arange(len(streams)), [len(s) for s in streams])[order]
    pages, keys = np.array(same, np.int64)[owner], np.array(key, np.int64)[owner]
    low, high = np.minimum.reduceat(pages, starts), np.maximum.reduceat(pages, starts)
    for at, some, lo, hi in zip(order[starts].tolist(), np.split(keys, starts[1:]), low.tolist(), high.tolist()):
        yield *digest(host, words[at:at + run]), lo, hi, np.unique(some).tolist()


def settled(host: str, text: str | None, side: list[str], fates: list[int], repeated: list[int] | None, run: int) -> tuple[str, int, int]:
    """Text, n_side and n_boilerplate of a page, from the first halves of the digests of those of its runs that are repeated."""
    words = stream(side, fates)
    flags = np.zeros(len(words), bool)
    if repeated:
        known = set(repeated)
        flags = over(np.array([i for i in range(len(words) - run + 1) if digest(host, words[i:i + run])[0] in known], np.int64), len(words), run)
    if text is None:
        at, kept = 0, []
        for block, fate in zip(side, fates):
            if fate == TEXT:
                kept.append(block)
                continue
            n = block.count(" ") + 1
            if fate == MAY:
                kept += [w for w, f in zip(words[at:at + n], flags[at:at + n]) if not f]
            at += n
        text = " ".join(kept)
    return text, len(words), int(flags.sum())


def extract(pages: DataFrame, run: int = RUN) -> DataFrame:
    """page_id, url, text, n_chars, n_side (words outside the text) and n_boilerplate (of these, repeated on other pages)."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    ids = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kinds["page_id"]]
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select("page_id", "url", "html", host.alias("host"), F.xxhash64(F.coalesce("html", F.lit(""))).alias("same"), F.xxhash64("page_id", "url", "html").alias("key"))

    def parts(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, PART):
                part = batch.slice(low, PART)
                yield part, [parted(x or "") for x in column(part, "html").to_pylist()]

    def windows(batches):
        for part, found in parts(batches):
            held: dict[str, list[tuple]] = {}
            for h, same, key, (_, side, fates) in zip(*[column(part, c).to_pylist() for c in ("host", "same", "key")], found):
                held.setdefault(h, []).append((stream(side, fates), same, key))
            if out := [x for h, some in held.items() for x in kinds_of(h, *map(list, zip(*some)), run)]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [*[pa.int64()] * 4, pa.list_(pa.int64())])], names=["a", "b", "lo", "hi", "keys"])

    def parse(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for part, found in parts(batches):
            yield pa.RecordBatch.from_arrays([*[column(part, c) for c in ("page_id", "url", "host", "key")], pa.array([pack.compress(json.dumps(f, ensure_ascii=False).encode()) for f in found], pa.binary())], names=["page_id", "url", "host", "key", "parsed"])

    def settle(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for low in range(0, batch.num_rows, PART):
                part = batch.slice(low, PART)
                out = [settled(h, *json.loads(unpack.decompress(p)), r, run) for h, p, r in zip(*[column(part, c).to_pylist() for c in ("host", "parsed", "repeated")])]
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([column(part, "page_id").cast(ids), column(part, "url"), pa.array(cols[0], pa.string()), pa.array([len(x) for x in cols[0]], pa.int64()), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                                                 names=["page_id", "url", "text", "n_chars", "n_side", "n_boilerplate"])

    seen = arrow(rows.select("html", "host", "same", "key"), windows, "a long, b long, lo long, hi long, keys array<long>")
    repeated = seen.groupBy("a", "b").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo <> hi").select("a", "b")
    back = seen.select("a", "b", "keys").join(repeated, ["a", "b"], "left_semi").select("a", F.explode("keys").alias("key")).groupBy("key").agg(F.collect_set("a").alias("repeated"))
    parsed = arrow(rows.select("page_id", "url", "html", "host", "key"), parse, f"page_id {kinds['page_id']}, url {kinds['url']}, host string, key long, parsed binary")
    return arrow(parsed.join(back, "key", "left").select("page_id", "url", "host", "parsed", "repeated"), settle, f"page_id {kinds['page_id']}, url string, text string, n_chars long, n_side long, n_boilerplate long")
