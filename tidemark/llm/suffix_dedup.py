"""Repeated windows by a depth-limited radix sort of suffixes.

Bytes that a repeated string of ``DEPTH`` bytes covers are removed, where the string also starts in a
document with a smaller id. Suffixes are told apart by most-significant-digit passes over their first
``DEPTH`` bytes only; suffixes that are still together then start with the same string.

The digits are chosen so that few bytes move. First comes the window's leftmost 16-byte gram of least
hash, with its place in the window: equal windows share it, and neighbouring suffixes have it in
common, so an anchor with the windows that it stands for is sent once. The second digit is a hash of all
bytes of those windows; anchors that agree in it are settled together. Only where anchors share a gram
but differ in their bytes, at the borders of copies, the bytes themselves are sent, and the windows are
sorted by digits of 8 bytes, groups of one being dropped after each pass.

Documents are packed into blocks. A block sends each of its different anchors once, with its smallest
id, to the gram's bucket, and gets two bits back: whether an earlier document has the same, and whether the
gram has other bytes elsewhere. So texts are shuffled twice, compressed, and hot passages once a block.

Windows are equal if their bytes are; anchors are settled by 96 bits of hashes.

Defined results: matches never cross documents, and strings are judged on the input. A null or empty text
has no bytes. Rows with the same id don't count against each other; a null id comes after all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import blocks, buckets_for, compressed, opened, packed, parts, unpacked
from tidemark.llm.common import run_starts, slices, stored

#: Bytes of a repeated string, and of the gram that its windows are told apart by first.
DEPTH, GRAM = 50, 16
WINDOW = DEPTH - GRAM + 1
#: Places that are hashed at once. Their numbers take the lower bits where grams are compared.
STRIP, STRIP_BITS = 1 << 17, 24
#: Windows that are sorted at once, unless one gram has more of them at one place.
SORTED = 1 << 19
HASH_BITS = 48
LAST = (1 << 63) - 1
REPEATED, MIXED = 1, 2

ODD = 0x9E3779B97F4A7C15
BYTES = np.random.default_rng(1).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hashes of all substrings of some bytes, from sums over their prefixes."""

    def __init__(self, longest: int = STRIP + DEPTH):
        self.power = np.cumprod(np.full(longest, ODD, np.uint64))
        self.back = np.cumprod(np.full(longest, pow(ODD, -1, 1 << 64), np.uint64))

    def read(self, data: np.ndarray) -> None:
        self.sums = np.append(np.uint64(0), np.cumsum(BYTES[data] * self.power[:len(data)]))

    def of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return _stir((self.sums[start + size] - self.sums[start]) * self.back[start])


@dataclass
class Anchors:
    """The anchors of a block: first window and number of windows, how far the gram is behind the first
    window's start, the document, and two hashes."""

    start: np.ndarray
    windows: np.ndarray
    ahead: np.ndarray
    document: np.ndarray
    gram: np.ndarray
    around: np.ndarray


def least_places(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    return np.minimum(keys[:len(keys) - (width - span)], keys[width - span:]) if span < width else keys


def anchors(data: np.ndarray, borders: np.ndarray, hasher: Hasher) -> Anchors:
    """Anchors of all windows that lie in one document each. ``borders`` are the documents' starts and the end.

    They don't depend on the strips: an anchor that a strip's end may cut is found whole by the next one, which
    begins there. An anchor has fewer windows than a strip, so each strip gets on.
    """
    found, begin, total = [], 0, len(data) - DEPTH + 1
    while begin < total:
        strip, own = data[begin:begin + STRIP + DEPTH - 1], begin
        hasher.read(strip)
        places = np.arange(len(strip) - GRAM + 1)
        grams = hasher.of(places, GRAM)
        keys = (grams >> np.uint64(STRIP_BITS) << np.uint64(STRIP_BITS)) | places.astype(np.uint64)
        least = (least_places(keys, WINDOW) & np.uint64((1 << STRIP_BITS) - 1)).astype(np.int64)
        start = np.arange(len(least))
        document = np.searchsorted(borders, start + own, side="right") - 1
        whole = start + own + DEPTH <= borders[document + 1]
        begin += len(least)
        cut = begin < total and whole[-1]
        start, least, document = start[whole], least[whole], document[whole]
        if not len(start):
            continue
        first = run_starts(least, document)
        count = np.diff(np.append(first, len(start)))
        if cut:
            begin = own + int(start[first[-1]])
            first, count = first[:-1], count[:-1]
        start, place, document = start[first], least[first], document[first]
        ahead = place - start
        around = hasher.of(start, count + DEPTH - 1)
        around = _stir(around + ahead.astype(np.uint64) * np.uint64(ODD) + count.astype(np.uint64))
        found.append((start + own, count, ahead, document, grams[place] >> np.uint64(64 - HASH_BITS), around >> np.uint64(64 - HASH_BITS)))
    if not found:
        none = np.zeros(0, np.int64)
        return Anchors(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    return Anchors(*map(np.concatenate, zip(*found, strict=True)))


@dataclass
class Kinds:
    """A block's anchors by gram and bytes: the order that brings equal ones together, the kind of each in
    that order, and each kind's first, which is of the smallest id."""

    order: np.ndarray
    kind: np.ndarray
    first: np.ndarray


def kinds_of(found: Anchors, ids: np.ndarray) -> Kinds:
    order = np.lexsort((ids[found.document], found.around, found.gram))
    first = run_starts(found.gram[order], found.around[order])
    kind = np.zeros(len(order), np.int64)
    kind[first[1:]] = 1
    return Kinds(order, np.cumsum(kind), order[first])


class Block:
    """A block's documents, anchors and kinds."""

    def __init__(self, row: pd.Series, hasher: Hasher):
        self.given = list(row["ids"])
        self.ids = np.array([LAST if i is None or pd.isna(i) else int(i) for i in self.given], np.int64)
        self.borders = np.cumsum([0, *row["sizes"]])
        self.data = np.frombuffer(opened(row["data"]), np.uint8)
        self.anchors = anchors(self.data, self.borders, hasher)
        self.kinds = kinds_of(self.anchors, self.ids)

    def asked(self, buckets: int) -> list[tuple[int, np.ndarray]]:
        """For each bucket its kinds, in order."""
        return parts((self.anchors.gram[self.kinds.first] % np.uint64(buckets)).astype(np.int64), buckets)

    def flags(self, replies: pd.DataFrame, buckets: int) -> np.ndarray:
        found, asked = np.zeros(len(self.kinds.first), np.uint8), dict(self.asked(buckets))
        for bucket, flags in zip(replies["bucket"], replies["flags"], strict=True):
            found[asked[bucket]] = unpacked(flags, np.uint8)
        return found


def flagged(gram: np.ndarray, around: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every kind whether it has a smaller id as well, and whether its gram has others."""
    order = np.lexsort((ids, around, gram))
    gram, around, ids = gram[order], around[order], ids[order]
    first = run_starts(gram, around)
    lowest = np.repeat(ids[first], np.diff(np.append(first, len(ids))))
    group = run_starts(gram[first])
    several = np.repeat(np.diff(np.append(group, len(first))) > 1, np.diff(np.append(first[group], len(ids))))
    flags = np.zeros(len(order), np.uint8)
    flags[order] = REPEATED * (lowest < ids) + MIXED * several
    return flags


def settle(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each block's kinds in a bucket whether an earlier document has it, and whether its gram has others.

    A block's kinds come in the order of grams, so they are settled by ranges of grams, each of about ``SORTED`` kinds.
    """
    gram = [np.cumsum(unpacked(x, np.uint64), dtype=np.uint64) for x in pdf["gram"]]
    around, ids = ([unpacked(x, k) for x in pdf[c]] for c, k in (("around", np.uint64), ("ids", np.int64)))
    flags = [np.zeros(len(g), np.uint8) for g in gram]
    ranges = 1 + sum(map(len, gram)) // SORTED
    borders = np.arange(1, ranges, dtype=np.uint64) * np.uint64((1 << HASH_BITS) // ranges)
    cuts = [[0, *np.searchsorted(g, borders).tolist(), len(g)] for g in gram]
    for k in range(ranges):
        some = [slice(c[k], c[k + 1]) for c in cuts]
        found = flagged(*(np.concatenate([x[s] for x, s in zip(xs, some, strict=True)]) for xs in (gram, around, ids)))
        for f, s, part in zip(flags, some, np.split(found, np.cumsum([s.stop - s.start for s in some])[:-1]), strict=True):
            f[s] = part
    return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "flags": [packed(f) for f in flags]})


def repeated(start: np.ndarray, group: np.ndarray, ids: np.ndarray, digits: np.ndarray) -> np.ndarray:
    """For every window whether its bytes are in its group with a smaller id as well.

    The sort's first digit is the group, each further one is 8 bytes. After each pass groups of one are left out.
    """
    left = np.arange(len(start))
    for depth in range(-8, DEPTH, 8):
        if depth < 0:
            digit = np.zeros(len(left), np.uint64)
        else:
            digit = np.ascontiguousarray(digits[start[left] + depth]).view(">u8").ravel().astype(np.uint64)
            if depth + 8 > DEPTH:
                digit >>= np.uint64(8 * (depth + 8 - DEPTH))
        order = np.lexsort((digit, group))
        first = run_starts(group[order], digit[order])
        size = np.diff(np.append(first, len(order)))
        group = np.repeat(np.arange(len(first)), size)
        keep = np.repeat(size > 1, size)
        left, group = left[order][keep], group[keep]
    found = np.zeros(len(start), bool)
    if len(left):
        own = ids[left]
        lowest = np.full(group.max() + 1, LAST, np.int64)
        np.minimum.at(lowest, group, own)
        found[left] = lowest[group] < own
    return found


def repeated_windows(gram: np.ndarray, ids: np.ndarray, ahead: np.ndarray, windows: np.ndarray, data: np.ndarray) -> np.ndarray:
    """For every window of every context whether it starts in a context of a smaller id as well.

    ``data`` has the contexts' bytes one behind the other, and 8 more. Equal windows share the gram and its place in
    them, so grams are sorted one after the other, as many at once as ``SORTED`` holds, and a larger one place by place.
    """
    sizes = windows + DEPTH - 1
    number, byte = np.cumsum(windows) - windows, np.cumsum(sizes) - sizes
    digits = np.lib.stride_tricks.sliding_window_view(data, 8)
    found = np.zeros(int(windows.sum()), bool)
    order = np.argsort(gram, kind="stable")
    first = np.append(run_starts(gram[order]), len(order))
    totals = np.diff(np.append(0, np.cumsum(windows[order]))[first])
    for a, b in slices(totals, SORTED):
        own, name = order[first[a]:first[b]], np.repeat(np.arange(b - a), np.diff(first[a:b + 1]))
        if totals[a:b].sum() <= SORTED:
            count = windows[own]
            of = np.repeat(np.arange(len(own)), count)
            within = np.arange(len(of)) - (np.cumsum(count) - count)[of]
            own = own[of]
            found[number[own] + within] = repeated(byte[own] + within, name[of] * DEPTH + ahead[own] - within, ids[own], digits)
            continue
        for place in range(WINDOW):
            here = own[(ahead[own] >= place) & (ahead[own] - windows[own] < place)]
            within = ahead[here] - place
            found[number[here] + within] = repeated(byte[here] + within, np.zeros(len(here), np.int64), ids[here], digits)
    return found


def compare(pdf: pd.DataFrame) -> pd.DataFrame:
    """``repeated_windows`` over all contexts of a bucket, given back to their blocks."""
    columns = {c: [unpacked(x, k) for x in pdf[c]] for c, k in (("gram", np.uint64), ("ids", np.int64), ("ahead", np.uint8), ("windows", np.uint8))}
    whole = {c: np.concatenate(x) for c, x in columns.items()}
    data = np.frombuffer(b"".join([*map(opened, pdf["data"]), bytes(8)]), np.uint8)
    windows = whole["windows"].astype(np.int64)
    found = repeated_windows(whole["gram"], whole["ids"], whole["ahead"].astype(np.int64), windows, data)
    ends = np.cumsum([int(w.astype(np.int64).sum()) for w in columns["windows"]])
    return pd.DataFrame({
        "block": pdf["block"], "bucket": pdf["bucket"],
        "windows": [packed(f.astype(np.uint8)) for f in np.split(found, ends[:-1])],
    })


def removed(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, spans, kept)`` of every row: spans are ``[start, end)`` pairs in bytes."""
    packs = stored(blocks(documents, F.lit(0), lambda t: (t or "").encode("utf-8", "surrogatepass"), text, doc_id), "blocks")
    buckets = buckets_for(packs)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for batch in batches:
            for _, row in batch.iterrows():
                block = Block(row, hasher)
                a, first = block.anchors, block.kinds.first
                yield pd.DataFrame([(
                    row["block"], k, packed(np.diff(a.gram[own], prepend=np.uint64(0))), packed(a.around[own]),
                    packed(block.ids[a.document[own]]),
                ) for k, own in ((k, first[own]) for k, own in block.asked(buckets))], columns=["block", "bucket", "gram", "around", "ids"])

    asked = packs.mapInPandas(ask, "block long, bucket int, gram binary, around binary, ids binary")
    flags = stored(asked.groupBy("bucket").applyInPandas(settle, "block long, bucket int, flags binary"), "flags")

    def send(key: tuple, rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(replies):
            block = Block(rows.iloc[0], Hasher())
            a, open_ = block.anchors, block.flags(replies, buckets) == MIXED
            for k, own in block.asked(buckets):
                own = block.kinds.first[own[open_[own]]]
                if len(own):
                    data = b"".join(
                        block.data[s:e].tobytes() for s, e in zip(a.start[own], a.start[own] + a.windows[own] + DEPTH - 1, strict=True)
                    )
                    found.append((
                        key[0], k, packed(a.gram[own]), packed(block.ids[a.document[own]]), packed(a.ahead[own].astype(np.uint8)),
                        packed(a.windows[own].astype(np.uint8)), compressed(data),
                    ))
        return pd.DataFrame(found, columns=["block", "bucket", "gram", "ids", "ahead", "windows", "data"])

    contexts = packs.groupBy("block").cogroup(flags.groupBy("block")).applyInPandas(
        send, "block long, bucket int, gram binary, ids binary, ahead binary, windows binary, data binary"
    )
    windows = contexts.groupBy("bucket").applyInPandas(compare, "block long, bucket int, windows binary")
    replies = flags.join(windows, ["block", "bucket"], "left")

    def cut(key: tuple, rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows.iloc[0], Hasher())
        a, kinds = block.anchors, block.kinds
        flags = block.flags(replies, buckets)
        # Of each anchor, what of its windows is repeated: all, none, or as the comparison found.
        hit = (flags[kinds.kind] & REPEATED > 0) | (block.ids[a.document[kinds.order]] > block.ids[a.document[kinds.first]][kinds.kind])
        ends = a.start + a.windows
        change = np.zeros(len(block.data) + 1, np.int32)
        whole = kinds.order[hit]
        np.add.at(change, a.start[whole], 1)
        np.add.at(change, ends[whole] + DEPTH - 1, -1)
        details: dict[int, np.ndarray] = {}
        asked = dict(block.asked(buckets))
        for bucket, found in zip(replies["bucket"], replies["windows"], strict=True):
            if found is not None:
                own = asked[bucket][flags[asked[bucket]] == MIXED]
                sizes = a.windows[kinds.first[own]]
                details.update(zip(own.tolist(), np.split(unpacked(found, np.uint8), np.cumsum(sizes)[:-1]), strict=True))
        for place in np.flatnonzero(~hit & (flags[kinds.kind] == MIXED)).tolist():
            found = details.get(int(kinds.kind[place]))
            if found is not None and found.any():
                starts = a.start[kinds.order[place]] + np.flatnonzero(found)
                np.add.at(change, starts, 1)
                np.add.at(change, starts + DEPTH, -1)
        covered = np.cumsum(change[:-1], dtype=np.int32) > 0
        result = []
        for id_, s, e in zip(block.given, block.borders[:-1].tolist(), block.borders[1:].tolist(), strict=True):
            gone = covered[s:e]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            result.append((id_, e - s, int(gone.sum()), len(edges) // 2, edges.reshape(-1, 2).tolist(), block.data[s:e][~gone].tobytes()))
        out = pd.DataFrame(result, columns=["id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])
        return out.assign(id=out["id"].astype("Int64"))

    return packs.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(
        cut, "id long, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept binary"
    )
