"""Language-model scores of documents by logistic context mixing, beside an add-one word model.

A document is read as its words with A-Z lowered, each followed by a blank, the last by the end; so the
model's probabilities are of the same tokens as the base's. Every byte is coded as eight bits. For each
of several contexts, the last 1 to 4 bytes and a hash of the word so far, a bit is predicted from how often
it took either value there, over all training documents. The predictions are stretched to the logistic
scale and mixed with weights that a gate picks: the bit's place in the byte and how well the two longest
contexts are known. A final table refines the mixed prediction by the byte before it.

Counts grow with the corpus. Each part of a block of documents sends its distinct pairs of context and byte to
the contexts' buckets with their counts, and gets back what the corpus predicts for the eight bits of each pair, in
the same order, of which pairs with the same context and bits before share what is equal; or that the context is nowhere
else, so that its own counts are all. Contexts of 1 and 2 bytes have one table of at most 2^24 counts, whatever the corpus.
Words are counted likewise, by hashes of 64 bits that stand for them. A block is kept as its distinct words and
their order, and a byte's contexts are found once for each word and for what stands before its first bytes.

Weights and refining table learn online in every block, from all training documents or one in so many as the caller asks
for. Each of their bytes is predicted from all counts but those of its own document, which are taken to be as many as documents
with the byte's word have on average. Bits of a block for which that gives the same teach together, as often as they occur. Blocks start a round from the average over all blocks of the round before.
Scores are taken with what was learned and the counts of all training documents, so they don't hang on the order of documents.

Defined results: a null or empty text has only the end. A null id counts as the empty text where
documents are split. Repeated rows are scored, and learned from, each. Without training documents, N and
V are 0 and the model gives every bit one half.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import BLOCK, SHARE, blocks, compressed, opened, packed, parts, unpacked
from tidemark.llm.common import run_starts, slices, stored

#: Contexts, shortest first. Of the last three a block asks; of the first two all have the table.
ORDERS = ("1 byte", "2 bytes", "3 bytes", "4 bytes", "word")
ASKED, WORDS = 3, 2
#: Bytes of a block, whose distinct pairs are found together; a word's bytes with contexts before it; bits of a word's hash;
#: bytes of words whose contexts are found together.
PART, HEAD, WORD_BITS, CACHED = 1 << 23, 4, 40, 1 << 18
#: How many times as many buckets contexts have as words.
SPREAD = 2
#: Pairs of 2 bytes and a byte, and how many make a part of the table.
PAIRS, CHUNK = 1 << 24, 1 << 20
#: One training document in so many teaches the weights if the caller doesn't say how many, in so many rounds.
TUNED, ROUNDS = 64, 4
#: Keys whose bits are predicted together.
CHUNKED = 1 << 13
#: Bytes whose bits make one online step, learning rates, and what a count begins with.
STEP, RATE, REFINE_RATE, PRIOR = 1 << 10, 0.1, 0.02, 0.08
ODD = 0x9E3779B97F4A7C15
#: What one of a part's bits may count in one online step is the share of all in so many.
PIECES = 1 << 19
#: Steps of a stretched value that is kept in a byte.
SCALE = 14.0
#: Levels of how well a context is known; columns of the refining table.
LEVELS, COLUMNS = 4, 24
PLACES = np.arange(8)


def words_and_end(text: str | None) -> bytes:
    """The tokens' bytes: neither blank nor line end is in a word."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split()) + b"\n"


def words_packed(lines: list[bytes]) -> bytes:
    """A block's text as its distinct words, most frequent first, and each word's place among them."""
    flat = b"".join(lines).split()
    words = np.empty(len(flat), object)
    words[:] = flat
    place, known = pd.factorize(words)
    order = np.argsort(-np.bincount(place, minlength=len(known)), kind="stable")
    rank = np.empty(len(known), np.int32)
    rank[order] = np.arange(len(known), dtype=np.int32)
    counts = np.array([line.count(b" ") + (len(line) > 1) for line in lines], np.int32)
    fields = compressed(b"\n".join(known[order]), 3), packed(rank[place]), packed(counts)
    return b"".join(len(x).to_bytes(8, "little") + x for x in fields)


class Words:
    """A block's words as ``words_packed`` has left them."""

    def __init__(self, data: bytes):
        fields, at = [], 0
        while at < len(data):
            size = int.from_bytes(data[at:at + 8], "little")
            fields.append(data[at + 8:at + 8 + size])
            at += 8 + size
        self.place, self.counts = unpacked(fields[1], np.int32), unpacked(fields[2], np.int32).astype(np.int64)
        known = opened(fields[0]).split(b"\n") if len(self.place) else []
        self.known = np.empty(len(known), object)
        self.known[:] = known

    def lines(self, wanted: np.ndarray | None = None) -> list[bytes]:
        """The documents' bytes, or of those that are ``wanted``."""
        ends = np.cumsum(self.counts)
        spans = zip((ends - self.counts).tolist(), ends.tolist(), strict=True)
        return [b" ".join(self.known[self.place[a:b]]) + b"\n" for i, (a, b) in enumerate(spans) if wanted is None or wanted[i]]

    def hashed(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes in order; for each word its place among them."""
        hashes, place = np.unique(pd.util.hash_array(self.known, categorize=False).astype(np.uint64), return_inverse=True)
        return hashes, place[self.place]


def word_buckets(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of hashes, so that those of a bucket lie close together."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def word_counts(packs: DataFrame, buckets: int) -> DataFrame:
    """``(block, bucket, counts, words, distinct)``: a block's words' counts in training documents, as it asked."""
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, roles, data in zip(batch["block"], batch["roles"], batch["data"], strict=True):
                words = Words(data)
                hashes, place = words.hashed()
                learned = np.repeat(np.asarray(roles) > 0, words.counts)
                n = np.bincount(place[learned], minlength=len(hashes)).astype(np.uint32)
                yield pd.DataFrame([
                    (block, k, packed(np.diff(hashes[own], prepend=np.uint64(0))), packed(n[own]))
                    for k, own in parts(word_buckets(hashes, buckets), buckets)
                ], columns=["block", "bucket", "hashes", "n"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes = [np.cumsum(unpacked(h, np.uint64), dtype=np.uint64) for h in pdf["hashes"]]
        place, known = pd.factorize(np.concatenate(hashes))
        total = np.bincount(place, np.concatenate([unpacked(n, np.uint32) for n in pdf["n"]]), len(known)).astype(np.uint64)
        ends = np.cumsum([len(h) for h in hashes])
        replies = [packed(total[place[e - len(h):e]]) for h, e in zip(hashes, ends, strict=True)]
        words, distinct = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        words[0], distinct[0] = total.sum(), (total > 0).sum()
        return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "counts": replies, "words": words, "distinct": distinct})

    asked = packs.mapInPandas(ask, "block long, bucket int, hashes binary, n binary")
    return asked.groupBy("bucket").applyInPandas(answer, "block long, bucket int, counts binary, words long, distinct long")


class Occurrences:
    """A block's words where they stand: what is before, the word with its end, the document; an empty document has the end alone.

    A byte's contexts hang on the word so far and, among its first ``HEAD`` bytes, on those before the word. So a word's
    head is found once for all that it has before it, and the rest of the word once.
    """

    def __init__(self, words: Words, documents: np.ndarray, sizes: np.ndarray):
        known = [*words.known, b""]
        self.text = np.frombuffer(b"".join(known), np.uint8)
        self.length = np.fromiter(map(len, known), np.int64, len(known))
        self.begin = np.cumsum(self.length) - self.length
        n = np.maximum(words.counts, 1)
        self.document = np.repeat(documents.astype(np.int32), n)
        place = np.full(len(self.document), len(known) - 1, np.int32)
        place[np.repeat(words.counts > 0, n)] = words.place
        first, last = np.zeros((2, len(place)), bool)
        first[np.cumsum(n) - n] = last[np.cumsum(n) - 1] = True
        tails = np.zeros(len(known), np.int64)
        for k in range(3):
            own = self.length > k
            tails[own] |= self.text[(self.begin + self.length)[own] - 1 - k].astype(np.int64) << 8 * k
        length, tail = self.length[place], tails[place]
        back = np.append(0, tail[:-1] & 255)
        tail |= np.where((length == 2) & ~first, 32 << 16, 0) | np.where((length == 1) & ~first, 32 << 8 | back << 16, 0)
        #: The four bytes before, the nearest lowest; a word and whether it ends the document.
        self.before = np.where(first, 0, 32 | np.append(0, tail[:-1]) << 8).astype(np.uint32)
        self.ended = place << 1 | last
        #: Whether its document has the word before.
        self.again = pd.Index(self.document.astype(np.int64) << 32 | place).duplicated()
        del place, tail, back, first, last
        at = np.cumsum(length + 1) - length - 1
        starts = np.append(0, np.cumsum(n))[:-1]
        self.unit = ((at + np.repeat((np.cumsum(sizes) - sizes)[documents] - at[starts], n)) // PART).astype(np.int32)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bits_of(byte: np.ndarray) -> np.ndarray:
    """The eight bits of each byte, highest first."""
    return (byte[:, None] >> (7 - PLACES)) & 1


def heads(before: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For words' first bytes after what is before: how many, and for each its key, the word so far and a number for both."""
    size, alive, items, word = np.zeros(len(head), np.int64), np.ones(len(head), bool), [], np.zeros(len(head), np.uint64)
    for k in range(HEAD):
        byte = head >> 8 * k & 255
        before = before << 8 | byte
        size += alive
        items.append((alive, before, shortened(_stir(word)), before | (k + 1) << 40))
        before = before & 0xFFFFFFFF
        word = word + (byte + 1).astype(np.uint64) * np.uint64(pow(ODD, k, 1 << 64))
        alive = alive & (byte != 32) & (byte != 10)
    alive, *found = (np.stack(x, 1) for x in zip(*items, strict=True))
    return size, *(x[alive] for x in found)


def rests(wide: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the later bytes of words that lie one after another a key, the word so far and a number for both."""
    starts = np.cumsum(size) - size
    power, back = (np.cumprod(np.full(len(wide), f, np.uint64)) for f in (ODD, pow(ODD, -1, 1 << 64)))
    power *= (wide + 1).astype(np.uint64)
    sums = np.append(np.uint64(0), np.cumsum(power))
    later = np.flatnonzero(np.arange(len(wide)) - np.repeat(starts, size) >= HEAD)
    first = np.repeat(starts, np.maximum(size - HEAD, 0))
    word, byte, key = _stir((sums[later] - sums[first]) * back[first]), wide[later], np.zeros(len(later), np.int64)
    for k in range(HEAD + 1):
        key |= wide[later - k] << 8 * k
    return key, shortened(word), (word ^ ((byte + 1).astype(np.uint64) * np.uint64(ODD))).view(np.int64)


def shortened(word: np.ndarray) -> np.ndarray:
    return (word >> np.uint64(64 - WORD_BITS)).view(np.int64)


class Unit:
    """Neighbouring words' bytes: the distinct keys, and of those the pairs for each context."""

    def __init__(self, every: Occurrences, own: slice, roles: np.ndarray):
        self.document, ended = every.document[own], every.ended[own]
        seen = np.zeros(2 * len(every.length), bool)
        seen[ended] = True
        self.rest, ended = (np.cumsum(seen, dtype=np.int32) - np.int32(1))[ended], np.flatnonzero(seen)
        size, begin = every.length[ended >> 1] + 1, every.begin[ended >> 1]
        # Every word's first bytes with what is before, then what is left of each word; words are taken by groups.
        head, found = np.zeros(len(size), np.int64), []
        for a, b in slices(size, CACHED):
            some, starts = size[a:b], np.cumsum(size[a:b]) - size[a:b]
            wide = np.full(some.sum(), 32)
            inside = np.ones(len(wide), bool)
            inside[starts + some - 1] = False
            wide[~inside] = np.where(ended[a:b] & 1, 10, 32)
            wide[inside] = every.text[np.repeat(begin[a:b] - starts, some)[inside] + np.flatnonzero(inside)]
            for k in range(HEAD):
                head[a:b][some > k] |= wide[(starts + k)[some > k]] << 8 * k
            found.append(rests(wide, some))
        self.rest_size = np.maximum(size - HEAD, 0)
        head = every.before[own].astype(np.int64) << 32 | head[self.rest]
        self.head, head = pd.factorize(head)
        self.head = self.head.astype(np.int32)
        self.head_size, *first = heads(head >> 32 & 0xFFFFFFFF, head & 0xFFFFFFFF)
        key, word, joint = (np.concatenate(x) for x in zip(first, *found, strict=True))
        del first, found, head
        place, distinct = pd.factorize(joint)
        del joint
        self.place = place.astype(np.int32)
        del place
        some = np.empty(len(distinct), np.int64)
        some[self.place] = np.arange(len(self.place))
        key, word = key[some], word[some]
        #: How often each key occurs in documents of role 1 and of role 2, and in both in words that their document has before.
        self.times, again = [], every.again[own]
        role = roles[self.document]
        for own in (role == 1, role == 2, (role > 0) & again):
            n = np.bincount(self.head[own], minlength=len(self.head_size)), np.bincount(self.rest[own], minlength=len(size))
            n = np.append(np.repeat(n[0], self.head_size), np.repeat(n[1], self.rest_size))
            self.times.append(np.bincount(self.place, n, len(distinct)))
        self.again = self.times.pop()
        self.byte, self.before = key & 255, (key >> 8) & 255
        quad, quads = pd.factorize(key)
        triple, triples = pd.factorize(quads & 0xFFFFFFFF)
        pair, self.pairs = pd.factorize(triples & (PAIRS - 1))
        own, words = pd.factorize(word << 8 | self.byte)
        #: Distinct pairs of context and byte, for the contexts that are asked for, and which of them a key has.
        self.keys, self.at = [triples, quads, words], [triple[quad], quad, own]
        self.pair_at = pair[self.at[0]]

    def places(self) -> np.ndarray:
        """Where each byte is among the keys."""
        first, rest = np.cumsum(self.head_size) - self.head_size, np.cumsum(self.rest_size) - self.rest_size + self.head_size.sum()
        short, size = self.head_size[self.head], self.head_size[self.head] + self.rest_size[self.rest]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        item = np.where(at < np.repeat(short, size), np.repeat(first[self.head], size), np.repeat(rest[self.rest] - short, size)) + at
        return self.place[item].astype(np.int32)

    def summed(self, values: np.ndarray, total: np.ndarray) -> None:
        """Adds the values of its bytes' keys to its documents' total."""
        owner = np.repeat(np.arange(len(self.head_size) + len(self.rest_size)), np.append(self.head_size, self.rest_size))
        own = np.bincount(owner, values[self.place], len(self.head_size) + len(self.rest_size))
        total += np.bincount(self.document, own[self.head] + own[len(self.head_size):][self.rest], len(total))

    def asked(self, k: int, buckets: int) -> list[tuple[int, np.ndarray]]:
        """For each bucket the pairs that it is asked for, in the order of their numbers.

        Words' hashes go to buckets by ranges, so that those of a bucket lie close together.
        """
        keys = self.keys[k]
        order = np.argsort(keys)
        context = keys[order] >> 8
        if k == WORDS:
            bucket = context * buckets >> WORD_BITS
        else:
            bucket = (_stir(context.astype(np.uint64) * np.uint64(ODD) + np.uint64(k)) % np.uint64(buckets)).astype(np.int64)
        return [(b, order[own]) for b, own in parts(bucket, buckets)]


def units(words: Words, sizes: np.ndarray, roles: np.ndarray, wanted: np.ndarray | None = None) -> Iterator[tuple[int, Unit]]:
    """A block's bytes by parts of neighbouring words, numbered. If ``wanted`` says of which documents, ``words`` has only theirs."""
    every = Occurrences(words, np.arange(len(sizes)) if wanted is None else np.flatnonzero(wanted), sizes)
    first = run_starts(every.unit)
    for a, b in zip(first, np.append(first[1:], len(every.unit)), strict=True):
        yield int(every.unit[a]), Unit(every, slice(a, b), roles)


def nodes(keys: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each place the first pairs with the same context and bits before, of pairs that are sorted in rows."""
    apart = np.full(len(keys), 1 << 62)
    apart[1:] = keys[1:] ^ keys[:-1]
    apart[offsets[:-1][np.diff(offsets) > 0]] = 1 << 62
    return [np.flatnonzero(apart >= 1 << (8 - place)) for place in range(8)]


def coded(keys: np.ndarray, steps: np.ndarray, levels: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
    """For each row its pairs' steps and levels.

    Pairs with the same context and bits before have the same level and, but for the sign, the same step; so the first alone
    has them, as the difference from the place before.
    """
    first, steps = nodes(keys, offsets), steps.view(np.uint8)
    cuts = [np.searchsorted(f, offsets).tolist() for f in first]
    changes = [steps[f, k] - steps[f, k - 1] if k else steps[f, 0] for k, f in enumerate(first)]
    known = [(levels[f] >> np.uint16(2 * k)) - (levels[f] >> np.uint16(2 * k - 2) if k else 0) for k, f in enumerate(first)]
    known = [(x & (LEVELS - 1)).astype(np.uint8) for x in known]
    for row in range(len(offsets) - 1):
        own = [slice(c[row], c[row + 1]) for c in cuts]
        level = np.concatenate([x[o] for x, o in zip(known, own, strict=True)])
        level = np.pad(level, (0, -len(level) % 4)).reshape(-1, 4) << np.arange(0, 8, 2, dtype=np.uint8)
        yield compressed(b"".join(x[o].tobytes() for x, o in zip(changes, own, strict=True))), compressed(level.sum(1, dtype=np.uint8).tobytes())


def decoded(keys: np.ndarray, offsets: np.ndarray, rows: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Steps and levels of all rows' pairs."""
    first = nodes(keys, offsets)
    cuts = [np.searchsorted(f, offsets).tolist() for f in first]
    changes, known = ([np.empty(len(f), np.uint8) for f in first] for _ in range(2))
    for row, (step, level) in enumerate(rows):
        step, level, at = np.frombuffer(opened(step), np.uint8), np.frombuffer(opened(level), np.uint8), 0
        level = (level[:, None] >> np.arange(0, 8, 2, dtype=np.uint8) & (LEVELS - 1)).ravel()
        for x, y, c in zip(changes, known, cuts, strict=True):
            own = slice(at, at + c[row + 1] - c[row])
            x[c[row]:c[row + 1]], y[c[row]:c[row + 1]], at = step[own], level[own], own.stop
    steps, levels, last = np.zeros((len(keys), 8), np.uint8), np.zeros(len(keys), np.uint16), np.zeros(len(keys), np.uint8)
    for k, f in enumerate(first):
        size, bit = np.diff(np.append(f, len(keys))), (keys >> (7 - k)) & 1
        step = np.repeat(changes[k] + steps[f, k - 1] if k else changes[k], size)
        steps[:, k] = np.where(bit == np.repeat(bit[f], size), step, -step)
        last = np.repeat((known[k] + last[f]) & np.uint8(LEVELS - 1), size)
        levels |= last.astype(np.uint16) << np.uint16(2 * k)
    return steps.view(np.int8), levels


def stretched(taken: np.ndarray, other: np.ndarray) -> np.ndarray:
    """What counts of a bit's two values predict, on the logistic scale in steps."""
    value = np.log((taken + np.float32(PRIOR)) / (other + np.float32(PRIOR)), dtype=np.float32)
    return np.clip(np.rint(SCALE * value), -127, 127).astype(np.int8)


def node_table(counts: np.ndarray) -> np.ndarray:
    """For contexts' counts of 256 bytes the steps towards a 1, by the bits before with a leading 1."""
    table = np.zeros(counts.shape, np.int8)
    for place in range(8):
        both = counts.reshape(len(counts), 2 << place, -1).sum(2).astype(np.float32)
        table[:, 1 << place:2 << place] = stretched(both[:, 1::2], both[:, 0::2])
    return table


def left_table(counts: np.ndarray) -> np.ndarray:
    """For contexts' counts of 256 bytes the steps towards a bit taken without one such byte, by the bits up to it with a leading 1."""
    table = np.zeros((len(counts), 512), np.int8)
    for place in range(8):
        both = counts.reshape(len(counts), 2 << place, -1).sum(2).astype(np.float32)
        other = both.reshape(len(counts), -1, 2)[:, :, ::-1].reshape(both.shape)
        table[:, 2 << place:4 << place] = stretched(np.maximum(both - 1, 0), other)
    return table


def short_tables(predicted: DataFrame) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Tables of the contexts of 1 and 2 bytes, as ``node_table`` and ``left_table`` have them. Their size is fixed.

    The counts of pairs come with the buckets' answers, and are at most ``PAIRS`` rows when summed.
    """

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pairs, n in zip(batch["pairs"], batch["pair_n"], strict=True):
                yield pd.DataFrame({"pair": unpacked(pairs, np.int64), "n": unpacked(n, np.int64)})

    def turn(pdf: pd.DataFrame) -> pd.DataFrame:
        chunk = int(pdf["pair"].iloc[0]) // CHUNK
        counts = np.zeros(CHUNK, np.int64)
        counts[pdf["pair"] - chunk * CHUNK] = pdf["n"]
        both = counts.reshape(-1, 256)
        found = chunk, packed(node_table(both)), packed(left_table(both)), packed(counts.reshape(-1, 1 << 16).sum(0))
        return pd.DataFrame([found], columns=["chunk", "steps", "left", "sums"])

    sums = predicted.filter("pairs IS NOT NULL").select("pairs", "pair_n").mapInPandas(listed, "pair long, n long")
    sums = sums.groupBy("pair").agg(F.sum("n").alias("n"))
    found = sums.groupBy(F.floor(F.col("pair") / CHUNK)).applyInPandas(turn, "chunk int, steps binary, left binary, sums binary")
    two, left, one = np.zeros(PAIRS, np.int8), np.zeros(2 * PAIRS, np.int8), np.zeros(1 << 16, np.int64)
    for row in found.toLocalIterator():
        two[row["chunk"] * CHUNK:][:CHUNK] = unpacked(row["steps"], np.int8)
        left[row["chunk"] * 2 * CHUNK:][:2 * CHUNK] = unpacked(row["left"], np.int8)
        one += unpacked(row["sums"], np.int64)
    one = one.reshape(-1, 256)
    return [node_table(one).ravel(), two], [left_table(one).ravel(), left]


def short_steps(pairs: np.ndarray, tables: list[np.ndarray]) -> list[np.ndarray]:
    """For pairs of 2 bytes and a byte what the two tables predict for the bits taken."""
    byte = pairs & 255
    node, sign = (1 << PLACES) | (byte[:, None] >> (8 - PLACES)), (2 * bits_of(byte) - 1).astype(np.int8)
    return [table[(pairs >> 8 & mask)[:, None] << 8 | node] * sign for table, mask in zip(tables, (255, 65535), strict=True)]


def short_left_steps(pairs: np.ndarray, tables: list[np.ndarray]) -> list[np.ndarray]:
    """The same without one of each pair's own occurrences."""
    node = (2 << PLACES) | ((pairs & 255)[:, None] >> (7 - PLACES))
    return [table[(pairs >> 8 & mask)[:, None] << 9 | node] for table, mask in zip(tables, (255, 65535), strict=True)]


def path_steps(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For distinct sorted pairs of context and byte the steps towards each bit taken, and levels, two bits a place."""
    steps, levels = np.zeros((len(keys), 8), np.int8), np.zeros(len(keys), np.uint16)
    for place in range(8):
        first, bit = run_starts(keys >> (8 - place)), (keys >> (7 - place)) & 1
        size = np.diff(np.append(first, len(keys)))
        total, one = (np.add.reduceat(n, first).astype(np.float32) for n in (counts, counts * bit))
        steps[:, place] = np.repeat(stretched(one, total - one), size) * (2 * bit - 1)
        levels |= np.repeat(np.minimum(LEVELS - 1, np.log2(total + 1) / 2).astype(np.uint16) << np.uint16(2 * place), size)
    return steps, levels


def left_out(counts: np.ndarray, again: np.ndarray) -> np.ndarray:
    """How many of each pair's occurrences a document has on average, of which ``again`` are in words that their document has before."""
    new = counts - again
    return np.where(new > 0, np.rint(counts / np.maximum(new, 1)), counts).astype(np.int64)


def left_steps(keys: np.ndarray, counts: np.ndarray, again: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``path_steps`` for each pair without its occurrences in a document."""
    steps, levels, left = np.zeros((len(keys), 8), np.int8), np.zeros(len(keys), np.uint16), left_out(counts, again)
    total = None
    for place in range(9):
        first = run_starts(keys >> (8 - place))
        taken = np.repeat(np.add.reduceat(counts, first), np.diff(np.append(first, len(keys))))
        if place:
            steps[:, place - 1] = stretched((taken - left).astype(np.float32), (total - taken).astype(np.float32))
            level = np.minimum(LEVELS - 1, np.log2((total - left + 1).astype(np.float32)) / 2).astype(np.uint16)
            levels |= level << np.uint16(2 * place - 2)
        total = taken
    return steps, levels


def long_steps(packs: DataFrame, buckets: int) -> DataFrame:
    """``(block, unit, kind, bucket, elsewhere, steps, levels, tuned_steps, tuned_levels)``: for a part's pairs, as it asked,
    whether training documents have the context elsewhere, and if so what all of them predict; and for those of these pairs that are
    in documents of role 2 how that differs if a document's occurrences of the pair are left out. A bucket's first row for contexts of
    3 bytes has the counts of its pairs of 2 bytes and a byte, ``pairs`` and ``pair_n``, in training documents."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, roles, sizes, data in zip(batch["block"], batch["roles"], batch["sizes"], batch["data"], strict=True):
                roles = np.asarray(roles)
                for number, unit in units(Words(data), np.asarray(sizes), roles):
                    for k in range(ASKED):
                        n = [np.bincount(unit.at[k], t, len(unit.keys[k])).astype(np.uint32) for t in (*unit.times, unit.again)]
                        yield pd.DataFrame([
                            (block, number, k, b, packed(np.diff(unit.keys[k][own], prepend=np.int64(0))), *(packed(m[own]) for m in n))
                            for b, own in unit.asked(k, buckets)
                        ], columns=["block", "unit", "kind", "bucket", "keys", "n", "tuned", "again"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(unpacked(x, np.int64)) for x in pdf["keys"]]
        sizes = [len(x) for x in keys]
        ends, keys = np.cumsum(sizes)[:-1], np.concatenate(keys)
        n, tuned, again = (np.concatenate([unpacked(x, np.uint32) for x in pdf[c]]).astype(np.int64) for c in ("n", "tuned", "again"))
        order = np.argsort(keys, kind="stable")
        first = run_starts(keys[order])
        place = np.empty(len(keys), np.int64)
        place[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
        distinct, total, again = keys[order][first], *(np.add.reduceat(x[order], first) for x in (n + tuned, again))
        shared = run_starts(distinct >> 8)
        lengths = np.diff(np.append(shared, len(distinct)))
        own = run_starts(np.repeat(np.arange(len(pdf)), sizes), keys >> 8)
        known = np.repeat(np.add.reduceat(n + tuned, own), np.diff(np.append(own, len(keys))))
        elsewhere = np.repeat(np.add.reduceat(total, shared), lengths)[place] != known
        out = {c: pdf[c] for c in ("block", "unit", "kind", "bucket")}
        out["elsewhere"] = [packed(np.packbits(e)) for e in np.split(elsewhere, ends)]
        bounds, found = np.append(0, np.append(ends, len(keys))), []
        for wanted, predict, counts in ((elsewhere, path_steps, (total,)), (elsewhere & (tuned > 0), left_steps, (total, again))):
            need = np.zeros(len(distinct), bool)
            need[place[wanted]] = True
            need = np.repeat(np.logical_or.reduceat(need, shared), lengths)
            steps, levels = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.uint16)
            predicted = predict(distinct[need], *(c[need] for c in counts))
            steps[need], levels[need] = predicted[0].view(np.int64).ravel(), predicted[1]
            found.append((steps, levels, place[wanted], np.append(0, np.cumsum(wanted))[bounds]))
        (steps, levels, own, offsets), (left, left_levels, taught, cuts) = found
        out["steps"], out["levels"] = zip(*coded(keys[elsewhere], steps[own].view(np.int8).reshape(-1, 8), levels[own], offsets), strict=True)
        change = steps[taught].view(np.uint8).reshape(-1, 8) - left[taught].view(np.uint8).reshape(-1, 8)
        out["tuned_steps"] = [steps_packed(change[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        out["tuned_levels"] = [packed(levels[own] ^ left_levels[own]) for own in np.split(taught, cuts[1:-1])]
        pair, pairs = pd.factorize(distinct & (PAIRS - 1) if pdf["kind"].iloc[0] == 0 else distinct[:0])
        for name, values in (("pairs", pairs), ("pair_n", np.bincount(pair, total[:len(pair)], len(pairs)).astype(np.int64))):
            out[name] = [packed(values) if len(pairs) else None] + [None] * (len(pdf) - 1)
        return pd.DataFrame(out)

    asked = packs.mapInPandas(ask, "block long, unit int, kind int, bucket int, keys binary, n binary, tuned binary, again binary")
    return asked.groupBy("bucket", "kind").applyInPandas(
        answer, "block long, unit int, kind int, bucket int, elsewhere binary, steps binary, levels binary, tuned_steps binary, tuned_levels binary, "
        "pairs binary, pair_n binary"
    )


def inputs(unit: Unit, replies: pd.DataFrame, buckets: int, left: bool = False) -> tuple[list[np.ndarray], np.ndarray]:
    """For a part's keys the steps of the contexts asked for towards each bit taken, and gates.

    ``replies`` are the part's. Contexts that are nowhere else are predicted from the keys' own counts in training documents.
    ``left`` leaves a document's occurrences out of the counts, and is for keys that documents of role 2 have.
    """
    x, known = [], []
    for k in range(ASKED):
        keys = unit.keys[k]
        n, taught, again = (np.bincount(unit.at[k], t, len(keys)).astype(np.int64) for t in (sum(unit.times), unit.times[1], unit.again))
        steps, levels, open_ = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.uint16), np.zeros(len(keys), bool)
        own, asked, answered, rows = replies[replies["kind"] == k], dict(unit.asked(k, buckets)), [np.zeros(0, np.int64)], []
        for bucket, e, s, v in zip(own["bucket"], own["elsewhere"], own["steps"], own["levels"], strict=True):
            at = asked[bucket]
            found = np.unpackbits(unpacked(e, np.uint8), count=len(at)).astype(bool)
            open_[at[~found]] = True
            answered.append(at[found])
            rows.append((s, v))
        at = np.concatenate(answered)
        found = decoded(keys[at], np.cumsum([len(x) for x in answered]), rows)
        steps[at], levels[at] = found[0].view(np.int64).ravel(), found[1]
        if left:
            for at, s, v in zip(answered[1:], own["tuned_steps"], own["tuned_levels"], strict=True):
                at = at[taught[at] > 0]
                steps[at] = (steps[at].view(np.uint8).reshape(-1, 8) - steps_unpacked(s).view(np.uint8)).view(np.int64).ravel()
                levels[at] ^= unpacked(v, np.uint16)
        at = np.flatnonzero(open_)
        if len(at):
            at = at[np.argsort(keys[at])]
            found = left_steps(keys[at], n[at], again[at]) if left else path_steps(keys[at], n[at])
            steps[at], levels[at] = found[0].view(np.int64).ravel(), found[1]
        x.append(steps[unit.at[k]].view(np.int8).reshape(-1, 8))
        known.append(((levels[unit.at[k]][:, None] >> (2 * PLACES).astype(np.uint16)) & np.uint16(LEVELS - 1)).astype(np.uint8))
    return x, (PLACES.astype(np.uint8) * np.uint8(LEVELS) + known[-1]) * np.uint8(LEVELS) + known[-2]


class Mixer:
    """Weights for each gate and the refining table; both learn online."""

    def __init__(self, values: np.ndarray | None = None):
        weights = np.full((8 * LEVELS * LEVELS, len(ORDERS)), 0.25)
        refined = np.repeat(1 / (1 + np.exp(-(np.arange(COLUMNS) - (COLUMNS - 1) / 2)))[None, :], 256, 0)
        self.values = np.concatenate([weights.ravel(), refined.ravel()]) if values is None else values.copy()
        self.weights = self.values[:weights.size].reshape(weights.shape)
        self.refined = self.values[weights.size:].reshape(refined.shape)

    def mixed(self, x: list[np.ndarray], gate: np.ndarray) -> np.ndarray:
        """The mixed prediction of the bits taken, on the logistic scale."""
        total = np.zeros(gate.shape, np.float32)
        for k, steps in enumerate(x):
            total += (self.weights[:, k] / SCALE).astype(np.float32).take(gate) * steps
        return total.clip(-11.4, 11.4)

    def refine(self, mixed: np.ndarray, bit: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The final probability of the bits taken, the nearest cells of the refining table, and what it says of a 1."""
        one = mixed * (2 * bit - 1).astype(np.float32)
        at = (one + np.float32((COLUMNS - 1) / 2)).clip(0, np.float32(COLUMNS - 1 - 1e-4))
        low = at.astype(np.int32)
        share = at - low
        cell = before[:, None].astype(np.int32) * COLUMNS + low
        flat = self.refined.ravel().astype(np.float32)
        table = flat.take(cell) * (1 - share) + flat.take(cell + 1) * share
        p = np.clip(((1 / (1 + np.exp(-one)) + table) / 2).astype(np.float64), 1e-5, 1 - 1e-5)
        return np.where(bit == 1, p, 1 - p), cell + (share >= 0.5), table

    def learn(self, x: list[np.ndarray], gate: np.ndarray, byte: np.ndarray, before: np.ndarray) -> None:
        """One online step: each bit's error moves its gate's weights and its cells of the refining table."""
        self.step(x, gate, bits_of(byte), before, np.ones(gate.shape, np.float32))

    def step(self, x: list[np.ndarray], gate: np.ndarray, bit: np.ndarray, before: np.ndarray, times: np.ndarray) -> None:
        """``learn`` from bits that count as often as ``times`` says in the means that weights and cells move to.

        How far they move hangs on how many bits there are.
        """
        flat, often = gate.ravel(), times.ravel()
        error = times / (1 + np.exp(self.mixed(x, gate))) / np.float32(SCALE)
        count = np.bincount(flat, minlength=len(self.weights))
        rate = RATE * count / ((count + 16) * np.maximum(np.bincount(flat, often, len(self.weights)), 1e-9))
        for k, steps in enumerate(x):
            self.weights[:, k] += rate * np.bincount(flat, (error * steps).ravel(), len(self.weights))
        _, cell, table = self.refine(self.mixed(x, gate), bit, before)
        cell = cell.ravel()
        hits = np.bincount(cell, minlength=self.refined.size)
        hit = np.flatnonzero(hits)
        mean, moved = np.bincount(cell, often, self.refined.size)[hit], np.bincount(cell, often * (bit - table).ravel(), self.refined.size)[hit]
        self.refined.reshape(-1)[hit] += moved * (1 - (1 - REFINE_RATE) ** hits[hit]) / mean

    def bits(self, x: list[np.ndarray], gate: np.ndarray, byte: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Bits that each byte takes after its contexts."""
        total = np.zeros(len(byte))
        for a in range(0, len(byte), CHUNKED):
            own = slice(a, a + CHUNKED)
            p = self.refine(self.mixed([steps[own] for steps in x], gate[own]), bits_of(byte[own]), before[own])[0]
            total[own] = -np.log2(p.prod(1))
        return total


def tuning(packs: DataFrame, answers: DataFrame, tables: Broadcast, buckets: int) -> DataFrame:
    """``(bits, times)``, a row for each part of a block: what bits of the documents of role 2 are predicted from without their own
    document, as ``same_bits`` has them, and how many of them are predicted from the same."""

    def look(key: tuple, block: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, row in block.iterrows():
            for number, unit in units(Words(row["data"]), np.asarray(row["sizes"]), np.asarray(row["roles"])):
                own = np.flatnonzero(unit.times[1])
                if len(own):
                    x, gate = inputs(unit, replies[replies["unit"] == number], buckets, left=True)
                    pairs = unit.pairs[unit.pair_at[own]]
                    x = [*short_left_steps(pairs, [unpacked(t, np.int8) for t in tables.value]), *(steps[own] for steps in x)]
                    bits, times = same_bits(x, gate[own], pairs, unit.times[1][own])
                    found.append((packed(np.diff(bits, prepend=np.uint64(0))), packed(times)))
        return pd.DataFrame(found, columns=["bits", "times"])

    teaching = packs.filter(F.array_contains("roles", 2)).select("block", "roles", "sizes", "data")
    own = answers.select("block", "unit", "kind", "bucket", "elsewhere", "steps", "levels", "tuned_steps", "tuned_levels")
    return teaching.groupBy("block").cogroup(own.groupBy("block")).applyInPandas(look, "bits binary, times binary")


def same_bits(x: list[np.ndarray], gate: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs' bits, each different one once, from the low bytes of a number the contexts' steps, the longest first, then the byte
    before and the bit with its gate; so that neighbours differ little."""
    found, bit = [], bits_of(pairs & 255)
    for place in range(8):
        fields = np.zeros((len(pairs), 8), np.uint8)
        fields[:, 5], fields[:, 6] = pairs >> 8 & 255, gate[:, place] << 1 | bit[:, place]
        for k, steps in enumerate(x):
            fields[:, 4 - k] = steps[:, place].view(np.uint8)
        numbers = fields.view(np.uint64).ravel()
        order = np.argsort(numbers)
        numbers = numbers[order]
        first = run_starts(numbers)
        found.append((numbers[first], np.add.reduceat(times[order], first).astype(np.uint32)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def steps_packed(steps: np.ndarray) -> bytes:
    """Steps, of which those of a place differ little from the place before."""
    return packed(np.diff(steps.view(np.uint8), axis=1, prepend=np.uint8(0)).view(np.int64).ravel())


def steps_unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.int64).view(np.uint8).reshape(-1, 8), axis=1, dtype=np.uint8).view(np.int8)


def dealt(times: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[slice]]:
    """An order of sorted bits with how often each counts there, and online steps, each with its share of all kinds.

    What occurs more often than one of ``PIECES`` of all is spread over steps, so that no step hangs on it.
    """
    spread = np.ceil(times / max(1, times.sum(dtype=np.int64) / PIECES)).astype(np.int64)
    order = np.repeat(np.arange(len(times), dtype=np.int32), spread)
    steps = -(-len(order) // (8 * STEP))
    shares = [order[k::steps] for k in range(steps)]
    ends = np.cumsum([len(x) for x in shares]).tolist()
    order = np.concatenate(shares)
    return order, (times / spread)[order].astype(np.float32), [slice(e - len(x), e) for x, e in zip(shares, ends, strict=True)]


def tuned(examples: DataFrame) -> np.ndarray:
    """Weights and refining table after all rounds: the mean over all parts, by their bits."""
    values = Mixer().values
    for _ in range(ROUNDS):
        start = values

        def teach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, size = np.zeros(len(start)), 0
            for batch in batches:
                for bits, times in zip(batch["bits"], batch["times"], strict=True):
                    bits, times, mixer = np.cumsum(unpacked(bits, np.uint64), dtype=np.uint64), unpacked(times, np.uint32), Mixer(start)
                    order, share, steps = dealt(times)
                    fields = bits[order].view(np.uint8).reshape(-1, 8)
                    for own in steps:
                        *x, before, gate = np.ascontiguousarray(fields[own].T)[:len(ORDERS) + 2, :, None]
                        mixer.step([y.view(np.int8) for y in reversed(x)], gate >> 1, (gate & 1).view(np.int8), before[:, 0], share[own, None])
                    total, size = total + mixer.values * times.sum(dtype=np.int64), size + int(times.sum(dtype=np.int64))
            if size:
                yield pd.DataFrame({"k": np.arange(len(total)), "total": total, "size": size})

        sums = examples.mapInPandas(teach, "k int, total double, size long").groupBy("k").agg(F.sum("total"), F.sum("size")).collect()
        values = values.copy()
        for k, total, size in sums:
            values[k] = total / size
    return values


def kept(df: DataFrame, name: str) -> DataFrame:
    """``stored``, and the shuffles that led there go, as nothing reads them again."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return stored(df, name)
    finally:
        if before is None:
            conf.unset(key)
        else:
            conf.set(key, before)


def score(documents: DataFrame, learn: Column, text: str = "text", doc_id: str = "doc_id", taught: int = TUNED) -> DataFrame:
    """``(id, learned, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)`` of every row.

    All documents where ``learn`` holds are counted; of them one in ``taught``, all with 1, teach the weights and the refining table.
    """
    spark = documents.sparkSession
    role = F.when(learn & (F.pmod(F.xxhash64(doc_id, text), F.lit(taught)) == 0), 2).when(learn, 1).otherwise(0)
    packs = kept(blocks(documents, role, words_and_end, text, doc_id, PART, words_packed), "blocks")

    size = packs.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(8, size // (SHARE * BLOCK))
    answers = kept(word_counts(packs, buckets), "word-counts")
    learned, distinct = answers.agg(F.sum("words"), F.sum("distinct")).first()
    ends = packs.select(F.explode("roles").alias("role")).filter("role > 0").count()
    total, kinds = (learned or 0) + ends, (distinct or 0) + (ends > 0)
    wide = SPREAD * buckets
    predicted = kept(long_steps(packs, wide), "predictions")
    # Most pairs are nowhere, so the tables travel in a small part of their size.
    whole, left = (spark.sparkContext.broadcast([packed(t) for t in tables]) for tables in short_tables(predicted))
    mixer = Mixer(tuned(kept(tuning(packs, predicted, left, wide), "tuning")))

    def evaluate(key: tuple, block: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        ids, roles, words = block["ids"].iloc[0], block["roles"].iloc[0], Words(block["data"].iloc[0])
        (hashes, place), counts = words.hashed(), words.counts
        known = np.zeros(len(hashes), np.float64)
        asked = dict(parts(word_buckets(hashes, buckets), buckets))
        own = replies[replies["kind"] < 0]
        for bucket, reply in zip(own["bucket"], own["counts"], strict=True):
            known[asked[bucket]] = unpacked(reply, np.uint64)
        owner = np.repeat(np.arange(len(counts)), counts)
        logs = np.log10((known + 1) / (total + kinds + 1))
        base = np.bincount(owner, logs[place], len(counts)) + np.log10((ends + 1) / (total + kinds + 1))
        bits, sizes, roles = np.zeros(len(counts)), np.asarray(block["sizes"].iloc[0]), np.asarray(roles)
        tables = [unpacked(t, np.int8) for t in whole.value]
        for number, unit in units(words, sizes, roles):
            x, gate = inputs(unit, replies[replies["unit"] == number], wide)
            short = [steps.view(np.int64).ravel()[unit.pair_at].view(np.int8).reshape(-1, 8) for steps in short_steps(unit.pairs, tables)]
            unit.summed(mixer.bits([*short, *x], gate, unit.byte, unit.before), bits)
        return pd.DataFrame({
            "id": pd.array(list(ids), "Int64"), "learned": roles > 0, "n_tokens": counts + 1,
            "n_known": np.bincount(owner, known[place] > 0, len(counts)).astype(np.int64) + (ends > 0),
            "train_tokens": total, "base_score": base, "score": -bits * np.log10(2), "bits_per_byte": bits / sizes,
        })

    schema = "id long, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    nothing = F.lit(None).cast("binary")
    replies = answers.select(
        "block", F.lit(-1).alias("unit"), F.lit(-1).alias("kind"), "bucket", "counts",
        nothing.alias("elsewhere"), nothing.alias("steps"), nothing.alias("levels"),
    )
    replies = replies.union(predicted.select("block", "unit", "kind", "bucket", nothing, "elsewhere", "steps", "levels"))
    return packs.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(evaluate, schema)
