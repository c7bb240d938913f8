"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For each prefix of a piece of text exactly one token can be the last one of the prefix's encoding.
``Prefixes`` stores that token for every prefix. It is found without merging: of the tokens that end
at the prefix's end, it is the one that agrees with the last token of what stands before it, and two
neighbours agree if the merges on both sides of their seam leave them apart. So a prefix's encoding
never depends on what follows: appending bytes adds entries, and after an edit only entries behind it
are found again, until they agree with the former ones.

Texts are cut into pieces by a pattern first, and each piece is encoded on its own, as the public
tokenizer library does. Special tokens are ordinary text.

Defined results: a null or empty text has no ids and decodes to no bytes. Ids outside the vocabulary
raise an error in ``decode``. Repeated rows stay repeated; other columns stay as they are.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import slices, small_batches

#: Words whose ids a task keeps besides those of the texts at hand, and their length at most.
CACHED_WORDS, CACHED_LENGTH = 600_000, 64
#: Characters that are encoded together.
CHUNK = 1 << 22
#: Seams of which a task keeps whether they hold.
CACHED_SEAMS = 2_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a vocabulary file: a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Tokens by rank, and the two tokens whose merge makes each."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.token = {rank: token for token, rank in ranks.items()}
        self.seams: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        #: Tokens that merges lead to, which all but a few are.
        self.reachable = {token: rank for token, rank in ranks.items() if len(token) == 1}
        self.longest = 1
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            # Merges that make a token use earlier ones only, and those are known by now.
            if len(token) > 1 and (made := self._halves(token)):
                self.halves[rank], self.merged[made], self.reachable[token] = made, rank, rank
                self.longest = max(self.longest, len(token))

    def _halves(self, token: bytes) -> tuple[int, int] | None:
        """The two tokens that merges of lower ranks make of a token's bytes; None if they are more."""
        parts = [bytes([b]) for b in token]
        while len(parts) > 2:
            steps = [(self.reachable.get(parts[i] + parts[i + 1]), i) for i in range(len(parts) - 1)]
            step = min((s for s in steps if s[0] is not None), default=None)
            if step is None:
                return None
            parts[step[1]:step[1] + 2] = [parts[step[1]] + parts[step[1] + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for token, rank in self.reachable.items():
            found.add_word(token.decode("latin-1"), (rank, len(token)))
        found.make_automaton()
        return found

    def plain(self) -> dict:
        """What to send to tasks: plain values, without what each task makes for itself."""
        return {k: v for k, v in self.__dict__.items() if k not in ("seams", "automaton")}

    @classmethod
    def restored(cls, plain: dict) -> Vocabulary:
        found = cls.__new__(cls)
        found.__dict__.update(plain, seams={})
        return found

    def apart(self, left: int, right: int) -> bool:
        """Whether encoding the bytes of both tokens together gives just these two.

        The merges inside both tokens are undone in turn, the latest first. The two parts that then
        meet at the seam must not have a merge of their own that comes before the one just undone.
        """
        limit = 1 << 62
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < limit:
                return False
            inner_left, inner_right = self.halves.get(left), self.halves.get(right)
            if inner_left and (left > right or not inner_right):
                limit, left = left, inner_left[1]
            elif inner_right:
                # Of equal merges the left one comes first, so one as late as this still wins.
                limit, right = right + 1, inner_right[0]
            else:
                return True

    def holds(self, left: int, right: int) -> bool:
        """``apart``, kept for the next time."""
        if len(self.seams) >= CACHED_SEAMS:
            self.seams.clear()
        found = self.seams[left << 32 | right] = self.apart(left, right)
        return found


class Prefixes:
    """The last token of every prefix of some bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self._find(len(self.data))

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Put ``data`` in the place of a range; how many entries had to be found again.

        Entries before the range stay. Behind it, they hold again once as many neighbouring ones agree
        with the former as the longest token has bytes, for later entries depend on these only.
        """
        former, width = self.last[end:], self.vocabulary.longest
        self.data = self.data[:start] + data + self.data[end:]
        del self.last[start:]
        at = start + len(data)
        self._find(at)
        for done in range(0, len(former) + 1, width):
            if done and self.last[at + done - width:] == former[done - width:done]:
                self.last += former[done:]
                return at + done - start
            self._find(min(at + done + width, len(self.data)))
        return len(self.data) - start

    def _find(self, end: int) -> None:
        """Add entries up to a prefix of ``end`` bytes."""
        begin = max(0, len(self.last) - self.vocabulary.longest + 1)
        last_tokens(self.vocabulary, self.data[:end].decode("latin-1"), self.last, begin)
        if len(self.last) < end:
            raise ValueError("the vocabulary lacks a byte")

    def ids(self) -> list[int]:
        return list(walk_back(self.vocabulary, self.last, 0, len(self.data)))


#: Stands between pieces that are encoded together: a character that no byte is written as.
GAP = "Ā"


def last_tokens(vocabulary: Vocabulary, data: str, last: list[int], begin: int = 0) -> None:
    """Add to ``last`` the last token of every further prefix of ``data``, its bytes written as characters.

    The automaton gives all tokens that end at each place, the longest first. Where it gives none stands
    a gap, and prefixes are counted from there.
    """
    known, holds, want, base = vocabulary.seams.get, vocabulary.holds, len(last), 0
    for at, (token, size) in vocabulary.automaton.iter(data, begin):
        if at < want:
            continue
        if at > want:
            last.append(-1)
            want = base = at
        if at - base >= size:
            left = last[at - size]
            fits = known(left << 32 | token)
            if not (holds(left, token) if fits is None else fits):
                continue
        last.append(token)
        want += 1


def walk_back(vocabulary: Vocabulary, last: list[int], start: int, end: int) -> tuple[int, ...]:
    """The tokens of a range whose prefixes' last tokens are known."""
    found, token = [], vocabulary.token
    while end > start:
        found.append(last[end - 1])
        end -= len(token[found[-1]])
    found.reverse()
    return tuple(found)


class EncodedText:
    """A text cut into encoded pieces, which can be edited."""

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary, self.text = vocabulary, text
        self.starts, self.pieces = self._cut(0, len(text), set(), 0)[:2]

    def ids(self) -> list[int]:
        return [i for piece in self.pieces for i in piece]

    def append(self, text: str) -> None:
        self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, end: int, text: str) -> None:
        """Put ``text`` in the place of a range. Pieces that the edit can't reach are kept.

        Whether a piece of white space takes its last character hangs on what follows the run. So cutting
        starts again at the last piece before the edit that doesn't begin with white space, and ends
        behind the edit at the first place where a piece began before too.
        """
        keep = len(self.starts) - 1
        while keep > 0 and not (
            keep + 1 < len(self.starts) and self.starts[keep + 1] < start and not self.text[self.starts[keep]].isspace()
        ):
            keep -= 1
        keep, shift = max(keep, 0), len(text) - (end - start)
        old = {s + shift: k for k, s in enumerate(self.starts) if s >= end}
        self.text = self.text[:start] + text + self.text[end:]
        begin = self.starts[keep] if self.starts else 0
        starts, pieces, met = self._cut(begin, len(self.text), old.keys(), start + len(text))
        tail = old[met] if met is not None else len(self.starts)
        self.pieces = self.pieces[:keep] + pieces + self.pieces[tail:]
        self.starts = self.starts[:keep] + starts + [s + shift for s in self.starts[tail:]]

    def _cut(self, begin: int, end: int, known: set[int], behind: int) -> tuple[list[int], list[list[int]], int | None]:
        starts, pieces = [], []
        for match in self.vocabulary.pattern.finditer(self.text, begin, end):
            if match.start() >= behind and match.start() in known:
                return starts, pieces, match.start()
            starts.append(match.start())
            pieces.append(encode_piece(self.vocabulary, match.group().encode()))
        return starts, pieces, None


def encode_piece(vocabulary: Vocabulary, piece: bytes) -> list[int]:
    """A piece that is a token is that token, even if no merges lead to it."""
    whole = vocabulary.ranks.get(piece)
    return [whole] if whole is not None else Prefixes(vocabulary, piece).ids()


#: Before a blank that a character other than white space follows, every pattern of this kind cuts.
BLANK = re.compile(r" (?=\S)")


class Encoder:
    """Encodes texts word by word and keeps the ids of short words and pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.words, self.pieces = vocabulary, {}, {}

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text. Words and pieces that are new here are found together, each once."""
        cut = [BLANK.split(text) for text in texts]
        heads = [[i for piece in self.vocabulary.pattern.findall(c.pop(0)) for i in self._piece(piece)] for c in cut]
        words = self.words
        new = set().union(*cut).difference(words)
        if len(words) + len(new) > CACHED_WORDS:
            words.clear()
            new = set().union(*cut)
        words.update(self._words(list(new)))
        found = [[*head, *chain.from_iterable(map(words.__getitem__, c))] for head, c in zip(heads, cut, strict=True)]
        for word in new:
            if len(word) > CACHED_LENGTH:
                del words[word]
        return found

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def _piece(self, piece: str) -> tuple[int, ...]:
        known = self.pieces.get(piece)
        return tuple(encode_piece(self.vocabulary, piece.encode())) if known is None else known

    def _words(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of words that a blank stands before."""
        pieces = self.vocabulary.pattern.findall("".join(f" {word}" for word in words))
        known, ranks = self.pieces, self.vocabulary.ranks
        new = [p for p in set(pieces) if p not in known]
        data = [p.encode() for p in new]
        last: list[int] = []
        last_tokens(self.vocabulary, GAP.join(d.decode("latin-1") for d in data), last)
        fresh, start = {}, 0
        for piece, raw in zip(new, data, strict=True):
            whole = ranks.get(raw)
            end = start + len(raw)
            fresh[piece] = walk_back(self.vocabulary, last, start, end) if whole is None else (whole,)
            start = end + 1
        found, at = {}, -1
        for piece in pieces:
            ids = known.get(piece)
            ids = fresh[piece] if ids is None else ids
            # A word's first piece, and no other, begins with a blank before something else.
            if piece[0] == " " and len(piece) > 1 and not piece[1].isspace():
                at += 1
                found[words[at]] = ids
            else:
                found[words[at]] += ids
        if len(known) + len(fresh) > CACHED_WORDS:
            known.clear()
        known.update((k, v) for k, v in fresh.items() if len(k) <= CACHED_LENGTH)
        return found


def encode(text: Column, vocabulary: Broadcast) -> Column:
    """The ids of each text, as ``array<int>``. ``vocabulary`` is what ``load`` gives.

    The column is marked as not deterministic only so that Spark computes it once where it is used twice.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(Vocabulary.restored(vocabulary.value))
        for batch in batches:
            texts, flat, ends = [t or "" for t in batch.to_pylist()], [], [0]
            for a, b in slices(np.array([len(t) for t in texts]), CHUNK):
                for ids in encoder.encode_all(texts[a:b]):
                    flat += ids
                    ends.append(len(flat))
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<int>").asNondeterministic()(text)


def decode(ids: Column, vocabulary: Broadcast) -> Column:
    """The bytes that the ids stand for; no bytes for a null array."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = vocabulary.value["token"]
        size = np.zeros(max(token, default=0) + 1, np.int64)
        for rank, value in token.items():
            size[rank] = len(value)
        start = np.cumsum(size) - size
        data = np.frombuffer(b"".join(token[r] for r in sorted(token)), np.uint8)
        for batch in batches:
            counts = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            values = batch.flatten().to_numpy(zero_copy_only=False)
            if len(values) and (values.min() < 0 or values.max() >= len(size) or not size[values].all()):
                raise ValueError("an id is not in the vocabulary")
            long = size[values]
            ends = np.cumsum(long)
            taken = data[np.repeat(start[values] - (ends - long), long) + np.arange(long.sum())]
            borders = np.append(0, np.append(0, ends)[np.cumsum(counts)]).astype(np.int32)
            yield pa.Array.from_buffers(
                pa.binary(), len(batch), [None, pa.py_buffer(borders), pa.py_buffer(np.ascontiguousarray(taken))]
            )

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "binary")(ids)


def load(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """The vocabulary of a file for all executors. Its size is the file's, whatever the documents."""
    small_batches(spark)
    return spark.sparkContext.broadcast(Vocabulary(read_ranks(path), pattern).plain())
