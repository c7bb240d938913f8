"""Which tokens of two tokenizers cover the same bytes of a corpus, and how often.

Both tokenizers encode the same bytes: a blank and the text. The first is byte-level BPE and gets the blank
with the text; the second adds it. Places where a token of each ends cut the tokens into groups, and tokens of
a group whose ranges overlap are linked. How often two ids are linked in the whole corpus says which id of
the first stands for an id of the second.

An array made beforehand gives for each id of the first tokenizer the id of the second with the same bytes.
Nearly all groups are of two such tokens alone. They are only counted, in a vector as long as the first
vocabulary, one a task. Links of the other groups are summed up in blocks of neighbouring documents, and
only a block's distinct pairs are shuffled: to be summed up over the corpus, and back to their block.

Defined results: a text that is null or empty has no tokens, nor has one whose tokens' bytes aren't those of
the blank and the text on either side; its counts are zeros and its groups the empty text. Special tokens'
strings in texts are ordinary text. Each input row is returned, repeated ones each, and each counts. A null id
is returned as null. Texts longer than ``SEGMENT`` are encoded in parts, cut where no token of either can
reach across; a part without such a place stays whole. Memory follows the longest text, as ids of 4 bytes.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.blocks import packed, unpacked
from tidemark.llm.common import small_batches, stored

#: Characters that are encoded together, and characters of the documents of a block, unless one has more.
SEGMENT, BLOCK = 1 << 20, 1 << 22
#: Texts in one Arrow batch.
BATCH = 128
#: Ids that a vocabulary may have: vectors of this length are sent to the driver and to tasks.
LARGEST_VOCABULARY = 1 << 20
#: A blank between characters that no normal form joins.
CUT = re.compile(r"(?<=[a-z0-9]) (?=[a-z0-9])", re.IGNORECASE | re.ASCII)


def byte_characters() -> dict[str, int]:
    """The bytes that characters of a byte-level vocabulary stand for.

    Printable Latin-1 characters stand for themselves, and the other bytes for the characters from 256 on.
    """
    own = [b for b in range(256) if chr(b).isprintable() and chr(b) != " "]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


def byte_level_tokens(text: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE in JSON, special tokens left out.

    Raises an error where the order of merges isn't that of ids, for then ids can't serve as ranks.
    """
    model, of = json.loads(text)["model"], byte_characters()
    tokens = [b""] * (max(model["vocab"].values()) + 1)
    for written, id_ in model["vocab"].items():
        if all(c in of for c in written):
            tokens[id_] = bytes(of[c] for c in written)
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if made != sorted(made):
        raise ValueError("merges are not in the order of their ids")
    return tokens


def piece_tokens(processor) -> list[bytes]:
    """The bytes of each id of a piece vocabulary."""
    found = []
    for id_ in range(processor.get_piece_size()):
        piece = processor.id_to_piece(id_)
        found.append(bytes([int(piece[3:5], 16)]) if processor.is_byte(id_) else piece.replace("▁", " ").encode())
    return found


@dataclass
class Tokenizers:
    """Both tokenizers, ready to encode: ``first`` and ``second`` give ids, the rest is about their bytes."""

    first: object
    second: object
    tokens: tuple[list[bytes], list[bytes]]
    sizes: tuple[np.ndarray, np.ndarray]
    same: np.ndarray  # for each id of the first the least id of the second with its bytes, or -1
    splits: bool  # whether no piece of the second goes on behind a character with a blank

    @classmethod
    def restored(cls, plain: dict) -> Tokenizers:
        import sentencepiece
        import tiktoken

        tokens = byte_level_tokens(plain["json"])
        first = tiktoken.Encoding(
            "first", pat_str=plain["pattern"], special_tokens={}, mergeable_ranks={t: k for k, t in enumerate(tokens) if t},
        )
        second = sentencepiece.SentencePieceProcessor(model_proto=plain["model"])
        pieces = piece_tokens(second)
        if max(len(tokens), len(pieces)) > LARGEST_VOCABULARY:
            raise ValueError(f"a vocabulary of more than {LARGEST_VOCABULARY} ids")
        by_bytes = {t: k for k, t in reversed(list(enumerate(pieces))) if not second.is_control(k) and not second.is_unknown(k)}
        return cls(
            first, second, (tokens, pieces), tuple(np.array([len(t) for t in side], np.int32) for side in (tokens, pieces)),
            np.array([by_bytes.get(t, -1) if t else -1 for t in tokens], np.int64),
            not any(re.search(rb"[^ ] ", p) for p in pieces),
        )

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both for a blank and the text; None if the bytes of one aren't those."""
        sides: tuple[list, list] = [], []
        for part in self._parts(text):
            whole = (" " + part).encode()
            for side, ids in zip((0, 1), (self.first.encode_ordinary(" " + part), self.second.encode(part)), strict=True):
                if b"".join(map(self.tokens[side].__getitem__, ids)) != whole:
                    return None
                sides[side].append(np.array(ids, np.int32))
        return tuple(np.concatenate(side) for side in sides)

    def _parts(self, text: str) -> Iterator[str]:
        start = 0
        while self.splits and len(text) - start > SEGMENT:
            cut = CUT.search(text, start + SEGMENT)
            if cut is None:
                break
            yield text[start:cut.start()]
            start = cut.end()
        yield text[start:]


@dataclass
class Links:
    """What links the tokens of texts: flat arrays over all texts, with their ends."""

    first: np.ndarray   # id of the first's token of each link
    second: np.ndarray
    known: np.ndarray   # whether the link is a group of its own, of ids with the same bytes
    ends: np.ndarray    # links up to the end of each text
    groups: np.ndarray  # groups of each text
    written: list[bytes]


def link(ids: list[tuple[np.ndarray, np.ndarray]], tokenizers: Tokenizers) -> Links:
    """The links of texts' ids, and each text's groups written out.

    Two tokens overlap in one range between neighbouring ends, and each such range is in one token of each
    side, so there is a link for each end.
    """
    if not ids:
        none = np.zeros(0, np.int64)
        return Links(none, none, none.astype(bool), none, none, [])
    a, b = (np.concatenate([pair[side] for pair in ids]) for side in (0, 1))
    ends_a, ends_b = (np.cumsum(tokenizers.sizes[side][own], dtype=np.int64) for side, own in ((0, a), (1, b)))
    last_a, last_b = (np.cumsum([len(pair[side]) for pair in ids]) for side in (0, 1))
    closes_a = ends_b[np.searchsorted(ends_b, ends_a)] == ends_a
    closes_b = ends_a[np.searchsorted(ends_a, ends_b)] == ends_b
    cuts = np.concatenate([ends_a, ends_b[~closes_b]])
    cuts.sort(kind="stable")
    at_a, at_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
    closes = (ends_a[at_a] == cuts) & (ends_b[at_b] == cuts)
    opens = np.append(True, closes[:-1])
    first, second = a[at_a].astype(np.int64), b[at_b].astype(np.int64)
    groups = np.cumsum(closes_a)[last_a - 1]
    return Links(
        first, second, opens & closes & (tokenizers.same[first] == second),
        np.searchsorted(cuts, ends_a[last_a - 1], "right"), np.diff(groups, prepend=0),
        _written(a, b, closes_a, closes_b, last_a + last_b),
    )


def _written(a: np.ndarray, b: np.ndarray, closes_a: np.ndarray, closes_b: np.ndarray, last: np.ndarray) -> list[bytes]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
    until_a, until_b = np.flatnonzero(closes_a) + 1, np.flatnonzero(closes_b) + 1
    group_a, group_b = (np.cumsum(c) - c for c in (closes_a, closes_b))
    ids, marks = np.empty(len(a) + len(b), np.int32), np.empty(len(a) + len(b), np.uint8)
    for place, own, mark in (
        (np.arange(len(a)) + np.append(0, until_b)[group_a], a, np.where(closes_a, ord("|"), ord(","))),
        (np.arange(len(b)) + until_a[group_b], b, np.where(closes_b, ord(";"), ord(","))),
    ):
        ids[place], marks[place] = own, mark
    width = len(str(int(ids.max())))
    letters = np.zeros((len(ids), width + 1), np.uint8)
    rest, more = ids.copy(), np.ones(len(ids), bool)
    for k in range(width - 1, -1, -1):
        letters[:, k] = np.where(more, rest % 10 + ord("0"), 0)
        rest //= 10
        more = rest > 0
    letters[:, width] = marks
    sizes = np.cumsum((letters > 0).sum(1))[last - 1]
    flat = letters.reshape(-1)
    flat = flat[flat > 0].tobytes()
    return [flat[s:e - 1] for s, e in zip([0, *sizes[:-1].tolist()], sizes.tolist(), strict=True)]


def load(spark: SparkSession, byte_level: str, pieces: str, pattern: str) -> Broadcast:
    """Two vocabulary files for all executors: byte-level BPE in JSON with its pattern, and a piece model."""
    with open(byte_level, encoding="utf-8") as one, open(pieces, "rb") as other:
        return spark.sparkContext.broadcast({"json": one.read(), "model": other.read(), "pattern": pattern})


PACK = (
    "block long, ids array<string>, n_a array<long>, n_b array<long>, n_groups array<long>, written array<string>, "
    "known binary, known_sizes array<long>, odd binary, odd_sizes array<long>, "
    "same_ids array<long>, same_times array<long>, pairs array<long>, times array<long>"
)


def packs(documents: DataFrame, tokenizers: Broadcast, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Blocks of neighbouring documents: each one's counts, ids of known links, and places of other links' pairs.

    ``pairs`` and ``times`` have the distinct pairs of the other links, as one number each. The last block of a
    task comes with ``same_ids`` and ``same_times``, how often each id is in a known link of the task's texts.
    """
    small_batches(documents.sparkSession, BATCH)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = Tokenizers.restored(tokenizers.value)
        block, seen = TaskContext.get().partitionId() << 32, np.zeros(len(both.same), np.int64)

        def done(rows: list, parts: list[Links]) -> dict:
            known = [p.first[p.known] for p in parts]
            odd = [(p.first[~p.known] << 32) | p.second[~p.known] for p in parts]
            place, pairs = pd.factorize(np.concatenate([np.zeros(0, np.int64), *odd]))
            sizes: dict[str, list[int]] = {"known": [], "odd": []}
            for p in parts:
                alone = np.diff(np.append(0, np.cumsum(p.known))[np.append(0, p.ends)])
                sizes["known"] += alone.tolist()
                sizes["odd"] += (np.diff(np.append(0, p.ends)) - alone).tolist()
            written = [w for p in parts for w in p.written]
            groups = [int(g) for p in parts for g in p.groups]
            full = [k for k, row in enumerate(rows) if row[1] is not None]
            out = {name: [0] * len(rows) for name in ("n_groups", "known_sizes", "odd_sizes")} | {"written": [""] * len(rows)}
            for at, k in enumerate(full):
                out["n_groups"][k], out["known_sizes"][k], out["odd_sizes"][k] = groups[at], sizes["known"][at], sizes["odd"][at]
                out["written"][k] = hashlib.sha256(written[at]).hexdigest()
            known = np.concatenate([np.zeros(0, np.int64), *known])
            seen[:] += np.bincount(known, minlength=len(seen))
            return out | {
                "block": block, "ids": [row[0] for row in rows],
                "n_a": [row[1][0] if row[1] else 0 for row in rows], "n_b": [row[1][1] if row[1] else 0 for row in rows],
                "known": packed(known.astype(np.int32)),
                "odd": packed(place.astype(np.int32)), "pairs": pairs, "times": np.bincount(place, minlength=len(pairs)),
                "same_ids": [], "same_times": [],
            }

        def frame(row: dict) -> pd.DataFrame:
            return pd.DataFrame({name: [value] for name, value in row.items()})

        rows, parts, fresh, held, size = [], [], [], 0, 0
        for batch in batches:
            for id_, value in zip(batch["id"], batch["text"], strict=True):
                value = value or ""
                if rows and size + len(value) > BLOCK:
                    parts.append(link(fresh, both))
                    yield frame(done(rows, parts))
                    block, rows, parts, fresh, held, size = block + 1, [], [], [], 0, 0
                elif fresh and held + len(value) > SEGMENT:
                    parts.append(link(fresh, both))
                    fresh, held = [], 0
                ids = both.encode(value) if value else None
                rows.append((id_, ids and tuple(map(len, ids))))
                if ids:
                    fresh.append(ids)
                held, size = held + len(value), size + len(value)
        if rows:
            parts.append(link(fresh, both))
            last, ids = done(rows, parts), np.flatnonzero(seen)
            yield frame(last | {"same_ids": ids, "same_times": seen[ids]})

    given = documents.select(F.col(doc_id).cast("long").cast("string").alias("id"), F.col(text).alias("text"))
    return given.mapInPandas(pack, PACK)


def key_of(first: Column, second: Column) -> Column:
    return F.shiftleft(first.cast("long"), 32).bitwiseOR(second.cast("long"))


def counts(blocks: DataFrame, same: np.ndarray) -> DataFrame:
    """``(pair, first, second, count, best)`` of every two ids that are linked anywhere.

    ``best`` marks the highest counts of the second id, ties included. The known links' ids are as many as
    the first vocabulary has, and a task sends each once.
    """
    known = blocks.select(F.inline(F.arrays_zip("same_ids", "same_times"))).toDF("first", "count")
    ids = blocks.sparkSession.createDataFrame(pd.DataFrame({"first": np.arange(len(same)), "second": same}))
    known = known.join(F.broadcast(ids), "first")
    odd = blocks.select(F.inline(F.arrays_zip("pairs", "times"))).toDF("pair", "count")
    every = known.select(key_of(F.col("first"), F.col("second")).alias("pair"), "count").union(odd)
    total = every.groupBy("pair").agg(F.sum("count").alias("count")).select(
        "pair", F.shiftright("pair", 32).alias("first"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("second"), "count",
    )
    total = stored(total, "pair-counts")
    highest = total.groupBy("second").agg(F.max("count").alias("highest"))  # as many as the second vocabulary has
    return total.join(F.broadcast(highest), "second").select(
        "pair", "first", "second", "count", (F.col("count") == F.col("highest")).alias("best")
    )


ROW = (
    "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, known_links long, groups_sha256 string"
)


def align(documents: DataFrame, tokenizers: Broadcast, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Rows of every document ``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, known_links, groups_sha256)``,
    and the linked ids that ``counts`` gives."""
    same = Tokenizers.restored(tokenizers.value).same
    blocks = stored(packs(documents, tokenizers, text, doc_id), "aligned")
    linked = stored(counts(blocks, same), "linked")
    # The known links' counts as a vector over the first vocabulary.
    known = {name: np.zeros(len(same), np.int64) for name in ("count", "best")}
    own = documents.sparkSession.createDataFrame(pd.DataFrame({
        "own": [int(k) << 32 | int(s) for k, s in enumerate(same) if s >= 0] or [-1]
    }))
    for r in linked.join(F.broadcast(own), F.col("pair") == F.col("own")).select("first", "count", "best").collect():
        known["count"][r["first"]], known["best"][r["first"]] = r["count"], r["best"]
    asked = blocks.select(F.col("block").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(linked, "pair").select("of", "place", "count", F.col("best").cast("long").alias("best"))

    def finish(pack: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        row, answer = pack.iloc[0], answer.sort_values("place")
        found = {name: np.asarray(row[name], np.int64) for name in ("n_a", "n_b", "n_groups", "known_sizes", "odd_sizes")}
        alone, odd = unpacked(row["known"], np.int32), unpacked(row["odd"], np.int32)

        def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
            ends = np.cumsum(sizes)
            run = np.append(0, np.cumsum(values))
            return run[ends] - run[ends - sizes]

        both = {
            name: sums(known[name][alone], found["known_sizes"]) + sums(answer[name].to_numpy(np.int64)[odd], found["odd_sizes"])
            for name in ("count", "best")
        }
        return pd.DataFrame({
            "id": pd.array([None if i is None else int(i) for i in row["ids"]], "Int64"),
            **{name: found[name] for name in ("n_a", "n_b", "n_groups")}, "n_links": found["known_sizes"] + found["odd_sizes"],
            "n_best": both["best"], "count_sum": both["count"], "known_links": found["known_sizes"], "groups_sha256": list(row["written"]),
        })

    rows = blocks.select(
        "block", "ids", "n_a", "n_b", "n_groups", "written", "known", "known_sizes", "odd", "odd_sizes"
    ).groupBy("block").cogroup(answers.groupBy("of")).applyInPandas(finish, ROW)
    return rows, linked
