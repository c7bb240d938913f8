"""Neighbouring documents packed into blocks, and arrays of numbers packed to be shuffled."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

#: Bytes of text in a block, unless one document has more, and blocks that a batch may hold.
BLOCK, BATCH_BLOCKS = 1 << 22, 16
#: Blocks of which a bucket, to which all blocks send a part, holds the share of one.
SHARE = 8


def compressed(data: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def opened(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def packed(values: np.ndarray) -> bytes:
    """Numbers with their bytes grouped by place, so that equal high bytes compress."""
    flat = np.ascontiguousarray(values)
    return compressed(flat.view(np.uint8).reshape(-1, flat.itemsize).T.tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(opened(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def blocks(
    documents: DataFrame, role: Column, read: Callable[[str | None], bytes], text: str, doc_id: str, limit: int = BLOCK,
    pack: Callable[[list[bytes]], bytes] = lambda texts: compressed(b"".join(texts), 3),
) -> DataFrame:
    """Rows ``(block, ids, roles, sizes, data)`` with what ``read`` and ``pack`` make of the texts of neighbours.

    Meant to be stored: a block's number holds the task's, and rows keep their order in it.
    """
    small_batches(documents.sparkSession, BATCH_BLOCKS)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, rows, size = TaskContext.get().partitionId() << 32, [], 0

        def block() -> pd.DataFrame:
            ids, roles, texts = zip(*rows, strict=True)
            return pd.DataFrame({
                "block": [number], "ids": [list(ids)], "roles": [list(roles)], "sizes": [[len(t) for t in texts]],
                "data": [pack(list(texts))],
            })

        for batch in batches:
            for id_, own, value in zip(batch["id"], batch["role"], batch["text"], strict=True):
                data = read(value)
                if rows and size + len(data) > limit:
                    yield block()
                    number, rows, size = number + 1, [], 0
                rows.append((None if id_ is None else int(id_), int(own), data))
                size += len(data)
        if rows:
            yield block()

    given = documents.select(
        F.col(doc_id).cast("long").cast("string").alias("id"), role.cast("int").alias("role"), F.col(text).alias("text")
    )
    return given.mapInPandas(fill, "block long, ids array<long>, roles array<int>, sizes array<long>, data binary")


def buckets_for(packs: DataFrame) -> int:
    return max(8, packs.count() // SHARE)


def parts(bucket: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """For each bucket that has any, the places of its rows in their order."""
    order = np.argsort(bucket, kind="stable")
    borders = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [(k, order[a:b]) for k, (a, b) in enumerate(zip(borders[:-1], borders[1:], strict=True)) if a < b]
