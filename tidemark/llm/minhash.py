"""Near-duplicate documents by min-max hashing.

A document's set holds the distinct shingles of its words. Under each permutation both the least and the
largest hash of the set are kept, so half the hash evaluations give a signature of the same length. Bands
of ``ROWS`` values bring similar documents together: two of similarity 0.8 share none of the ``BANDS``
bands about once in 40,000 times, and two of similarity 0.1, as any two texts may have, share one about
once in 100,000 times, so that buckets fill slowly as the corpus grows.

Documents with equal sets are one class, of which only the smallest id goes on. Within a band's bucket
no pairs are listed: each member is compared with the bucket's smallest id, on the full sets of their
texts. In the most crowded of its buckets, each is also dealt into small groups by hash, several times,
and compared with the first of its group, which joins nearly all of a family whose members differ much
from the smallest id. Members of a bucket that are in different components even so are then compared one by
one, those outside the bucket's largest component with all others, if as many values of their signatures
agree as those of nearly all links do. So no pair that shares a bucket is left open.

Defined results: a text that is null, empty or without words has an empty set and links with nothing.
With fewer words than a shingle has, the whole sequence is the one shingle. Each input row is returned.
Rows that share an id are one document, which links as any of them does: all that differ are compared. A null id is its own component,
null, and is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, run_starts, slices, small_batches, stored
from tidemark.llm.components import components

#: Bands and values in a band; permutations, of which two values each are cut into bands in several orders.
BANDS, ROWS, PERMUTATIONS = 72, 7, 64
SEED = 20_240_611
#: Characters hashed together, and hash values of one document held together.
CHUNK, WIDTH = 1 << 21, 1 << 14
#: Members of a bucket's groups, on average, and how often a crowded bucket is dealt into groups.
GROUP, DRAWS = 8, 4
#: Shingles on each side of a tile, about; what a small set counts as at least; columns of a tile's product taken together.
TILE, LEAST, COLUMNS = 1 << 18, 128, 4096
#: Bits of the map of ids that keeps other texts out of a shuffle: 8 MB at most, however many ids there are.
ID_BITS = 1 << 26


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z lowered: bytes know no other letters and white space than ASCII's."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size)), strict=False))


def _stir(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of the shingles of a sequence of word hashes, in order."""
    size = min(size, len(hashes))
    count = len(hashes) - size + 1
    found = np.full(count, size, np.uint64)
    for k in range(size):
        found = _stir(found * np.uint64(3) + hashes[k:k + count])
    found.sort()
    return found[np.append(True, found[1:] != found[:-1])]


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest value of a set under each permutation."""
    draw = np.random.default_rng(SEED)
    times = draw.integers(0, 1 << 63, (PERMUTATIONS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
    plus = draw.integers(0, 1 << 63, (PERMUTATIONS, 1), np.uint64)
    least = np.full(PERMUTATIONS, ~np.uint64(0))
    largest = np.zeros(PERMUTATIONS, np.uint64)
    for k in range(0, len(shingles), WIDTH):
        values = shingles[k:k + WIDTH] * times + plus
        least, largest = np.minimum(least, values.min(1)), np.maximum(largest, values.max(1))
    return least, largest


def bands(least: np.ndarray, largest: np.ndarray) -> np.ndarray:
    """A hash of each band's values. Each order of all values is cut into bands that share none."""
    draw, values = np.random.default_rng(SEED + 1), np.append(least, largest)
    each = len(values) // ROWS
    picked = np.concatenate([draw.permutation(len(values))[:each * ROWS] for _ in range(BANDS // each)]).reshape(BANDS, ROWS)
    found = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        found = _stir(found * np.uint64(5) + values[picked[:, k]])
    return found.view(np.int64)


def hashed(texts: list[str | None], shingle: int) -> Iterator[np.ndarray | None]:
    """Distinct shingle hashes of each text, in order; None for one without words."""
    for a, b in slices(np.array([len(t or "") for t in texts]), CHUNK):
        words = [words_of(t) for t in texts[a:b]]
        flat = np.empty(sum(map(len, words)), object)
        flat[:] = [w for ws in words for w in ws]
        hashes, end = pd.util.hash_array(flat, categorize=False), 0
        for ws in words:
            start, end = end, end + len(ws)
            yield shingle_hashes(hashes[start:end], shingle) if ws else None


def fingerprint(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(documents: DataFrame, shingle: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(id, n_shingles, set, bands)`` of every row; ``set`` is a fingerprint that tells equal sets."""
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                (0, None, None) if own is None else (len(own), fingerprint(own), bands(*signature(own)))
                for own in hashed(batch["text"].tolist(), shingle)
            ]
            yield pd.DataFrame({
                "id": batch["id"].astype("Int64"), "n_shingles": [f[0] for f in found],
                "set": [f[1] for f in found], "bands": [f[2] for f in found],
            })

    given = documents.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return given.mapInPandas(run, "id long, n_shingles long, set binary, bands array<long>")


def likely_among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Those of ``rows`` whose ``id`` may be one of ``ids``: all that are, and of the others the more, the fuller the map of bits is.

    What is broadcast is that map, in parts of 32,768 bits, whose size ``ID_BITS`` bounds.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(ID_BITS))
    maps = ids.groupBy(F.bitmap_bucket_number(place).alias("_part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_map"))
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_map", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("_part", F.bitmap_bucket_number(place)).join(F.broadcast(maps), "_part")
    return found.filter(F.getbit(byte, (bit % 8).cast("int")) == 1).select(rows.columns)


def texts_of(documents: DataFrame, nodes: DataFrame, shingle: int, text: str, doc_id: str) -> DataFrame:
    """``(set, text)`` of each of ``nodes (set, id)``: of several rows with its id, one that has its set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            marks = [None if own is None else fingerprint(own) for own in hashed(batch["text"].tolist(), shingle)]
            yield pd.DataFrame({"set": marks, "id": batch["id"].astype("Int64"), "text": batch["text"]})

    given = documents.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    # Texts are told from others before anything is shuffled; those that only seem to be members go in the join.
    read = likely_among(given, nodes.select("id")).mapInPandas(run, "set binary, id long, text string")
    return read.join(nodes, ["set", "id"]).select("set", "text").dropDuplicates(["set"])


def linked_pairs(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The ids ``(a, b)`` of those pairs ``(a, b, left_set, right_set)`` whose sets, taken from the whole texts, are similar enough."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, own = None, set()
        for batch in batches:
            good = []
            for a, b in zip(batch["left"], batch["right"], strict=True):
                if a != last:
                    last, own = a, shingle_set(a, shingle)
                other = shingle_set(b, shingle)
                both = len(own & other)
                good.append(100 * both >= percent * (len(own) + len(other) - both))
            yield batch.loc[good, ["a", "b"]]

    right = texts.select(F.col("set").alias("right_set"), F.col("text").alias("right"))
    left = texts.select(F.col("set").alias("left_set"), F.col("text").alias("left"))
    both = pairs.join(right, "right_set").join(left, "left_set").select("a", "b", "left", "right")
    return both.mapInPandas(run, "a long, b long")


def shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many hashes each of ``left`` has in common with each of ``right``, by products over the hashes that both sides have."""
    sides = []
    for sets in (left, right):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        sides.append((row, np.concatenate([np.zeros(0, np.int64), *sets])))
    common = np.intersect1d(*(np.unique(values) for _, values in sides))
    found = np.zeros((len(left), len(right)), np.float32)
    placed = []
    for row, values in sides:
        at = np.searchsorted(common, values)
        known = at < len(common)
        known[known] = common[at[known]] == values[known]
        row, at = row[known], at[known]
        order = np.argsort(at, kind="stable")
        placed.append((row[order], at[order]))
    for start in range(0, len(common), COLUMNS):
        width = min(COLUMNS, len(common) - start)
        parts = []
        for (row, at), sets in zip(placed, (left, right), strict=True):
            a, b = np.searchsorted(at, [start, start + width])
            part = np.zeros((len(sets), width), np.float32)
            part[row[a:b], at[a:b] - start] = 1
            parts.append(part)
        found += parts[0] @ parts[1].T
    return found.astype(np.int64)


def joining(links: Iterator[tuple[int, int]], component: list[int]) -> Iterator[tuple[int, int]]:
    """Those links of places that join components which the links before them left apart."""
    low = {c: c for c in component}

    def root(c: int) -> int:
        while low[c] != c:
            low[c] = c = low[low[c]]
        return c

    for x, y in links:
        a, b = root(component[x]), root(component[y])
        if a != b:
            low[max(a, b)] = min(a, b)
            yield x, y


def uncovered(open_: DataFrame) -> DataFrame:
    """The members of those open buckets that don't lie within another one as a whole.

    Each member's home is the most crowded of its open buckets. Where all members of a bucket have the same
    home, they are together there, and all their pairs are compared there.
    """
    home = open_.groupBy("set").agg(F.max_by("bucket", F.struct("size", "bucket")).alias("home"))
    spread = open_.select("bucket", "set").join(home, "set").groupBy("bucket").agg(F.min("home").alias("low"), F.max("home").alias("high"))
    needed = spread.filter((F.col("low") != F.col("high")) | (F.col("low") == F.col("bucket"))).select("bucket")
    return open_.join(needed, "bucket", "left_semi")


def tiles(open_: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs ``(a, b, left_set, right_set)`` that join components within buckets, found by comparing all that are apart.

    ``open_`` has ``(bucket, id, set, n_shingles, component, main)``. A bucket's members outside its main component
    are dealt over the rows of its tiles, and all its members over the columns.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [own.view(np.int64) for own in hashed(batch["text"].tolist(), shingle)]
            yield pd.DataFrame({"set": batch["set"], "shingles": found})

    wanted = open_.select("set").distinct()
    hashes = texts.join(wanted, "set", "left_semi").mapInPandas(read, "set binary, shingles array<long>")
    apart, weight = F.col("component") != F.col("main"), F.greatest("n_shingles", F.lit(LEAST))
    dealt = open_.groupBy("bucket").agg(
        F.ceil(F.sum(F.when(apart, weight)) / TILE).alias("down"), F.ceil(F.sum(weight) / TILE).alias("across"), F.sum(weight).alias("weight")
    )
    # Buckets of one tile share a group with others.
    together = max(1, (dealt.filter("across = 1").agg(F.sum("weight")).first()[0] or 0) // TILE)
    group = F.when(F.col("across") == 1, F.pmod(F.xxhash64("bucket"), F.lit(together))).otherwise(F.col("bucket"))
    placed = open_.join(dealt, "bucket").withColumn("group", group).withColumn("alone", F.col("across") > 1)
    row, column = (F.pmod(F.xxhash64("set", F.lit(k)), F.col(n)) for k, n in enumerate(("down", "across")))
    all_rows, all_columns = (F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)) for n in ("down", "across"))
    own = ("group", "alone", "bucket", "id", "set", "component")
    sides = placed.filter(apart).select(*own, F.lit(True).alias("is_left"), row.alias("row"), all_columns.alias("column")).union(
        placed.select(*own, F.lit(False), all_rows, column)
    )

    def compare(given: pd.DataFrame) -> pd.DataFrame:
        given = given.sort_values(["bucket", "is_left"], kind="stable")
        ids, marks, component, is_left = (given[n].to_numpy() for n in ("id", "set", "component", "is_left"))
        sets, bucket, found = given["shingles"].tolist(), given["bucket"].to_numpy(), []
        starts = run_starts(bucket).tolist()
        for a, e in zip(starts, [*starts[1:], len(bucket)], strict=True):
            middle = e - int(is_left[a:e].sum())  # the right side, then the left one
            common = shared(sets[middle:e], sets[a:middle])
            size = np.array([len(s) for s in sets[a:e]])
            union = size[middle - a:, None] + size[None, :middle - a] - common
            linked = (100 * common >= percent * union) & (component[middle:e, None] != component[None, a:middle])
            places = ((middle - a + x, y) for x, y in zip(*(k.tolist() for k in np.nonzero(linked)), strict=True))
            found += [(a + x, a + y) for x, y in joining(places, component[a:e].tolist())]
        x, y = (np.array([f[k] for f in found], np.int64) for k in (0, 1))
        return pd.DataFrame({"a": ids[x], "b": ids[y], "left_set": marks[x], "right_set": marks[y]})

    return sides.join(hashes, "set").groupBy("group", "alone", "row", "column").applyInPandas(
        compare, "a long, b long, left_set binary, right_set binary"
    )


def near_duplicates(
    documents: DataFrame, shingle: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` of every row."""
    marked = stored(signatures(documents, shingle, text, doc_id), "signatures")
    known = marked.filter("id IS NOT NULL AND n_shingles > 0")
    classes = known.groupBy("set").agg(F.min("id").alias("class"))
    same = known.select("id", "set").join(classes, "set").filter("id <> class").select(F.col("id").alias("a"), F.col("class").alias("b"))
    # Each distinct set once, with the smallest id that has it. Its buckets are shuffled with that id and a short mark of the
    # set; should sets of one id share a mark, each joins the other's buckets, where it is compared like any member.
    nodes = known.groupBy("set").agg(F.min_by(F.struct("id", "n_shingles"), "id").alias("n")).select("set", "n.*", F.hash("set").alias("mark"))
    first = known.groupBy("set").agg(F.min_by(F.struct("id", "bands"), "id").alias("n")).select("n.id", F.hash("set").alias("mark"), "n.bands")
    spread = first.select("id", "mark", F.explode("bands").alias("bucket"))
    crowd = spread.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    together = spread.join(crowd, "bucket").join(nodes, ["id", "mark"])
    members = stored(together.select("bucket", "id", "set", "n_shingles", "size"), "members")
    texts = stored(texts_of(documents, members.select("set", "id").distinct(), shingle, text, doc_id), "texts")

    def compare(pairs: DataFrame) -> DataFrame:
        return checkpointed(linked_pairs(pairs.distinct(), texts, shingle, percent))

    def with_first(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
        """Every member of a group with the one that comes first in it."""
        first_ = rows.groupBy(*groups).agg(F.min_by(F.struct("id", "n_shingles", "set"), F.struct("place", "id", "set")).alias("c"))
        sizes_allow = 100 * F.least("n_shingles", "c.n_shingles") >= percent * F.greatest("n_shingles", "c.n_shingles")
        both = rows.join(first_, [*groups]).filter((F.col("set") != F.col("c.set")) & sizes_allow)
        ordered = F.col("set") < F.col("c.set")
        pick = lambda own, other: F.when(ordered, F.col(own)).otherwise(F.col(other))
        return both.select(
            pick("id", "c.id").alias("a"), pick("c.id", "id").alias("b"),
            pick("set", "c.set").alias("left_set"), pick("c.set", "set").alias("right_set"),
        )

    home = members.filter(F.col("size") > GROUP).groupBy("set").agg(
        F.max_by(F.struct("id", "bucket", "size", "n_shingles"), F.struct("size", "bucket")).alias("home")
    ).select("set", "home.*")
    deal = home.withColumn("draw", F.explode(F.array(*[F.lit(k) for k in range(DRAWS)])))
    deal = deal.withColumn("group", F.pmod(F.xxhash64("set", "draw"), F.ceil(F.col("size") / GROUP)))
    nearby = with_first(deal.withColumn("place", F.xxhash64("set", "draw", F.lit(1))), ["bucket", "draw", "group"])
    stars = with_first(members.withColumn("place", F.col("id")), ["bucket"])
    links = same.union(compare(stars.union(nearby)))
    reached = components(links)

    now = members.join(reached, "id", "left").withColumn("component", F.coalesce("component", "id"))
    parts = now.groupBy("bucket", "component").agg(F.count("*").alias("n"), *[
        F.sum(F.xxhash64("set", F.lit(k)).cast("decimal(20,0)")).alias(f"mark{k}") for k in (0, 1)
    ]).groupBy("bucket").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts"), F.sum("n").alias("size"),
        F.sum("mark0").alias("mark0"), F.sum("mark1").alias("mark1"),
    ).filter("parts > 1")
    # Buckets with the same members, told by two sums over their sets' hashes, need one comparison.
    parts = parts.groupBy("size", "mark0", "mark1").agg(F.min_by(F.struct("bucket", "main"), "bucket").alias("b")).select("b.*")
    open_ = checkpointed(now.join(parts, "bucket").select("bucket", "id", "set", "size", "n_shingles", "component", "main"))
    found = compare(tiles(uncovered(open_), texts, shingle, percent))
    reached = components(reached.select(F.col("id").alias("a"), F.col("component").alias("b")).union(found))
    return marked.join(reached, "id", "left").select(
        "id", "n_shingles", F.coalesce("component", "id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
