"""Language identification by rank-order profiles of character n-grams.

Each language's profile holds its ``PROFILE`` most frequent 1- to 3-grams in order, counted over all
training documents. A document's own most frequent n-grams are compared with each profile: the
out-of-place distance sums how far each n-gram stands from its place in the profile, ``PROFILE`` for
one that the profile lacks. The nearest language is the prediction.

Letters are lower-cased; each run of other characters is one boundary, written as a space, and each
text begins and ends with one. In n-grams a boundary stands at an end only. Ties between equally
frequent n-grams go by code points, ties between languages by name.

Defined results: a text that is null, empty or without letters is ``und`` with score 0, as is every
text if nothing could be learned. Repeated rows stay repeated; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import run_starts, slices, small_batches

#: N-grams in a profile. With the number of languages this bounds the model.
PROFILE = 400
#: Characters that are counted at once in a task.
CHUNK = 1 << 20
#: Bits of a code point in an n-gram's number. Missing places are 0.
BITS = 21
BOUNDARY = 32
UNKNOWN = "und"

Grams = tuple[np.ndarray, np.ndarray, np.ndarray]


def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def count_grams(owners: np.ndarray, texts: list[str], letters: np.ndarray) -> Grams:
    """Owner, n-gram and count of all 1- to 3-grams of the texts, ordered by owner and n-gram."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join(f" {t} " for t in lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(lowered)), [len(t) + 2 for t in lowered])
    codes = np.where(letters[codes], codes, BOUNDARY).astype(np.int64)
    keep = codes != BOUNDARY
    keep[1:] |= keep[:-1].copy()  # the first place of a run without letters
    keep[np.flatnonzero(np.diff(text, prepend=-1))] = True
    codes, text = codes[keep], text[keep]
    alphabet = np.flatnonzero(np.bincount(codes))
    place = np.zeros(alphabet[-1] + 1, np.int64)
    place[alphabet] = np.arange(1, len(alphabet) + 1)
    c, size, letter = place[codes], len(alphabet) + 1, codes != BOUNDARY
    who = np.asarray(owners, np.int64)[text] * size**3
    two = (text[:-1] == text[1:]) & (letter[:-1] | letter[1:])
    three = (text[:-2] == text[2:]) & letter[1:-1]
    key = np.sort(np.concatenate([
        (who + c)[letter],
        (who[1:] + c[:-1] * size + c[1:])[two],
        (who[2:] + (c[:-2] * size + c[1:-1]) * size + c[2:])[three],
    ]))
    first = run_starts(key)
    count = np.diff(np.append(first, len(key)))
    owner, gram = np.divmod(key[first], size**3)
    names = np.append(0, alphabet)
    gram = (names[gram // size**2] << BITS | names[gram // size % size]) << BITS | names[gram % size]
    return owner, gram, count


def learn(documents: DataFrame, text: str = "text", lang: str = "lang", profile: int = PROFILE) -> dict[str, list[int]]:
    """The profile of every non-null value of ``lang``: its most frequent n-grams, most frequent first."""
    small_batches(documents.sparkSession)

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, seen = letter_table(), pd.DataFrame({"lang": [], "gram": [], "n": []})
        for batch in batches:
            names, owner = np.unique(batch["lang"].to_numpy(object), return_inverse=True)
            for a, b in slices(batch["text"].str.len().to_numpy(), CHUNK):
                who, gram, n = count_grams(owner[a:b], batch["text"].tolist()[a:b], letters)
                part = pd.DataFrame({"lang": names[who], "gram": gram, "n": n})
                seen = pd.concat([seen, part]) if len(seen) else part
            seen = seen.groupby(["lang", "gram"], as_index=False)["n"].sum()
        if len(seen):
            yield seen

    labelled = documents.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    totals = labelled.mapInPandas(counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = totals.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= profile)
    found: dict[str, list[int]] = {}
    for row in sorted(best.collect(), key=lambda r: (r["lang"], r["place"])):  # profile x languages rows at most
        found.setdefault(row["lang"], []).append(row["gram"])
    return found


def predict(documents: DataFrame, profiles: dict[str, list[int]], text: str = "text", profile: int = PROFILE, into: str = "prediction") -> DataFrame:
    """All columns of ``documents`` and ``into``, a ``struct<lang, score>``.

    The score is 1 for a document whose n-grams all stand in their places, 0 if the profile has none of them.
    """
    small_batches(documents.sparkSession)
    langs = sorted(profiles)
    grams = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
    places = np.full((len(langs), len(grams) + 1), -1, np.int64)
    for k, name in enumerate(langs):
        places[k, np.searchsorted(grams, np.array(profiles[name], np.int64))] = np.arange(len(profiles[name]))

    def nearest(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best, score = np.full(len(texts), len(langs)), np.zeros(len(texts))
        owner, gram, count = count_grams(np.arange(len(texts)), texts, letters)
        if not len(owner) or not langs:
            return best, score
        order = np.lexsort((gram, -count, owner))
        owner, gram = owner[order], gram[order]
        first = run_starts(owner)
        place = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
        owner, gram, place = owner[place < profile], gram[place < profile], place[place < profile]
        at = np.searchsorted(grams, gram)
        at[grams[np.minimum(at, len(grams) - 1)] != gram] = len(grams)
        used = np.bincount(owner, minlength=len(texts))
        distance = np.array([
            np.bincount(owner, np.where(p[at] < 0, profile, np.abs(p[at] - place)), len(texts)) for p in places
        ])
        some = used > 0
        best[some] = distance[:, some].argmin(0)
        score[some] = 1 - distance[:, some].min(0) / (profile * used[some])
        return best, score

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters, names = letter_table(), np.array([*langs, UNKNOWN], object)
        for batch in batches:
            texts = batch.fillna("").tolist()
            parts = [nearest(texts[a:b], letters) for a, b in slices(np.array([len(t) for t in texts]), CHUNK)]
            yield pd.DataFrame({
                "lang": names[np.concatenate([p[0] for p in parts])] if parts else [],
                "score": np.concatenate([p[1] for p in parts]) if parts else [],
            })

    judge.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return documents.withColumn(into, F.pandas_udf(judge, "lang string, score double")(F.col(text)))


def known_language(prediction: Column) -> Column:
    """Whether a prediction names a language at all."""
    return prediction["lang"] != UNKNOWN
