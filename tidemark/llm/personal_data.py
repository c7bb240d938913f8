"""Personal data by candidates, boosted trees and calibrated thresholds, in Spark's own functions only.

Strict rules give the base spans: e-mail addresses, IP addresses, payment cards with a valid check digit,
and international phone numbers. Generators of high recall propose further spans, which may overlap:
what the strict patterns match but the checks refuse, addresses written with ``(at)`` or ``[dot]``, and
runs of digits with other separators. These are checked in their normal form: written-out signs
replaced, separators left out; a phone without ``+`` by its digits and a cue before it. Runs that are or
hold what a strict pattern has found already are no candidates of their own. Each candidate is described
by its format and its surroundings, without the checks. Boosted trees learn from the corpus itself which
descriptions go with spans that pass the checks; all they need is a count of candidates for each
description, which has a bounded number of rows and is summed over all documents. Half of the texts, by hash, are for fitting, the other half for
calibration: each kind's threshold is the lowest score above which candidates pass the checks as often as
``PRECISION`` and, as few of them say little, with a lower confidence bound of ``ASSURED``. Candidates above it are
added to the base spans, unless one of the same kind is there. ``propose`` finds the candidates once for both uses.

Positions are code points. The regular expressions never backtrack over long runs, and none retries a
run from its middle, so very long texts take time in proportion.

Defined results: a null or empty text has no spans. Where no score assures a kind's rate, nothing is added
to its base spans. Repeated rows stay repeated; other columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.binding import let

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# The strict patterns. They match what the same patterns with plain quantifiers match.
LOCAL, LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
STRICT = (
    rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[{LABEL}]++(?:\.[{LABEL}]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
WRITTEN_OUT = (
    rf"(?<![{LOCAL}])[{LOCAL}]{{1,64}}+\x20?(?:\(at\)|\[at\])\x20?[{LABEL}]{{1,63}}+"
    rf"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[{LABEL}]{{1,63}}+)++"
)
DIGIT_RUN = r"(?<![0-9])[0-9](?:[\x20./()_-]{0,2}+[0-9])++"
# Words before a span that speak for its kind.
CUES = (
    r"(?i)e-?mail|contact|write|@",
    r"(?i)\bip\b|host|server|address|addr",
    r"(?i)card|visa|master|payment|credit",
    r"(?i)tel|phone|call|mobile|fax",
)
#: Code points before a span that are searched for cues.
AROUND = 24
#: Trees, their depth and learning rate.
TREES, DEPTH, RATE = 24, 2, 0.3
#: How often candidates above the threshold must pass the checks, and the least that this rate may be in
#: the whole population with the given normal quantile (one-sided 95 %).
PRECISION, ASSURED, QUANTILE = 0.995, 0.95, 1.645
#: Matches whose lengths are summed in one go.
BLOCK = 64
#: Features and their numbers of values.
FEATURES = {"digits": 8, "separators": 5, "before": 4, "after": 4, "cue": 2, "first": 4, "groups": 3}


def sums_before(lengths: Column) -> Column:
    """For each element the sum of those before it; blocks keep the work far from the square of the length."""
    zero = F.lit(0).cast("long")

    def total(values: Column) -> Column:
        return F.aggregate(values, zero, lambda a, x: a + x)

    def within(starts: Column) -> Column:
        return F.transform(lengths, lambda x, i: F.get(starts, F.floor(i / BLOCK).cast("int")) + total(
            F.slice(lengths, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)
        ))

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
        lambda b: total(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))),
    )
    starts = let(blocks, lambda sums: F.transform(sums, lambda x, b: total(F.slice(sums, F.lit(1), b))))
    return F.when(F.size(lengths) == 0, F.array().cast("array<bigint>")).otherwise(let(starts, within))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches in order: start, end, value, and the text between them and the last and next match."""
    cut = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"))

    def placed(m: Column) -> Column:
        gaps, values = m["gaps"], m["values"]
        lengths = F.transform(values, lambda v, i: (F.char_length(F.get(gaps, i)) + F.char_length(v)).cast("long"))
        return let(lengths, lambda each: let(sums_before(each), lambda sums: F.transform(values, lambda v, i: F.struct(
            (F.get(sums, i) + F.char_length(F.get(gaps, i))).alias("start"),
            (F.get(sums, i) + F.get(each, i)).alias("end"),
            v.alias("value"),
            F.right(F.get(gaps, i), F.lit(AROUND)).alias("before"),
            F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"),
        ))))

    return let(cut, placed)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right."""

    def worth(k: Column) -> Column:
        one = F.substring(digits, -k, F.lit(1)).cast("int")
        return F.when(k % 2 == 1, one).otherwise(2 * one - F.when(one > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), lambda a, k: a + worth(k)) % 10 == 0


def passes(kind: int, value: Column) -> Column:
    """Whether a match of a strict pattern passes its kind's check."""
    if kind == EMAIL:
        return F.lit(True)
    if kind == IP:
        parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.char_length(p) < 3) | ((F.char_length(p) == 3) & (p <= "255")))
    return let(digits_of(value), lambda d: (
        F.char_length(d).between(9, 15) if kind == PHONE
        else F.when(F.char_length(d).between(12, 19), luhn(d)).otherwise(False)
    ))


def passes_loosely(kind: int, match: Column) -> Column:
    """Whether a loose candidate passes its kind's check in its normal form."""
    value = match["value"]
    if kind == EMAIL:
        plain = F.regexp_replace(F.regexp_replace(value, r"\x20?[(\[]at[)\]]\x20?", "@"), r"\x20?[(\[]dot[)\]]\x20?", ".")
        return plain.rlike(rf"^[{LOCAL}]++@(?:[{LABEL}]++\.)++[A-Za-z]{{2,}}$")
    address = value.rlike(rf"^{STRICT[IP]}$") & passes(IP, value)
    if kind == CARD:
        return ~address & passes(CARD, value)
    return match["before"].rlike(CUES[PHONE]) & ~address & ~holds_card(value) & passes(PHONE, value)


def holds_card(value: Column) -> Column:
    """Whether a run of digits holds a base span. What the strict pattern matches lies within one run."""
    return F.exists(F.regexp_extract_all(value, F.lit(STRICT[CARD]), F.lit(0)), lambda v: passes(CARD, v))


def found_strictly(kind: int, match: Column) -> Column:
    """Whether a run of digits is a strict candidate of its kind, or meets a base span of it."""
    value = match["value"]
    if kind == CARD:
        return value.rlike(rf"^{STRICT[CARD]}$") | holds_card(value)
    number = F.regexp_extract(F.concat(F.lit("+"), value), f"^{STRICT[PHONE]}", 0)
    return match["before"].endswith("+") & passes(PHONE, number)


def kind_of_character(c: Column) -> Column:
    """0 nothing or white space, 1 letter, 2 digit, 3 anything else."""
    return F.when((c == "") | c.rlike(r"\s"), 0).when(c.rlike(r"\p{L}"), 1).when(c.rlike("[0-9]"), 2).otherwise(3)


def described(kind: int, match: Column) -> Column:
    """A candidate with the features of its format and surroundings, none of which is the kind's check."""
    value, first = match["value"], F.left(match["value"], F.lit(1))
    signs = F.array_distinct(F.split(F.regexp_replace(value, r"[\p{L}0-9+]", ""), ""))
    size = F.char_length(digits_of(value))
    sizes = F.lit(0)
    for k, least in enumerate((1, 7, 9, 12, 13, 16, 17), 1):
        sizes = F.when(size >= least, k).otherwise(sizes)
    kinds = F.filter(signs, lambda s: s != "")
    return F.struct(
        match["start"].alias("start"), match["end"].alias("end"), F.lit(kind).alias("kind"), match["passed"].alias("passed"),
        match["good"].alias("good"),
        sizes.alias("digits"),
        F.when(F.size(kinds) == 0, 0).when(F.size(kinds) > 1, 4).when(kinds[0] == " ", 1).when(kinds[0] == "-", 2)
        .otherwise(3).alias("separators"),
        kind_of_character(F.right(match["before"], F.lit(1))).alias("before"),
        kind_of_character(F.coalesce(match["after"], F.lit(""))).alias("after"),
        match["before"].rlike(CUES[kind]).cast("int").alias("cue"),
        F.when(first == "+", 0).when(first == "0", 1).when(first.rlike("[3-6]"), 2).otherwise(3).alias("first"),
        F.when(value.rlike(r"^[0-9]{4}(?:[^0-9][0-9]{4}){2,4}$"), 1).when(value.rlike(r"^\+?[0-9]+$"), 0).otherwise(2).alias("groups"),
    )


def candidates(text: Column) -> Column:
    """All candidates of a text. Those that ``passed`` are the base spans, ``good`` ones pass their check."""
    given = F.coalesce(text, F.lit(""))

    def strict(kind: int) -> Column:
        checked = F.transform(matches(given, STRICT[kind]), lambda m: let(
            passes(kind, m["value"]), lambda p: m.withField("passed", p).withField("good", p)
        ))
        return F.transform(checked, lambda m: described(kind, m))

    def loose(found: Column, kind: int) -> Column:
        checked = F.transform(found, lambda m: m.withField("passed", F.lit(False)).withField("good", passes_loosely(kind, m)))
        return F.transform(checked, lambda m: described(kind, m))

    def runs(m: Column, kind: int, least: int, most: int) -> Column:
        return loose(F.filter(m, lambda x: (
            F.char_length(digits_of(x["value"])).between(least, most) & ~found_strictly(kind, x)
        )), kind)

    return F.concat(
        *[strict(kind) for kind in range(len(KINDS))],
        loose(matches(given, WRITTEN_OUT), EMAIL),
        let(matches(given, DIGIT_RUN), lambda m: F.concat(runs(m, CARD, 12, 19), runs(m, PHONE, 9, 15))),
    )


@dataclass
class Model:
    """Boosted trees and threshold of each kind: a tree is nested tuples ``(feature, value, if equal, if not)``."""

    start: list[float] = field(default_factory=lambda: [0.0] * len(KINDS))
    trees: list[list] = field(default_factory=lambda: [[] for _ in KINDS])
    threshold: list[float] = field(default_factory=lambda: [float("inf")] * len(KINDS))

    def score(self, kind: int, candidate: Column) -> Column:
        total = F.lit(self.start[kind])
        for tree in self.trees[kind]:
            total = total + _tree_column(tree, candidate)
        return total


def _tree_column(tree, candidate: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    name, value, yes, no = tree
    return F.when(candidate[name] == value, _tree_column(yes, candidate)).otherwise(_tree_column(no, candidate))


def _tree_values(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    name, value, yes, no = tree
    return np.where(x[:, list(FEATURES).index(name)] == value, _tree_values(yes, x), _tree_values(no, x))


def _grow(x: np.ndarray, slope: np.ndarray, weight: np.ndarray, depth: int):
    """A tree for the gradient: each split is the one value of a feature that gains most."""
    leaf = float(RATE * slope.sum() / (weight.sum() + 1.0))
    best, parent = (1e-6, None, None), slope.sum() ** 2 / (weight.sum() + 1.0)
    if depth and len(x) > 1:
        for k, (name, values) in enumerate(FEATURES.items()):
            for value in range(values):
                here = x[:, k] == value
                if here.any() and not here.all():
                    gain = sum(slope[m].sum() ** 2 / (weight[m].sum() + 1.0) for m in (here, ~here)) - parent
                    if gain > best[0]:
                        best = (gain, (name, value), here)
    if best[1] is None:
        return leaf
    here = best[2]
    return (*best[1], _grow(x[here], slope[here], weight[here], depth - 1), _grow(x[~here], slope[~here], weight[~here], depth - 1))


def assured(good: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Lower confidence bound of the rate behind ``good`` of ``n`` (Wilson's interval)."""
    rate, z2 = good / n, QUANTILE**2
    spread = QUANTILE * np.sqrt(rate * (1 - rate) / n + z2 / (4 * n * n))
    return (rate + z2 / (2 * n) - spread) / (1 + z2 / n)


def propose(documents: DataFrame, text: str = "text", into: str = "proposed") -> DataFrame:
    """All columns of ``documents`` and ``into``, a ``struct<fold, candidates>`` that ``learn`` and ``find`` can take."""
    return documents.withColumn(into, proposed(F.col(text)))


def proposed(text: Column) -> Column:
    fold = F.pmod(F.xxhash64(text), F.lit(2)).alias("fold")
    return F.struct(fold, candidates(text).alias("candidates"))


def learn(documents: DataFrame, text: str = "text", given: str | None = None) -> Model:
    """Trees and thresholds from the candidates of all documents, which a column ``given`` may hold already.

    What comes to the driver is a row for each description, whose number the features' values bound.
    """
    found = documents.select((F.col(given) if given else proposed(F.col(text))).alias("found"))
    described_ = found.select("found.fold", F.explode("found.candidates").alias("c"))
    counts = described_.groupBy("fold", "c.kind", *[f"c.{name}" for name in FEATURES]).agg(
        F.count("*").alias("n"), F.count_if("c.good").alias("good")
    )
    rows, model = sorted(tuple(r) for r in counts.collect()), Model()
    for kind in range(len(KINDS)):
        own = np.array([r for r in rows if r[1] == kind], np.int64).reshape(-1, 4 + len(FEATURES))
        fit, hold = own[own[:, 0] == 0], own[own[:, 0] == 1]
        if not len(fit) or not len(hold):
            continue
        x, n, good = fit[:, 2:-2], fit[:, -2].astype(float), fit[:, -1].astype(float)
        model.start[kind] = float(np.log((good.sum() + 1) / (n.sum() - good.sum() + 1)))
        score = np.full(len(x), model.start[kind])
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree = _grow(x, good - n * p, n * p * (1 - p), DEPTH)
            model.trees[kind].append(tree)
            score += _tree_values(tree, x)
        held = model.start[kind] + sum(_tree_values(tree, hold[:, 2:-2]) for tree in model.trees[kind])
        order = np.argsort(-held, kind="stable")
        held, n, good = held[order], hold[order, -2].cumsum(), hold[order, -1].cumsum()
        last = np.append(held[1:] != held[:-1], True)  # equal scores stand or fall together
        fine = last & (good >= PRECISION * n) & (assured(good, n) >= ASSURED)
        if fine.any():
            model.threshold[kind] = float(held[np.flatnonzero(fine)[-1]])
    return model


def detected(found: Column, model: Model) -> Column:
    """Of candidates ``struct<base, spans>``: sorted arrays of ``struct<start, kind, end>``, the base ones and all."""

    def span(c: Column) -> Column:
        return F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))

    def chosen(c: Column) -> Column:
        likely = F.lit(False)
        for kind in range(len(KINDS)):
            if np.isfinite(model.threshold[kind]):
                likely = F.when(c["kind"] == kind, model.score(kind, c) >= model.threshold[kind] - 1e-9).otherwise(likely)
        return ~c["passed"] & likely

    def both(found: Column) -> Column:
        base = F.transform(F.filter(found, lambda c: c["passed"]), span)
        more = F.transform(F.filter(found, chosen), span)

        def added(known: Column) -> Column:
            return F.array_distinct(F.filter(more, lambda m: ~F.exists(
                known, lambda b: (b["kind"] == m["kind"]) & (b["start"] < m["end"]) & (m["start"] < b["end"])
            )))

        return let(F.array_sort(base), lambda known: F.struct(
            known.alias("base"), F.array_sort(F.concat(known, added(known))).alias("spans")
        ))

    return let(found, both)


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping ones by that of the first."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def piece(start: Column, end: Column) -> Column:
        return F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))

    def step(a: Column, s: Column) -> Column:
        free = s["start"] >= a["at"]
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(free, F.concat(a["out"], piece(a["at"], s["start"]), F.get(names, s["kind"]))).otherwise(a["out"]).alias("out"),
        )

    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(spans, begin, step, lambda a: F.concat(a["out"], piece(a["at"], F.char_length(text).cast("long"))))
    )


def find(
    documents: DataFrame, model: Model, text: str = "text", into: str = "personal", given: str | None = None,
) -> DataFrame:
    """All columns of ``documents`` and ``into``, a ``struct<base, spans>``. ``given`` names a column by ``propose``."""
    found = F.col(given)["candidates"] if given else candidates(F.col(text))
    return documents.withColumn(into, detected(found, model))


def count_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

