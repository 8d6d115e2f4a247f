"""Mixing sources to target shares of all tokens, by Poisson replication.

Every document draws its number of copies from a Poisson distribution whose mean
is the repetition its source needs, cut off at the source's cap. The draw inverts
the distribution at a hash of the document's key, one hash for good, so it is repeatable and needs
no state. With the hashes given, the tokens of a source grow with its mean: the mean at which they
meet the target is found by two rounds of bracketing, each a pass over the document sizes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatescope import workspace
from estatescope.llm.encode import token_counts

#: Means tried per source in one round, the first spread by this factor around the expected one, and rounds.
GRID, SPREAD, ROUNDS = 64, 2.0, 2
#: Largest number of target rows; the table is read by the driver.
MAX_SOURCES = 10_000


@dataclass(frozen=True)
class Target:
    """A row of the target table: source, its share of all tokens, most uses of one text."""

    source: str
    share: float
    cap: int


def read_targets(targets: DataFrame) -> list[Target]:
    """Usable targets: a source, a positive share and a cap of at least 1; the first row of a source counts."""
    rows = (
        targets.select("source", F.col("target_share").cast("double").alias("s"), F.col("max_repeats").cast("int").alias("c"))
        .where("source is not null and s > 0 and c >= 1").groupBy("source").agg(F.max("s").alias("s"), F.max("c").alias("c"))
        .orderBy("source").limit(MAX_SOURCES + 1).collect()
    )
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    return [Target(r["source"], r["s"], r["c"]) for r in rows]


def thresholds(mean: float, cap: int) -> list[float]:
    """Cumulated Poisson probabilities P(N <= k) for k = 0 .. cap-1; a draw u counts those below or at u."""
    if math.isinf(mean):
        return [0.0] * cap
    p, total, out = math.exp(-mean), 0.0, []
    for k in range(cap):
        total += p
        out.append(min(total, 1.0))
        p *= mean / (k + 1)
    return out


def capped_mean(mean: float, cap: int) -> float:
    """Expected copies of a document: the mean of min(Poisson(mean), cap)."""
    return sum(1 - t for t in thresholds(mean, cap))


def mean_for(rate: float, cap: int) -> float:
    """The Poisson mean whose capped draws average ``rate`` copies; infinite where every copy is needed."""
    if rate >= cap * (1 - 1e-9):
        return math.inf
    low, high = 0.0, 1.0
    while capped_mean(high, cap) < rate:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if capped_mean(mid, cap) < rate else (low, mid)
    return high


def draw(key: Column, seed: Column) -> Column:
    """Uniform number in [0, 1) from a hash of key and seed."""
    return F.shiftrightunsigned(F.xxhash64(key, seed), 11).cast("double") * F.lit(2.0**-53)


def _sums(cuts: dict[str, list[list[float]]]):
    """Arrow map: tokens each (source, mean) would give."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            source = batch.column("source").dictionary_encode()
            index, names = source.indices.to_numpy(zero_copy_only=False), source.dictionary.to_pylist()
            tokens, u = np.asarray(batch.column("n_tokens")).astype(np.float64), np.asarray(batch.column("u"))
            for i, name in enumerate(names):
                own = index == i
                sums = np.array([tokens[own] @ (u[own][:, None] >= np.asarray(c)).sum(-1) for c in cuts[name]])
                total[name] = total.get(name, 0) + sums
        for name, sums in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(sums)), pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums)], ["source", "at", "tokens"]
            )

    return run


def _calibrated(sized: DataFrame, usable: list[Target], goal: dict[str, float], have: dict[str, int]) -> dict[str, float]:
    """Mean of every source at which the copies drawn come nearest its goal."""
    expected = {t.source: mean_for(goal[t.source] / have[t.source], t.cap) for t in usable}
    means = {s: [math.inf] if math.isinf(m) else [m * SPREAD ** (2 * i / (GRID - 1) - 1) for i in range(GRID)] for s, m in expected.items()}
    cap = {t.source: t.cap for t in usable}
    goals = sized.sparkSession.createDataFrame(list(goal.items()), "source string, goal double")
    best: dict[str, float] = {}
    for _ in range(ROUNDS):
        parts = sized.select("source", "n_tokens", "u").mapInArrow(
            _sums({s: [thresholds(m, cap[s]) for m in ms] for s, ms in means.items()}), "source string, at int, tokens double"
        )
        sums = parts.groupBy("source", "at").agg(F.sum("tokens").alias("tokens")).join(F.broadcast(goals), "source")  # at most MAX_SOURCES rows
        off = F.abs(F.col("tokens") - F.col("goal"))
        # one row per source
        for r in sums.groupBy("source").agg(F.min(F.struct(off.alias("off"), "at"))["at"].alias("best"), F.max(F.when(F.col("tokens") <= F.col("goal"), F.col("at"))).alias("below")).collect():
            tried = means[r["source"]]
            best[r["source"]] = tried[r["best"]]
            low = r["below"] if r["below"] is not None else 0
            a, b = tried[low], tried[min(low + 1, len(tried) - 1)]
            means[r["source"]] = [best[r["source"]], *(a + (b - a) * i / (GRID - 2) for i in range(GRID - 1))] if math.isfinite(b) else [b]
    return best


@dataclass
class Mixture:
    """copies: (doc_id, copy, source, n_tokens) in a global random order; shares: the report."""

    copies: DataFrame
    shares: DataFrame


def mix(docs: DataFrame, targets: DataFrame, total_tokens: int | str | None = None, seed: int = 0, **tokenizer) -> Mixture:
    """Copies of documents such that each source gives its share of all tokens.

    docs: doc_id, source, text; documents of sources without a target take no part,
        a doc_id given twice counts once, with one of its rows, null and empty texts have 0 tokens and
        are never drawn. total_tokens: the budget of the mixture; ``"available"`` takes all tokens of the
        listed sources. By default it is the largest at which every source that has tokens reaches its share
        within its cap, so the shares come first. A source that cannot reach its share of the budget
        gives all it may and falls short, which the report shows (goal_tokens, tokens, share); one without
        tokens gives nothing.
    """
    spark = docs.sparkSession
    wanted = read_targets(targets)
    known = docs.select("doc_id", "source", "text").where(F.col("source").isin([t.source for t in wanted]) if wanted else F.lit(False))
    known = known.where("doc_id is not null").withColumn("__row", F.xxhash64("doc_id", "source", "text"))
    counts = token_counts(known.select("__row", "text"), key="__row", **tokenizer)
    one = known.groupBy("doc_id").agg(F.min(F.struct("__row", "source")).alias("r")).select("doc_id", "r.source", "r.__row")
    # rows given twice have the same number
    counts = counts.groupBy("__row").agg(F.first("n_tokens").alias("n_tokens")).where("n_tokens > 0")
    sized = one.join(counts, "__row").select("doc_id", "source", "n_tokens", draw(F.col("doc_id"), F.lit(seed)).alias("u"))
    sized = workspace.materialize(sized, "sized")
    # one row per target source
    have = {r["source"]: r["t"] for r in sized.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    usable = [t for t in wanted if have.get(t.source)]
    norm = sum(t.share for t in usable) or 1.0
    if total_tokens is None:
        total_tokens = int(min((t.cap * have[t.source] * norm / t.share for t in usable), default=0))
    elif total_tokens == "available":
        total_tokens = sum(have.values())
    goal = {t.source: total_tokens * t.share / norm for t in usable}
    within = {t.source: min(goal[t.source], float(t.cap * have[t.source])) for t in usable}
    means = _calibrated(sized, usable, within, have) if usable else {}
    plan = spark.createDataFrame(
        [(t.source, [float(x) for x in thresholds(means[t.source], t.cap)]) for t in usable], "source string, cuts array<double>"
    )
    drawn = sized.join(F.broadcast(plan), "source")  # at most MAX_SOURCES rows
    drawn = drawn.withColumn("n", F.size(F.filter("cuts", lambda c: F.col("u") >= c))).where("n > 0")
    copies = drawn.select("doc_id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"), "source", "n_tokens")
    order = F.xxhash64("doc_id", "copy", F.lit(seed))
    report = drawn.groupBy("source").agg(
        F.sum(F.col("n") * F.col("n_tokens")).alias("tokens"), F.max("n").alias("most_uses"), F.count("*").alias("documents")
    )
    goals = spark.createDataFrame(
        [(t.source, t.share, t.cap, int(have.get(t.source) or 0), int(goal.get(t.source, 0))) for t in wanted],
        "source string, target_share double, max_repeats int, available_tokens long, goal_tokens long",
    )
    zero = F.lit(0)
    shares = goals.join(report, "source", "left").select(
        "source", "target_share", "max_repeats", "available_tokens", "goal_tokens",
        F.coalesce("documents", zero).cast("long").alias("documents"), F.coalesce("most_uses", zero).cast("int").alias("most_uses"),
        F.coalesce("tokens", zero).cast("long").alias("tokens"),
    )
    total = shares.agg(F.sum("tokens").alias("__all"))
    shares = shares.join(F.broadcast(total), F.lit(True)).withColumn(
        "share", F.when(F.col("__all") > 0, F.col("tokens") / F.col("__all")).otherwise(0.0)
    ).drop("__all")
    return Mixture(copies.withColumn("__order", order).orderBy("__order", "doc_id", "copy").drop("__order"), shares)
