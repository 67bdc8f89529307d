"""Sources mixed to target weights: Pfair release times and deadlines, earliest deadline first.

Each source is a sequence of texts in an order fixed by hash, repeated as often as it may be, and cut into blocks of
about ``block_tokens``. Block k of a source of weight w may not go before slot floor(k / w) and must be gone by slot
ceil((k + 1) / w); of the blocks released, the one with the earliest deadline goes next. After any
number of slots each source is then less than one block away from its share. Weights are exact fractions of the given shares, so this
holds for runs of any length.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.skew import running_sum
from palimpsest.session import maybe_broadcast, scratch, stage

#: Default of ``parts_of``; the mix itself uses exact weights.
PARTS = 1000
#: Slots are handed to Spark in ranges of so many rows.
RANGE = 100_000
BLOCK_TOKENS = 4096


def parts_of(weights: dict[str, float], parts: int = PARTS) -> dict[str, int]:
    """Whole parts by largest remainder, at least one for every positive weight."""
    parts = max(parts, len(weights))
    total = sum(weights.values())
    exact = {s: w / total * parts for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (-(exact[s] - int(exact[s])), s)):
        if sum(out.values()) >= parts:
            break
        out[s] += 1
    while sum(out.values()) > parts:
        out[max(out, key=lambda s: (out[s] - exact[s], out[s], s))] -= 1
    return out


def exact_parts(shares: dict[str, str]) -> dict[str, int]:
    """The shares, as written in decimals, as whole parts of their least common period without any rounding."""
    exact = {s: Fraction(w) for s, w in shares.items()}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * scale) for s, w in exact.items()}
    common = math.gcd(*whole.values())
    return {s: n // common for s, n in whole.items()}


def schedule(parts: dict[str, int], slots: int | None = None) -> Iterator[str]:
    """The source of each slot of one period, or of so many slots, by earliest pseudo-deadline among released blocks."""
    total, done = sum(parts.values()), dict.fromkeys(parts, 0)
    later, ready = sorted((0, s) for s in parts), []
    for slot in range(total if slots is None else slots):
        while later and later[0][0] <= slot:
            s = heapq.heappop(later)[1]
            heapq.heappush(ready, (-(-(done[s] + 1) * total // parts[s]), s))
        best = heapq.heappop(ready)[1]
        done[best] += 1
        heapq.heappush(later, (done[best] * total // parts[best], best))
        yield best


def places(parts: dict[str, int], blocks: dict[str, int], slots: int) -> Iterator[tuple[str, int, int]]:
    """(source, block, slot) of one period, if it is not longer than the run of ``slots``, else of the run.

    After the run a source has at most its last, cut block left, and one that ``blocks`` counts in excess: these follow by deadline.
    """
    total, seen = sum(parts.values()), dict.fromkeys(parts, 0)
    for at, s in enumerate(schedule(parts, min(total, slots))):
        yield s, seen[s], at
        seen[s] += 1
    if slots < total:
        left = sorted((-(-(k + 1) * total // parts[s]), s, k) for s, n in blocks.items() for k in range(seen[s], n))
        for at, (_, s, k) in enumerate(left, slots):
            yield s, k, at


def lookup_of(spark, rows: Iterator[tuple[str, int, int]]) -> DataFrame:
    """``rows`` as a table (source, _k, _at), written in ranges if it has more than one."""
    fields = "source string, _k long, _at long"
    first = list(islice(rows, RANGE))
    if len(first) < RANGE:
        return F.broadcast(spark.createDataFrame(first, fields))
    path = scratch(spark, "slots")
    while first:
        spark.createDataFrame(first, fields).coalesce(1).write.mode("append").parquet(path)
        first = list(islice(rows, RANGE))
    return maybe_broadcast(spark.read.schema(fields).parquet(path), path)


def plan(sizes: dict[str, int], targets: list[tuple[str, float, int]], budget: int | None = None) -> dict[str, dict]:
    """Per usable source its share, repeats and tokens to draw.

    Targets whose source has no tokens are unusable, and the shares of the others are scaled to sum to 1. The total is the largest at which no
    source needs more repeats than allowed, or ``budget`` if that is less. NULL repeats count as 1.
    """
    usable = {s: (w, 1 if r is None else int(r)) for s, w, r in targets if s and w and w > 0 and sizes.get(s, 0) > 0 and (r is None or r > 0)}
    whole = sum(w for w, _ in usable.values())
    if not usable:
        return {}
    most = min(sizes[s] * r / (w / whole) for s, (w, r) in usable.items())
    total = most if budget is None else min(most, budget)
    return {s: {"weight": str(w), "share": w / whole, "repeats": r, "need": w / whole * total} for s, (w, r) in usable.items()}


def canonical(source):
    return F.lower(F.trim(source))


def draws(counts: DataFrame, targets: DataFrame, budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(mix, report) of texts (doc_id, source, n_tokens).

    mix: (slot, source, block, doc_id, repeat, n_tokens), to be read in order of slot, then position; report: per source
    with a target or texts its target and actual share. Source names are compared in lower case without blanks around; texts without
    source, target or tokens are not drawn. A text is drawn while its source is below its need, so a source
    ends at most one text above it. A source may hold any part of all rows: positions come from
    range-partitioned running sums.
    """
    spark = counts.sparkSession
    rows, _ = stage(counts.select("doc_id", canonical(F.col("source")).alias("source"), "n_tokens"), "counts")
    goals = [(r[0], r[1], r[2]) for r in targets.select(canonical(F.col("source")), "target_share", "max_repeats").dropna(subset=["target_share"]).collect()]  # configuration, a row a source
    names = [g[0] for g in goals]
    per = rows.filter(F.col("source").isin(names)).groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()
    sizes = {r[0]: int(r[1]) for r in per}
    todo = plan(sizes, goals, budget)
    fields = "source string, share double, repeats long, need double, size long, part long"
    parts = exact_parts({s: p["weight"] for s, p in todo.items()}) if todo else {}
    table = spark.createDataFrame([(s, p["share"], p["repeats"], p["need"], sizes[s], min(parts[s], (1 << 63) - 1)) for s, p in todo.items()], fields)
    ordered = rows.filter("n_tokens > 0").join(F.broadcast(table), "source").withColumn("_o", F.xxhash64("doc_id", F.lit(seed)))
    placed = running_sum(ordered, ["source"], ["_o", "doc_id"], "n_tokens", "_end")
    epochs = F.sequence(F.lit(0).cast("long"), F.least(F.col("repeats"), F.ceil(F.col("need") / F.col("size"))) - 1)
    drawn = placed.select("*", F.explode(epochs).alias("repeat")).withColumn("position", F.col("repeat") * F.col("size") + F.col("_end") - F.col("n_tokens")).filter("position < need")
    blocks = drawn.withColumn("block", F.floor(F.col("position") / block_tokens).cast("long"))
    period = sum(parts.values())
    run = math.ceil(max((p["need"] / p["share"] for p in todo.values()), default=0) / block_tokens)
    known = {s: int(p["need"] // block_tokens) + 1 for s, p in todo.items()}
    lookup = lookup_of(spark, places(parts, known, run))
    cycle, again = (F.col("block") % F.col("part"), F.floor(F.col("block") / F.col("part"))) if period <= run else (F.col("block"), F.lit(0))
    mix = blocks.withColumn("_k", cycle).withColumn("_n", again.cast("long")).join(lookup, ["source", "_k"])
    mix = mix.select((F.col("_n") * (period if period <= run else 0) + F.col("_at")).cast("long").alias("slot"), "source", "block", "position", "doc_id", "repeat", "n_tokens")
    mix, _ = stage(mix, "mix")
    have = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens_available"), F.count("*").alias("texts"))
    used = mix.groupBy("source").agg(F.sum("n_tokens").alias("tokens_drawn"), F.count("*").alias("draws"), (F.max("repeat") + 1).alias("most_repeats"))
    total = used.agg(F.sum("tokens_drawn")).scalar()
    goal = spark.createDataFrame(goals, "source string, target_share double, max_repeats long")
    report = have.join(goal, "source", "full_outer").join(used, "source", "left").select(
        "source", "texts", F.coalesce("tokens_available", F.lit(0)).alias("tokens_available"), "target_share", "max_repeats", F.coalesce("tokens_drawn", F.lit(0)).alias("tokens_drawn"),
        F.coalesce("draws", F.lit(0)).alias("draws"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), F.coalesce(F.col("tokens_drawn") / total, F.lit(0.0)).alias("actual_share"),
    )
    return mix, report
