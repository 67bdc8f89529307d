"""Items into fixed-capacity containers with little unused space: minimum bin slack.

Each container takes the largest remaining item and then the multiset of remaining lengths that comes closest to its
capacity: sums that lengths can reach are the bits of an integer, a length added is a shift, and the way back through the kept
integers tells how many items of each length were used. Items are packed in windows of bounded
size in parallel; what a window could only fill badly goes into later, fewer windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.session import stage

#: Containers a window should come to, and items at most.
WINDOW_CONTAINERS, WINDOW_ITEMS = 400, 20_000
#: Containers of an early window filled less than this are opened again.
GOOD = 0.995


def fill(room: int, counts: dict[int, int], order: list[int]) -> dict[int, int]:
    """How many items of each length come closest to ``room``; ``order``: the lengths, longest first."""
    reach, steps = 1, []
    whole, goal = (1 << (room + 1)) - 1, 1 << room
    for length in order:
        if length > room or not counts[length]:
            continue
        left, copies = min(counts[length], room // length), 1
        while left and not reach & goal:  # bounded multiples by doubling
            take = min(copies, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & whole
            left, copies = left - take, copies * 2
        if reach & goal:
            break
    at, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not (before >> at) & 1:
            used[length] = used.get(length, 0) + take
            at -= length * take
    return used


def pack_window(lengths: list[int], capacity: int) -> list[list[int]]:
    """Containers as lists of item positions; every length is at least 1 and at most ``capacity``."""
    stacks: dict[int, list[int]] = {}
    for i, n in enumerate(lengths):
        stacks.setdefault(n, []).append(i)
    counts = {n: len(s) for n, s in stacks.items()}
    order, out = sorted(stacks, reverse=True), []
    while order:
        first = order[0]
        box = [stacks[first].pop()]
        counts[first] -= 1
        for n, k in fill(capacity - first, counts, order).items():
            counts[n] -= k
            box += [stacks[n].pop() for _ in range(k)]
        out.append(box)
        if any(not counts[n] for n in {lengths[i] for i in box}):
            order = [n for n in order if counts[n]]
    return out


def pieces(items: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per kind and piece: (container_kind, capacity_tokens, doc_id, piece, token_begin, n_tokens).

    Only items larger than the capacity are cut, into full pieces and a rest. Items without tokens have no piece; kinds
    without a positive capacity are left out, and of two capacities of one kind the larger counts.
    """
    usable = sizes.select("container_kind", F.col("capacity_tokens").cast("long").alias("capacity_tokens")).filter("capacity_tokens > 0 AND container_kind IS NOT NULL")
    kinds = usable.groupBy("container_kind").agg(F.max("capacity_tokens")).orderBy("container_kind").collect()  # configuration, a row a kind
    if not kinds:
        kinds = [("", -1)]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(int(c)).cast("long").alias("cap")) for k, c in kinds]))
    both = items.select("doc_id", F.col("n_tokens").alias("_n")).filter("_n > 0").select("doc_id", "_n", each.alias("_k")).select("doc_id", "_n", F.col("_k.kind").alias("container_kind"), F.col("_k.cap").alias("capacity_tokens")).filter("capacity_tokens > 0")
    cap = F.col("capacity_tokens")
    cut = both.select("container_kind", "capacity_tokens", "doc_id", "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("_n") / cap) - 1)).alias("piece"))
    return cut.select("container_kind", "capacity_tokens", "doc_id", "piece", (F.col("piece") * cap).alias("token_begin"), F.least(cap, F.col("_n") - F.col("piece") * cap).alias("n_tokens"))


_PACKED = "container_kind string, capacity_tokens long, container string, item long, doc_id long, piece long, token_begin long, n_tokens long, again boolean"


def _round(rows: DataFrame, number: int, last: bool) -> DataFrame:
    def run(key, pdf):
        import pandas as pd

        kind, window = key
        capacity = int(pdf["capacity_tokens"].iloc[0])
        pdf = pdf.sort_values(["n_tokens", "item"], ignore_index=True)
        lengths = [int(x) for x in pdf["n_tokens"]]
        name, again = [""] * len(lengths), [False] * len(lengths)
        for b, box in enumerate(pack_window(lengths, capacity)):
            bad = not last and sum(lengths[i] for i in box) < GOOD * capacity
            for i in box:
                name[i], again[i] = f"{kind}-{number}-{window}-{b}", bad
        return pdf.drop(columns="window").assign(container=pd.Series(name, dtype=object), again=again)[[c.split()[0] for c in _PACKED.split(", ")]]

    return rows.groupBy("container_kind", "window").applyInPandas(run, _PACKED)


def _windowed(rows: DataFrame, number: int) -> DataFrame:
    """Assign windows by hash of the item, so many per kind that each is bounded in containers and items."""
    per = rows.groupBy("container_kind").agg(
        F.greatest(F.ceil(F.sum("n_tokens") / (F.max("capacity_tokens") * WINDOW_CONTAINERS)), F.ceil(F.count("*") / WINDOW_ITEMS), F.lit(1)).alias("_windows")
    )
    return rows.join(F.broadcast(per), "container_kind").withColumn("window", F.pmod(F.xxhash64("item", F.lit(number)), F.col("_windows")).cast("long")).drop("_windows")


def pack(items: DataFrame, sizes: DataFrame, rounds: int = 3) -> DataFrame:
    """(container_kind, container, doc_id, piece, token_begin, n_tokens): every token of every item once per kind of container.

    ``items`` has doc_id and n_tokens; repeated rows are packed as often as they stand there. No container exceeds its capacity.
    """
    rows, _ = stage(pieces(items, sizes), "pieces")
    full = rows.filter("n_tokens = capacity_tokens").select("container_kind", F.concat_ws("-", "container_kind", F.lit("full"), F.monotonically_increasing_id().cast("string")).alias("container"), "doc_id", "piece", "token_begin", "n_tokens")
    todo, out = rows.filter("n_tokens < capacity_tokens").withColumn("item", F.monotonically_increasing_id()), full
    for r in range(rounds):
        done, _ = stage(_round(_windowed(todo, r), r, r == rounds - 1), "packed")
        out = out.unionByName(done.filter("NOT again").select(*out.columns))
        todo = done.filter("again").select("container_kind", "capacity_tokens", "item", "doc_id", "piece", "token_begin", "n_tokens")
    return out


def fill_report(packed: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per kind: containers, pieces, tokens, and the share of the space that is used."""
    per = packed.groupBy("container_kind").agg(F.countDistinct("container").alias("containers"), F.count("*").alias("pieces"), F.sum("n_tokens").alias("tokens"))
    return per.join(F.broadcast(sizes.select("container_kind", "capacity_tokens").distinct()), "container_kind").withColumn("filled", F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))
