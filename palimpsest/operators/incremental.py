"""Only new or changed records: a Merkle tree over key ranges decides what a run has to read.

A record set is a set of elements (key, version). Leaves cover ``2**leaf_bits`` successive keys, a node of a higher level
``2**fan_bits`` nodes below it. A run writes the current elements in order of their keys and hashes them into a tree, walks
down from the top only where its digests differ from the saved ones, reads the
elements of changed leaves (of both runs, by key ranges that Parquet's statistics prune), compares them one by one, and publishes output, elements and tree as one version.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.session import maybe_broadcast, publish, published, remove

LEAF_BITS, FAN_BITS = 8, 8
#: Key ranges that changed leaves are summed up in at most, for the filter that reaches the scan.
SPANS = 64
_TREE = "level int, node long, a long, b long, n long"
_ELEMENTS = "key long, version long"


def elements(df: DataFrame, key: Column, version: Column) -> DataFrame:
    """Distinct (key, version) of the rows with a key. A NULL version says only that the key is there."""
    return df.select(key.cast("long").alias("key"), version.cast("long").alias("version")).filter("key IS NOT NULL").distinct()


def leaf_of(key: Column) -> Column:
    return F.shiftright(key, LEAF_BITS)


def leaf_level(elems: DataFrame) -> DataFrame:
    """(node, a, b, n) of the leaves; a and b are two independent 64-bit hashes of the leaf's set of elements."""
    h = lambda *cols: F.bit_xor(F.xxhash64(*cols))
    return elems.groupBy(leaf_of(F.col("key")).alias("node")).agg(h("key", "version").alias("a"), h("version", F.lit(1), "key").alias("b"), F.count("*").alias("n"))


def height(leaves: DataFrame) -> int:
    """Levels above the leaves until one node is left on either side of zero; at least 1."""
    lo, hi = leaves.agg(F.min("node"), F.max("node")).first()
    span, top = max(abs(lo or 0), abs(hi or 0)), 1
    while span >> (FAN_BITS * top):
        top += 1
    return top


def upper_levels(leaves: DataFrame, top: int) -> DataFrame:
    """(level, node, a, b, n) of all levels above the leaves, each made from the one below."""
    level, out = leaves, []
    for i in range(1, top + 1):
        level = level.groupBy(F.shiftright("node", FAN_BITS).alias("node")).agg(
            F.bit_xor(F.xxhash64("node", "a", "b", "n")).alias("a"), F.bit_xor(F.xxhash64("n", "b", F.lit(1), "a", "node")).alias("b"), F.sum("n").alias("n")
        )
        out.append(level.select(F.lit(i).alias("level"), "node", "a", "b", "n"))
    return reduce(DataFrame.unionByName, out)


def changed_leaves(saved: DataFrame, current: DataFrame, top: int) -> DataFrame:
    """(node): leaves that differ, found by descending from level ``top`` (one that both trees have) only below nodes that differ."""
    frontier = None
    for i in range(top, -1, -1):
        s, c = (t.filter(F.col("level") == i).select("node", "a", "b", "n") for t in (saved, current))
        if frontier is not None:
            under = frontier.withColumnRenamed("node", "_up")
            s, c = (t.join(under, F.shiftright(t["node"], FAN_BITS) == F.col("_up"), "left_semi") for t in (s, c))
        s = s.select(F.col("node"), F.struct("a", "b", "n").alias("s"))
        c = c.select(F.col("node"), F.struct("a", "b", "n").alias("c"))
        frontier = s.join(c, "node", "full_outer").filter(~F.col("s").eqNullSafe(F.col("c"))).select("node")
    return frontier


def spans(leaves: DataFrame, most: int = SPANS) -> list[tuple[int, int]]:
    """Key ranges (first, last) that cover the leaves (node): those of one part of ``most`` equal parts of their span make one range, those of parts that adjoin too."""
    lo, hi = leaves.agg(F.min("node"), F.max("node")).first()
    if lo is None:
        return []
    part = F.floor((F.col("node") - lo) / ((hi - lo) // most + 1))
    rows = leaves.groupBy(part.alias("part")).agg(F.min("node").alias("lo"), F.max("node").alias("hi")).orderBy("lo").collect()  # at most ``most`` rows
    out: list[list[int]] = []
    for part, lo, hi in rows:
        if out and out[-1][0] == part - 1:
            out[-1][0], out[-1][2] = part, hi
        else:
            out.append([part, lo, hi])
    return [(lo << LEAF_BITS, ((hi + 1) << LEAF_BITS) - 1) for _, lo, hi in out]


def within(elems: DataFrame, ranges: list[tuple[int, int]], leaf: DataFrame) -> DataFrame:
    """Elements of the leaves; ``ranges`` are their ``spans``, by which files and pages without such keys aren't read."""
    near = reduce(Column.__or__, [F.col("key").between(a, b) for a, b in ranges], F.lit(False))
    return elems.filter(near).join(leaf, leaf_of(elems["key"]) == leaf["node"], "left_semi")


class MerkleStore:
    """State of a synchronised record set below ``root``.

    ``sync`` either publishes a run whole or leaves the last one in place; a
    crashed run is simply taken again, and so is one that another run got ahead of (``Superseded``). Repeating a published run gives no rows.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _state(self) -> tuple[int, dict]:
        number, text = published(self.spark, self.root)
        return number, json.loads(text) if text else {"run": None, "top": 1, "past": []}

    def sync(self, df: DataFrame, key: Column, version: Column, before_publish=None) -> DataFrame:
        """Changes of ``df`` against the published state: (key, change_kind), as written with the run.

        ``added``: a key without saved elements. ``changed``: a saved key with a new, non-NULL version. ``removed``: a saved key that is gone. An empty ``df`` removes all; NULL keys are no records.
        ``before_publish`` is called when all is written and nothing is published (fault injection).
        """
        (number, m), run = self._state(), f"run-{uuid.uuid4().hex}"
        at, read = f"{self.root}/{run}", self.spark.read
        # The one scan of the records. Copies meet map-side; a leaf lies in one range, so its digest is made where it is read.
        rows = elements(df, key, version)
        rows.repartitionByRange(leaf_of(F.col("key"))).sortWithinPartitions("key", "version").write.parquet(f"{at}/elements")
        current = read.schema(_ELEMENTS).parquet(f"{at}/elements")
        leaf_level(current).select(F.lit(0).alias("level"), "node", "a", "b", "n").write.parquet(f"{at}/tree")
        leaves = read.schema(_TREE).parquet(f"{at}/tree").filter("level = 0")
        top = height(leaves)
        upper_levels(leaves, top).write.mode("append").parquet(f"{at}/tree")  # a 256th of the leaves
        if m["run"]:
            before = f"{self.root}/{m['run']}"
            saved, now = (read.schema(_TREE).parquet(f"{x}/tree") for x in (before, at))
            changed_leaves(saved, now, min(top, m["top"])).write.parquet(f"{at}/leaves")
            changed = read.schema("node long").parquet(f"{at}/leaves")
            ranges, leaf = spans(changed), maybe_broadcast(changed, f"{at}/leaves")
            c, s = within(current, ranges, leaf), within(read.schema(_ELEMENTS).parquet(f"{before}/elements"), ranges, leaf)
            # 1: saved only, 2: current only, 3: both
            both = s.withColumn("o", F.lit(1)).unionByName(c.withColumn("o", F.lit(2))).groupBy("key", "version").agg(F.sum("o").alias("o"))
        else:
            both = current.withColumn("o", F.lit(2))
        kinds = both.groupBy("key").agg(
            F.max(F.col("o") != 2).alias("was"), F.max(F.col("o") != 1).alias("is"), F.max((F.col("o") == 2) & F.col("version").isNotNull()).alias("new")
        )
        kind = F.when(~F.col("was"), "added").when(~F.col("is"), "removed").when(F.col("new"), "changed")
        kinds.select("key", kind.alias("change_kind")).filter("change_kind IS NOT NULL").write.parquet(f"{at}/output")
        if before_publish:
            before_publish()
        past = [*m["past"], m["run"]] if m["run"] else []
        publish(self.spark, self.root, number, json.dumps({"run": run, "top": top, "past": past[-1:]}))
        remove(self.spark, *[f"{self.root}/{r}" for r in past[:-1]])  # the last run stays for readers that are under way
        return read.schema("key long, change_kind string").parquet(f"{at}/output")

    def compact(self) -> None:
        """Remove the superseded run that ``sync`` leaves for readers."""
        number, m = self._state()
        if m["past"]:
            publish(self.spark, self.root, number, json.dumps(m | {"past": []}))
            remove(self.spark, *[f"{self.root}/{r}" for r in m["past"]])
