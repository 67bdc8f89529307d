import random

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import hierarchy as tree
from palimpsest.operators import skew
from palimpsest.operators.dedup import DedupIndex, repeats
from palimpsest.operators.incremental import MerkleStore
from palimpsest.operators.index import first_wins, insert_ignore, last_wins, next_ids, upsert
from palimpsest.operators.orphans import dictionary, orphan_references, pack, unpack


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- incremental ---


def changes(store, spark, data, **kw):
    df = spark.createDataFrame(data, "k long, v long, key string, version string")  # clashing names
    return rows(store.sync(df, F.col("k"), F.col("v"), **kw))


def test_only_changes_are_taken(spark, tmp_path):
    s = MerkleStore(spark, str(tmp_path))
    base = [(k, k % 7, "x", None) for k in range(1, 3000)] + [(5, 5, "x", None)] * 3 + [(None, 1, "x", None), (-4, 2, None, None)]
    assert len(changes(s, spark, base)) == 3000
    assert changes(s, spark, base) == []
    new = [*base, (9000, None, "x", None), (7, 99, "y", None), (8, None, "y", None), (10**15, 3, "z", None)]
    assert changes(s, spark, new) == [(7, "changed"), (9000, "added"), (10**15, "added")]
    assert changes(s, spark, [r for r in new if r[0] != 7]) == [(7, "removed")]
    s.compact()
    assert changes(s, spark, [r for r in new if r[0] != 7]) == []


def test_a_failed_run_is_taken_again(spark, tmp_path):
    s = MerkleStore(spark, str(tmp_path))
    changes(s, spark, [(1, 1, "", "")])

    def crash():
        raise OSError("lost")

    with pytest.raises(OSError):
        changes(s, spark, [(1, 2, "", ""), (2, 1, "", "")], before_publish=crash)
    assert changes(s, spark, [(1, 2, "", ""), (2, 1, "", "")]) == [(1, "changed"), (2, "added")]


def test_only_changed_leaves_are_read_again(spark, tmp_path):
    from palimpsest.operators import incremental

    s = MerkleStore(spark, str(tmp_path))
    df = spark.range(0, 400_000, 1, 4).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    s.sync(df, F.col("k"), F.col("v"))
    new = df.withColumn("v", F.when(F.col("k").isin(77, 300_001), 2).otherwise(1))
    assert rows(s.sync(new, F.col("k"), F.col("v"))) == [(77, "changed"), (300_001, "changed")]
    at = f"{tmp_path}/{s._state()[1]['run']}"
    leaves = spark.read.parquet(f"{at}/leaves")
    ranges = incremental.spans(leaves)
    assert ranges == [(0, 255), (299_776, 300_031)]
    part = incremental.within(spark.read.parquet(f"{at}/elements"), ranges, leaves)
    assert part.count() == 512
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(key,299776)" in plan
    # A level's digests come from an exchange, not from one task that pulls all leaves.
    up = incremental.upper_levels(spark.read.parquet(f"{at}/tree").filter("level = 0").select("node", "a", "b", "n"), 2)
    assert "Coalesce" not in up._jdf.queryExecution().executedPlan().toString()


def test_spans_are_bounded(spark):
    from palimpsest.operators.incremental import spans

    nodes = spark.range(-1000, 5000).select((F.col("id") * 3).alias("node"))
    got = spans(nodes, 16)
    assert len(got) <= 16 and all(any(a <= n << 8 <= b for a, b in got) for n in (-3000, 0, 14_997)) and spans(nodes.limit(0)) == []


def test_one_of_two_runs_gets_through(spark, tmp_path):
    from palimpsest.session import Superseded

    s, other = MerkleStore(spark, str(tmp_path)), MerkleStore(spark, str(tmp_path))
    changes(s, spark, [(1, 1, "", "")])
    with pytest.raises(Superseded):
        changes(s, spark, [(2, 1, "", "")], before_publish=lambda: changes(other, spark, [(1, 1, "", ""), (3, 1, "", "")]))
    assert changes(s, spark, [(2, 1, "", "")]) == [(1, "removed"), (2, "added"), (3, "removed")]


def test_empty_table_removes_all(spark, tmp_path):
    s = MerkleStore(spark, str(tmp_path))
    assert changes(s, spark, []) == []
    changes(s, spark, [(1, 1, "", "")])
    assert changes(s, spark, []) == [(1, "removed")]


# --- hierarchy ---


def brute(edges):
    up, out = {}, {}
    for i, p in edges:
        if i:
            up[i] = max(up.get(i) or 0, p or 0) or None
    for i in up:
        seen, x = [], i
        while True:
            if x in seen:
                out[i] = (min(seen[seen.index(x) :]), -1)
                break
            seen.append(x)
            if up[x] not in up:
                out[i] = (x, len(seen) - 1)
                break
            x = up[x]
    return up, out


EDGE = "i long, p long, page long, id long, root string"


@pytest.mark.parametrize("shape", ["mixed", "chain", "star", "rings"])
def test_hierarchy_against_brute_force(spark, shape):
    r, n = random.Random(3), 1200
    parent = {"mixed": lambda i: r.choice([None, 0, r.randint(1, n + 30), max(1, i - 1)]), "chain": lambda i: i - 1, "star": lambda i: 1 if i > 1 else None, "rings": lambda i: i + 1 if i % 100 else i - 99}[shape]
    edges = [(i, parent(i)) for i in range(1, n + 1)]
    data = [(i, p, r.choice([None, 0, 1, i // 50]), 7, "x") for i, p in edges]
    data += data[:40] + [(0, 3, 1, 7, "x"), (None, None, None, None, None)]
    up, want = brute(edges)
    df = spark.createDataFrame(data, EDGE)
    got = {x["id"]: (x["root"], x["depth"]) for x in tree.hierarchy(df, "i", "p", "page", block_rows=150).collect()}
    assert got == want
    spans = {x["id"]: x for x in tree.intervals(df, "i", "p", "page", block_rows=400).collect()}
    ways = ways_of(up, want)
    below = dict.fromkeys(ways, 0)
    for way in ways.values():
        for x in way[:-1]:
            below[x] += 1
    assert below == {i: x["n_descendants"] for i, x in spans.items()}
    assert want == {i: (x["root"], x["depth"]) for i, x in spans.items()} and all((x["parent"] or None) == (ways[i][-2] if len(ways[i]) > 1 else None) for i, x in spans.items())
    place = {}
    for i, way in sorted(ways.items(), key=lambda x: x[1]):  # preorder, children by key
        k = place.setdefault(way[0], [])
        assert spans[i]["entry"] == 2 * len(k) - (len(way) - 1) and spans[i]["exit"] == spans[i]["entry"] + 2 * below[i] + 1
        k.append(i)


def ways_of(up, want):
    """Way down to every key; a cycle is cut above its least key."""
    out = {}
    for i, (root, _) in want.items():
        way, x = [i], i
        while x != root:
            x = up[x]
            way.append(x)
        out[i] = way[::-1]
    return out


@pytest.mark.parametrize("piece", [200_000, 7, 40])
def test_histories_of_all_keys(spark, piece):
    r, n = random.Random(11), 700
    edges = [(i, r.choice([None, 0, i, r.randint(1, n + 30), max(1, i - 1), max(1, i - 1), max(1, i - 1)])) for i in range(1, n + 1)] + [(i, i + 1 if i % 30 else i - 29) for i in range(901, 961)]
    up, want = brute(edges)
    ways = ways_of(up, want)
    df = spark.createDataFrame([(i, p, i // 50, 7, "x") for i, p in edges] + [(5, dict(edges)[5], 1, 7, "x"), (0, 3, 1, 7, "x"), (None, None, None, None, None)], EDGE)
    got, parts = {}, 0
    for x in tree.histories(df, "i", "p", "page", block_rows=200, piece_arcs=piece).collect():
        one = got.setdefault(x["id"], [None, [], (x["root"], x["depth"])])
        if x["path"] is not None:
            assert one[0] is None
            one[0] = x["path"]
        one[1] += x["later"]
        parts += 1
    assert {i: x[0] for i, x in got.items()} == ways and {i: x[2] for i, x in got.items()} == want
    later = {i: [] for i in ways}
    for i, way in ways.items():
        for x in way[:-1]:
            later[x].append(i)
    assert {i: sorted(x[1]) for i, x in got.items()} == {i: sorted(x) for i, x in later.items()}
    assert parts > len(ways) if piece < 10 else parts == len(ways)
    assert tree.histories(df.limit(0), "i", "p", "page").count() == 0


def test_batches_of_histories(spark, monkeypatch):
    """Trees larger than a batch and batches that end within a tree give the same rows."""
    import pyarrow as pa

    r = random.Random(12)
    edges = [(i, r.choice([None, max(1, i - 1), r.randint(1, i)])) for i in range(1, 300)]
    df = spark.createDataFrame([(i, p, i // 50, 7, "x") for i, p in edges if p != i], EDGE)
    iv = tree.intervals(df, "i", "p", "page").selectExpr("id", "parent", "root", "depth", "entry", "exit AS leave", "0L AS piece", "false AS spine").orderBy("root", "entry").toArrow()
    run = lambda step: pa.Table.from_batches(list(tree._history_batches(b for k in range(0, iv.num_rows, step) for b in iv.slice(k, step).to_batches()))).to_pylist()
    whole = run(1000)
    monkeypatch.setattr(tree, "TREE_ROWS", 7)
    monkeypatch.setattr(tree, "BATCH_IDS", 20)
    assert sorted(run(5), key=str) == sorted(whole, key=str) and len(whole) == iv.num_rows


def test_levels_that_do_not_contract_are_doubled(spark):
    r, n = random.Random(5), 600
    edges = [(i, r.choice([0, r.randint(1, n), r.randint(1, n)])) for i in range(1, n + 1)]
    df = spark.createDataFrame([(i, p, r.randint(1, 99), 0, "") for i, p in edges], EDGE)
    got = {x["id"]: (x["root"], x["depth"]) for x in tree.hierarchy(df, "i", "p", "page", block_rows=20).collect()}
    assert got == brute(edges)[1]


def test_empty_hierarchy(spark):
    assert rows(tree.hierarchy(spark.createDataFrame([], EDGE), "i", "p", "page")) == []
    assert rows(tree.hierarchy(spark.createDataFrame([(4, 4, 1, 1, "")], EDGE), "i", "p", "page")) == [(4, 4, -1)]


# --- orphans ---


def test_containers():
    import numpy as np

    for low in ([], [0], [65535], range(0, 65536, 17), range(4095), range(4096), range(4097), range(65536)):
        low = np.array(low, np.int64)
        assert np.flatnonzero(unpack(pack(low))).tolist() == low.tolist()


def test_orphans(spark):
    data = [(1, None, 5, -1), (2, 1, 6, 3), (3, 99, 7, 3), (3, 99, 7, 3), (4, 10**14, -8, 4), (None, 99, 0, 3)]
    refs = spark.createDataFrame(data, "key long, parent long, page long, period int")
    key = lambda f, *v: spark.createDataFrame([(f, x) for x in v], "field string, key long")
    parents = key("parent", 1, 2, 3, 4).unionByName(key("page", 5, 6, 6))
    got = rows(orphan_references(refs.filter("key IS NOT NULL"), ["parent", "page"], parents, key("page", 6, 1234), ["key"]))
    assert got == [("page", 2, 6, 3), ("page", 3, 7, 3), ("page", 4, -8, 4), ("parent", 3, 99, 3), ("parent", 4, 10**14, 4)]
    none = key("parent").limit(0)
    assert len(rows(orphan_references(refs, ["page"], none, none, ["key"]))) == 4
    assert rows(orphan_references(refs.limit(0), ["page"], parents, none, ["key"])) == []


def test_hot_range_is_merged_before_it_is_compared(spark):
    from palimpsest.operators import orphans

    # One bundle range over many batches and tasks: a third of a million rows of 40 keys and 3 periods.
    hot = spark.range(0, 300_000, 1, 6).select(F.lit("b").alias("field"), (F.col("id") % 40 + 1).alias("key"), (F.col("id") % 3).cast("int").alias("period"), F.lit(0).alias("kind"))
    per_task = orphans.bitmaps(hot)
    assert per_task.count() == 6 * 3
    whole = orphans.united(per_task).collect()
    assert sorted((r["field"], r["chunk"], r["kind"], r["period"], len(unpack(r["bits"]).nonzero()[0])) for r in whole) == [("b", 0, 0, k, 40) for k in range(3)]
    assert orphans.bitmaps(hot.limit(0)).count() == 0 and orphans.united(per_task.limit(0)).count() == 0


def test_handed_over_containers_are_united(spark, monkeypatch):
    import numpy as np
    import pandas as pd

    from palimpsest.operators import orphans

    monkeypatch.setattr(orphans, "HELD_KEYS", 10)
    taken = []
    monkeypatch.setattr(orphans, "DataFrame", object)

    class Rows:  # runs the task function on batches
        def select(self, *_):
            return self

        def mapInPandas(self, f, _):
            frames = [pd.DataFrame({"field": "x", "key": np.arange(k, k + 30), "period": 1, "kind": 0}) for k in (0, 20, 65530)]
            taken.extend(f(iter(frames)))

    orphans.bitmaps(Rows())
    assert sum(map(len, taken)) == 4 and all(t["chunk"].isin([0, 1]).all() for t in taken)


def test_dictionary(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "k string")
    assert rows(dictionary(df, "k")) == [("a", 1), ("b", 2)]


# --- repeated messages ---

MSG = "m long, t long, d long, a string, bucket string"


def test_one_copy_stays(spark, tmp_path, monkeypatch):
    from palimpsest.operators import dedup

    monkeypatch.setattr(dedup, "PREFIX_IDS", 40)  # the index outgrows its prefixes on the way
    monkeypatch.setattr(dedup, "LEAST_BITS", 1)
    r = random.Random(1)
    data = [(r.randint(1, 60), r.choice([None, 1, 2]), d, "x", None) for d in range(1, 400)] + [(7, 7, d, "hot", None) for d in range(400, 800)]
    index = DedupIndex(spark, str(tmp_path))
    kept, want, seen = [], set(), set()
    for m, t, d, *_ in data:
        if t is not None and (m, t) not in seen:
            seen.add((m, t))
            want.add(d)
    frames = []
    for k in range(0, 800, 80):  # ten batches: runs are merged on the way
        frames.append(index.ingest(spark.createDataFrame(data[k : k + 80], MSG), "m", "t", "d"))
    for f in frames:
        kept += rows(f)
    assert {x[2] for x in kept} == want and len(kept) == len(want)
    runs = index._state()[1]
    assert len(runs) < 10 and len({x["bits"] for x in runs}) > 1 or runs[0]["bits"] > 1
    assert rows(index.ingest(spark.createDataFrame(data, MSG), "m", "t", "d")) == []
    assert rows(index.ingest(spark.createDataFrame([], MSG), "m", "t", "d")) == []
    index.merge()
    index.vacuum()
    assert rows(DedupIndex(spark, str(tmp_path)).ingest(spark.createDataFrame([*data, (999, 1, 900, "", "")], MSG), "m", "t", "d")) == [(999, 1, 900)]
    df = spark.createDataFrame(data, MSG)
    assert repeats(df, df.filter(F.col("d").isin(list(want))), "d").count() == len(data) - len(want)


def test_lookup_compares_identifiers_of_equal_hash():
    import numpy as np

    from palimpsest.operators.dedup import bits_for, lookup, packed, tail

    h, a, b = np.array([5, 5, 5, -1]), np.array([1, 2, 3, 9]), np.array([1, 1, 1, 9])
    out = packed(0, h, a, b, a)
    run = [np.frombuffer(out[c][0], "<i8") for c in ("h", "a", "b")]
    assert lookup(np.array([5, 5, -1, 7]), np.array([3, 4, 9, 1]), np.array([1, 1, 9, 1]), run).tolist() == [True, False, True, False]
    assert tail([100, 1, 1, 1]) == 3 and tail([4, 1, 1, 1]) == 4 and tail([100, 1]) == 2 and tail([5]) == 1
    assert bits_for(0) == bits_for(10**6) == 4 and bits_for(10**9) == 10


# --- skew ---

LOG = "page long, d long, n long, _k string, n_rows string"


def test_profile_and_heavy_keys(spark):
    r = random.Random(2)
    data = [(r.choice([1, 1, 1, 1, 2, 3, None, 0, r.randint(4, 300)]), d, r.choice([None, 5]), "", "") for d in range(3000)] + [(9, None, 1, "", "")]
    df = spark.createDataFrame(data, LOG)
    got = {x["page"]: tuple(x)[1:] for x in skew.group_profile(df, "page", "d", "n", parts=7).collect()}
    want = {}
    for p, d, n, *_ in data:
        w = want.setdefault(p, [0, [], 0])
        w[0] += 1
        w[1] += [] if d is None else [d]
        w[2] += n or 0
    for p, (n, ds, total) in want.items():
        gaps = [b - a for a, b in zip(ds, ds[1:], strict=False)]
        assert got[p] == (n, min(ds, default=None), max(ds, default=None), total, max(gaps, default=0)), p
    heavy = rows(skew.heavy_keys(df, "page", "d", 0.05, parts=5))
    assert heavy == sorted((p, w[0]) for p, w in want.items() if p and w[0] >= 0.05 * len(data))
    assert rows(skew.heavy_keys(df.limit(0), "page", "d", 0.05)) == [] and rows(skew.group_profile(df.limit(0), "page", "d", "n")) == []


def test_running_sum(spark):
    data = [(k, i, i % 5 if i % 7 else None) for k in ("a", "b", None) for i in range(200)]
    out = skew.running_sum(spark.createDataFrame(data, "k string, i long, v long"), ["k"], ["i"], "v", "s", 6)
    total = {}
    for k, i, v in data:
        total[k, i] = total.get((k, i - 1), 0) + (v or 0)
    assert {(r["k"], r["i"]): r["s"] for r in out.collect()} == total


# --- merges ---


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", None)], "id long, v string, f long")
    new = spark.createDataFrame([(2, "c", 8, 1), (2, "d", 9, 2), (3, "e", None, 1), (None, "x", 1, 1)], "id long, v string, f long, seq long")
    assert rows(upsert(old, new, "id", ["seq"], keep=["f"]).na.fill(0)) == [(1, "a", 5), (2, "d", 9), (3, "e", 0)]
    assert rows(insert_ignore(old, new, "id", ["seq"]).na.fill(0)) == [(1, "a", 5), (2, "b", 0), (3, "e", 0)]
    assert rows(first_wins(new.na.drop(), ["id"], ["seq"])) == [(2, "c", 8, 1)] and rows(last_wins(new.na.drop(), ["id"], ["seq"])) == [(2, "d", 9, 2)]
    assert rows(next_ids(new.filter("v <> 'x'"), "v", 10)) == [("c", 11), ("d", 12), ("e", 13)]
    assert rows(upsert(old, new.limit(0), "id", ["seq"]).na.fill(0)) == [(1, "a", 5), (2, "b", 0)]
