"""Parent-child rows of unknown depth to roots, depths, tour intervals and cycles.

Rows are range-partitioned by a locality key, so most parents lie in their child's block. In each block leaves are peeled
until only cycles are left, cycle edges are cut, and Euler tours of the block's trees are
ranked by pointer jumping. The tops of trees whose parent lies in another block, with the distance and
the least id of the way to the top of that parent's tree, form a much smaller
graph of the same kind; it is solved in the same way until one block holds it. Where a level doesn't shrink, pointers are
doubled by joins instead. Nothing is gathered by the driver; each level is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.session import maybe_broadcast, remove, stage

BLOCK_ROWS = 150_000
_NODE = "id long, parent long, w long, val long, loc long, root long, base long"
_SOLVED = "id long, top long, dist long, pm long, done boolean, root long, depth long, ext long, w long, val long, loc long"
#: With places in the block's own tours: the tree a node stands in (a cycle cut at its least id only), its parent there, entry and exit.
_SPANNED = _SOLVED + ", tree long, up long, span long, entry long, leave long"
_INF = (1 << 63) - 1


def tour(parent, weight):
    """Euler tour of a forest given by parent positions (-1: root): (entry, exit, root, depth) per node by list ranking.

    Arcs down to v and up from v are v and n + v. Children follow one another by position. Ranks and sums come from pointer
    jumping: each round doubles the span a pointer covers, so the height of the forest does not matter.
    A down arc adds its node's weight and the up arc takes it off, so depth is the sum of weights up to a node's entry.
    """
    import numpy as np

    n = len(parent)
    kids = np.flatnonzero(parent >= 0)
    kids = kids[np.argsort(parent[kids], kind="stable")]
    own = parent[kids]
    first, succ = np.full(n, -1, np.int64), np.empty(2 * n, np.int64)
    start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(kids) else kids
    first[own[start]] = kids[start]
    succ[:n] = np.where(first >= 0, first, np.arange(n) + n)
    succ[n:] = np.where(parent >= 0, parent + n, np.arange(n) + n)  # a root's up arc ends its tour
    if len(kids) > 1:
        same = own[1:] == own[:-1]
        succ[n + kids[:-1][same]] = kids[1:][same]
    w = np.where(parent >= 0, weight, 0)
    rank, at, rest = (succ != np.arange(2 * n)).astype(np.int64), succ, np.r_[w, -w]
    rest[n:][parent < 0] = 0
    while True:
        nxt = at[at]
        if np.array_equal(nxt, at):
            break
        rank, rest, at = rank + rank[at], rest + rest[at], nxt
    root = at[:n] - n
    total = rank[root]  # arcs after the first of the tour
    return total - rank[:n], total - rank[n:], root, w - rest[:n]


def peel(parent):
    """Peel leaves: (children before parents order of the peeled nodes, mask of nodes on cycles)."""
    import numpy as np

    n = len(parent)
    deg = np.bincount(parent[parent >= 0], minlength=n).tolist()
    par, out = parent.tolist(), []
    for v in np.flatnonzero(np.asarray(deg) == 0).tolist():
        while True:
            out.append(v)
            v = par[v]
            if v < 0:
                break
            deg[v] -= 1
            if deg[v]:
                break
    on = np.ones(n, bool)
    on[out] = False
    return out, on


def _least(parent, val):
    """Minimum of ``val`` over the edges from each node to its root, by pointer jumping; no edge: the greatest integer."""
    import numpy as np

    at = np.where(parent >= 0, parent, np.arange(len(parent)))
    m = np.where(parent >= 0, val, _INF)
    while True:
        m, nxt = np.minimum(m, m[at]), at[at]
        if np.array_equal(nxt, at):
            return m
        at = nxt


def solve_block(pdf, spans: bool = False):
    """One block of level nodes: tops, distances and whatever is settled inside the block; with ``spans`` the tours' places too."""
    import numpy as np
    import pandas as pd

    pdf = pdf.sort_values("id", ignore_index=True)
    ids, n = pdf["id"].to_numpy(np.int64), len(pdf)
    has = pdf["parent"].notna().to_numpy()
    want = pdf["parent"].fillna(0).to_numpy(np.int64)
    pos = np.searchsorted(ids, want)
    pos[pos == n] = 0
    local = has & (ids[pos] == want)
    parent = np.where(local, pos, -1)
    outside = has & ~local
    w, val, root, base = (pdf[c].fillna(0).to_numpy(np.int64).copy() for c in ("w", "val", "root", "base"))
    _, on = peel(parent)
    whole = parent.copy()
    if on.any():  # cut the cycles: each of their nodes becomes a settled top
        seen, par, least = set(), parent.tolist(), val.tolist()
        for v in np.flatnonzero(on).tolist():
            if v in seen:
                continue
            ring, x = [], v
            while x not in seen:
                seen.add(x)
                ring.append(x)
                x = par[x]
            root[ring], base[ring] = min(least[i] for i in ring), -1
            whole[min(ring)] = -1  # positions are in order of the ids
        parent = np.where(on, -1, parent)
    entry, leave, top, dist = tour(parent, w)
    done = ~outside[top]
    cyclic = base[top] < 0
    out = pd.DataFrame({
        "id": ids, "top": ids[top], "dist": dist, "pm": _least(parent, val), "done": done,
        "root": pd.array(np.where(done, root[top], 0), "Int64"), "depth": np.where(cyclic, -1, base[top] + dist),
        "ext": pd.Series(want).where(pd.Series(outside)).astype("Int64"), "w": w, "val": val, "loc": pdf["loc"].fillna(0).to_numpy(np.int64),
    })
    if spans:
        tree = top
        if on.any():
            entry, leave, tree, _ = tour(whole, w)
        above = pd.Series(want).where(pd.Series((whole >= 0) | outside)).astype("Int64")
        out = out.assign(tree=ids[tree], up=above, span=(leave - entry - 1) // 2, entry=entry, leave=leave)
    return out


def _blocks(spans: bool):
    def run(batches):
        import pandas as pd

        got = list(batches)
        if got and sum(map(len, got)):
            yield solve_block(pd.concat(got, ignore_index=True), spans)

    return run


def _double(nodes: DataFrame, n: int) -> DataFrame:
    """Pointer doubling for a level that doesn't contract: O(log n) joins; what is unsettled afterwards is cyclic."""
    cols = ("parent", "w", "val", "root", "base")
    cur, path = stage(nodes.select("id", *cols), "double")
    for _ in range(n.bit_length() + 1):
        p = cur.select(F.col("id").alias("_p"), *[F.col(c).alias("_" + c) for c in cols])
        j = cur.join(p, cur["parent"] == p["_p"], "left")
        hit = F.col("_p").isNotNull()
        end, on = hit & F.col("_parent").isNull(), hit & F.col("_parent").isNotNull()
        nxt = j.select(
            "id", F.when(hit, F.col("_parent")).otherwise(F.col("parent")).alias("parent"), F.when(on, F.col("w") + F.col("_w")).otherwise(F.col("w")).alias("w"),
            F.when(on, F.least("val", "_val")).otherwise(F.col("val")).alias("val"), F.when(end, F.col("_root")).otherwise(F.col("root")).alias("root"),
            F.when(end, F.when(F.col("_base") < 0, F.lit(-1)).otherwise(F.col("_base") + F.col("w"))).otherwise(F.col("base")).cast("long").alias("base"),
        )
        new, new_path = stage(nxt, "double")
        remove(nodes.sparkSession, path)
        cur, path = new, new_path
        if cur.filter("parent IS NOT NULL").isEmpty():
            break
    # A pointer that never ends stands on the cycle it runs into; that node's own way covers exactly the cycle.
    ring = cur.select(F.col("id").alias("_p"), F.col("val").alias("_val"))
    j = cur.join(ring, cur["parent"] == ring["_p"], "left")
    loose = F.col("parent").isNotNull()
    return j.select("id", F.when(loose, F.col("_val")).otherwise(F.col("root")).alias("root"), F.when(loose, F.lit(-1)).otherwise(F.col("base")).cast("long").alias("depth"))


def _contract(nodes: DataFrame, n: int, block_rows: int, spans: bool = False) -> tuple[DataFrame, DataFrame]:
    """(solved blocks, level above): the nodes of the level above are tops whose parent lies in another block.

    With ``spans`` the level also tells the tree (column ``tree``) that a top hangs on; NULL if its parent is nowhere.
    """
    spark = nodes.sparkSession
    parts = max(1, -(-n // block_rows))
    # One block holds a level of at most block_rows nodes.
    ranged = nodes.repartitionByRange(parts, "loc", "id") if parts > 1 else nodes.coalesce(1)
    out, path = stage(ranged.mapInPandas(_blocks(spans), _SPANNED if spans else _SOLVED), "blocks")
    tops = out.filter("ext IS NOT NULL").select("id", "ext", "w", "val", "loc")
    where = [F.col("tree")] if spans else []
    p = out.select(F.col("id").alias("ext"), F.col("top").alias("_top"), "dist", "pm", "done", F.col("root").alias("_root"), F.col("depth").alias("_depth"), *where)
    hooks, hooks_path = stage(tops, "tops")
    j = p.join(maybe_broadcast(hooks, hooks_path), "ext", "right")
    absent, done = F.col("_top").isNull(), F.coalesce("done", F.lit(True))
    up = j.select(
        "id", F.when(~done, F.col("_top")).alias("parent"), F.when(done, F.col("w")).otherwise(F.col("w") + F.col("dist")).alias("w"),
        F.when(done, F.col("val")).otherwise(F.least("val", "pm")).alias("val"), "loc",
        F.when(absent, F.col("id")).when(done, F.col("_root")).alias("root"),
        F.when(absent, F.lit(0)).when(done, F.when(F.col("_depth") < 0, F.lit(-1)).otherwise(F.col("_depth") + F.col("w"))).cast("long").alias("base"), *where,
    )
    return out, stage(up, "level")[0]


def _settle(out: DataFrame, level: DataFrame, n: int, block_rows: int) -> DataFrame:
    """(id, root, depth) of all nodes of solved blocks, once the level above is solved."""
    m = level.count()
    settled = out.filter("done").select("id", "root", "depth")
    if not m:
        return settled
    above, above_path = stage(solve(level.drop("tree"), m, block_rows, n), "above")
    a = above.select(F.col("id").alias("top"), F.col("root").alias("_root"), F.col("depth").alias("_depth"))
    rest = out.filter("NOT done").select("id", "top", "dist").join(maybe_broadcast(a, above_path), "top").select(
        "id", F.col("_root").alias("root"), F.when(F.col("_depth") < 0, F.lit(-1)).otherwise(F.col("_depth") + F.col("dist")).cast("long").alias("depth")
    )
    return settled.unionByName(rest)


def solve(nodes: DataFrame, n: int, block_rows: int = BLOCK_ROWS, last: int | None = None) -> DataFrame:
    """(id, root, depth) of level nodes (see ``_NODE``): ``w`` is summed along the way to the root.

    ``root`` and ``base`` of a node without parent say where it ends. A parent that is no
    node ends its child as a root. On a way into a cycle depth is -1 and root the least ``val`` on the cycle.
    """
    if last is not None and n > 0.7 * last and n > block_rows:
        return _double(nodes, n)
    return _settle(*_contract(nodes, n, block_rows), n, block_rows)


def edges(df: DataFrame, key: str, parent: str, locality: str) -> DataFrame:
    """One level node per usable key (neither NULL nor 0). Copies agree on the parent; if they don't, the greatest is taken.

    NULL and 0 both mean no parent. A NULL locality groups with 0.
    """
    k, p = F.col(key).cast("long"), F.nullif(F.col(parent).cast("long"), F.lit(0))
    one = df.select(k.alias("id"), p.alias("parent"), F.col(locality).cast("long").alias("loc")).filter("id <> 0").groupBy("id").agg(F.max("parent").alias("parent"), F.coalesce(F.max("loc"), F.lit(0)).alias("loc"))
    root = F.when(F.col("parent").isNull(), F.col("id"))
    zero = F.when(F.col("parent").isNull(), F.lit(0)).cast("long")
    one_ = F.lit(1).cast("long")
    return one.select("id", "parent", one_.alias("w"), F.col("parent").alias("val"), "loc", root.alias("root"), zero.alias("base"))


def hierarchy(df: DataFrame, key: str, parent: str, locality: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, root, depth) per key: depth 0 at a root; -1 and the least id of the cycle where the parents never end.

    A self-parent is a cycle of one. An empty table gives no rows; other columns of ``df`` are ignored.
    """
    nodes, path = stage(edges(df, key, parent, locality), "nodes")
    return solve(nodes, nodes.count(), block_rows).select("id", "root", "depth")


_PLACE = ("id", "parent", "root", "depth", "entry", "exit", "n_descendants")


def intervals(df: DataFrame, key: str, parent: str, locality: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, parent, root, depth, entry, exit, n_descendants) of all keys; keys lie within 2**62 of zero.

    ``entry`` and ``exit`` number the arcs of the Euler tour of a key's tree, children in order of their keys: u is an ancestor of v if both have one
    root and entry_u < entry_v and exit_v < exit_u. A cycle is cut above its least key, which so becomes the root of all that hangs on the cycle (depth
    stays -1). ``parent`` is NULL at roots.

    Trees that lie in one block are ranked there. Only trees that reach over blocks are taken together: the arcs of their tours form lists, which
    the same solver ranks.
    """
    nodes, _ = stage(edges(df, key, parent, locality), "nodes")
    n = nodes.count()
    out, level = _contract(nodes, n, block_rows, spans=True)
    solved = _settle(out, level, n, block_rows)
    linked = level.filter("tree IS NOT NULL")  # a top whose parent is nowhere is a root
    joined, path = stage(linked.select(F.col("id").alias("tree")).unionByName(linked.select("tree")).distinct(), "joined")
    joined = maybe_broadcast(joined, path)
    done = F.col("done")
    closed = out.join(joined, "tree", "left_anti").select(
        "id", F.when(F.col("tree") != F.col("id"), F.col("up")).alias("parent"), F.when(done, F.col("root")).otherwise(F.col("tree")).alias("root"),
        F.when(done, F.col("depth")).otherwise(F.col("dist")).alias("depth"), "entry", F.col("leave").alias("exit"), F.col("span").alias("n_descendants"),
    )
    if linked.isEmpty():
        return closed.select(*_PLACE)
    open_ = out.join(joined, "tree", "left_semi").select("id", F.coalesce("up", "ext").alias("parent"), "loc").join(solved, "id")
    e, _ = stage(open_.withColumn("parent", F.when(F.col("id") != F.col("root"), F.col("parent"))), "edges")
    return closed.select(*_PLACE).unionByName(_ranked(e, block_rows).select(*_PLACE))


def _ranked(e: DataFrame, block_rows: int) -> DataFrame:
    """Places of the nodes of whole trees (id, parent, loc, root, depth) by list ranking over blocks."""
    from palimpsest.operators.index import number_rows

    kids = number_rows(e.filter("parent IS NOT NULL").select("id", "parent"), ["parent", "id"])  # heavy parents span partitions
    kids, _ = stage(kids, "kids")
    nxt = kids.alias("a").join(kids.alias("b"), (F.col("a.rn") + 1 == F.col("b.rn")) & (F.col("a.parent") == F.col("b.parent"))).select(F.col("a.id").alias("id"), F.col("b.id").alias("sibling"))
    first = kids.groupBy("parent").agg(F.min("id").alias("first")).withColumnRenamed("parent", "id")
    full = e.join(nxt, "id", "left").join(first, "id", "left")
    down, up = F.col("id") * 2, F.col("id") * 2 + 1
    arcs = full.select("loc", F.explode(F.array(
        F.struct(down.alias("id"), F.coalesce(F.col("first") * 2, up).alias("parent")),
        F.struct(up.alias("id"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1).alias("parent")),
    )).alias("x"))
    ends = F.col("x.parent").isNull()
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    level, _ = stage(arcs.select("x.id", "x.parent", one.alias("w"), F.col("x.parent").alias("val"), "loc", F.when(ends, F.col("x.id")).alias("root"), F.when(ends, zero).alias("base")), "arcs")
    ranked, _ = stage(solve(level, level.count(), block_rows).select(F.col("id").alias("arc"), F.col("depth").alias("rank")), "ranks")
    r = ranked.select(F.shiftright("arc", 1).alias("id"), (F.col("arc") % 2 == 0).alias("down"), "rank")
    both = r.groupBy("id").agg(F.max(F.when(F.col("down"), F.col("rank"))).alias("d"), F.max(F.when(~F.col("down"), F.col("rank"))).alias("u"))
    total = both.join(e.select("id", "parent", "root", "depth"), "id")
    roots = total.filter("id = root").select("root", F.col("d").alias("total"))
    return total.join(roots, "root").select(
        "id", "parent", "root", "depth", (F.col("total") - F.col("d")).alias("entry"), (F.col("total") - F.col("u")).alias("exit"), ((F.col("d") - F.col("u") - 1) / 2).cast("long").alias("n_descendants")
    )


_HISTORY = "id long, root long, depth long, path array<long>, part long, later array<long>"
#: Arcs of a tour that make one piece, about rows taken together, and ids of a batch of results.
PIECE_ARCS, TREE_ROWS, BATCH_IDS = 200_000, 100_000, 1 << 18


def history_of(ids, parents, roots, depths, entry, leave, piece, spine):
    """Batches of (ids, roots, depths, path lengths or -1, paths, pieces, later lengths, later) of pieces of trees.

    Rows of one (root, piece) adjoin in order of entry; ``spine`` rows are ancestors of the piece that begin before it. Ways up are walked for a
    batch of rows at once. The keys below a key follow it in order of entry, so nothing is compared in pairs.
    """
    import numpy as np

    n = len(ids)
    if not n:
        return
    begin = np.r_[True, (roots[1:] != roots[:-1]) | (piece[1:] != piece[:-1])]
    group = np.cumsum(begin) - 1
    # Position of the parent, which is in the piece or on its spine.
    order = np.lexsort((ids, group))
    names, inverse = np.unique(ids, return_inverse=True)
    at = np.searchsorted(names, parents)
    at[at == len(names)] = 0
    has = (names[at] == parents) & (entry > 0)
    code = group * len(names)
    pos = np.searchsorted((code + inverse)[order], code + at)
    pos[pos == n] = 0
    up = np.where(has, order[pos], -1)
    length, jump = np.where(up >= 0, 1, 0), np.where(up >= 0, up, np.arange(n))
    while True:
        nxt = jump[jump]
        if np.array_equal(nxt, jump):
            break
        length, jump = length + length[jump], nxt
    length += 1
    # Entries of all pieces as one ascending row, to find the end of each subtree.
    wide = entry.max() + 2
    end = np.searchsorted(group * wide + entry, group * wide + np.minimum(leave, wide - 1))
    first_own = np.flatnonzero(begin)[group] + np.bincount(group, weights=spine).astype(np.int64)[group]
    start = np.where(spine, first_own, np.arange(n) + 1)
    below = np.maximum(end - start, 0)
    rows = np.flatnonzero(~spine | (below > 0))
    shown = np.where(spine, 0, length)[rows]
    many = below[rows]
    total = np.cumsum(shown + many)
    a = 0
    while a < len(rows):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + BATCH_IDS, side="right")))
        at, rest = rows[a:b], shown[a:b]
        flat = np.empty(rest.sum(), np.int64)
        put = np.cumsum(rest) - 1
        walk = rest > 0
        x, left, put = at[walk], rest[walk], put[walk]
        while len(x):
            flat[put] = ids[x]
            more = left > 1
            x, put, left = up[x[more]], put[more] - 1, left[more] - 1
        k = many[a:b]
        step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        yield ids[at], roots[at], depths[at], np.where(spine[at], -1, rest), flat, piece[at], k, ids[np.repeat(start[at], k) + step]
        a = b


def _pieces(batches):
    """Whole pieces at a time out of batches sorted by root, piece and entry."""
    import numpy as np

    held, rows, most = [], 0, TREE_ROWS
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([np.asarray(c.fill_null(0) if c.null_count else c) if str(c.type) != "bool" else np.asarray(c.to_numpy(zero_copy_only=False), bool) for c in batch.columns])
        rows += batch.num_rows
        if rows >= most:
            whole = [np.concatenate(x) for x in zip(*held, strict=True)]
            last = (whole[2] == whole[2][-1]) & (whole[6] == whole[6][-1])
            cut = int(np.argmax(last))
            if cut:
                yield from history_of(*[x[:cut] for x in whole])
            held, rows = [[x[cut:] for x in whole]], rows - cut
            most = max(TREE_ROWS, 2 * rows)
    if rows:
        yield from history_of(*[np.concatenate(x) for x in zip(*held, strict=True)])


def _history_batches(batches):
    import numpy as np
    import pyarrow as pa

    def lists(lengths, values):
        none = pa.array(lengths < 0) if (lengths < 0).any() else None
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.maximum(lengths, 0))], pa.int32()), pa.array(values, pa.int64()), mask=none)

    for ids, roots, depths, length, path, piece, many, later in _pieces(batches):
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(roots), pa.array(depths), lists(length, path), pa.array(piece), lists(many, later)], ["id", "root", "depth", "path", "part", "later"])


def histories(df: DataFrame, key: str, parent: str, locality: str, block_rows: int = BLOCK_ROWS, piece_arcs: int | None = None) -> DataFrame:
    """(id, root, depth, path, part, later) of every key: the ids from the root down to the key, and all keys below it.

    Where the parents never end (depth -1) the way begins at the least key of the cycle, where the cycle is cut. A tree with a longer tour than ``piece_arcs``
    is cut into pieces of its tour, each taken by a task of its own together with the ancestors that reach into it; a key whose descendants
    reach into further pieces has a row for each (``part``, ascending), of which only the first has a path. The size of the result is the sum of all depths.
    """
    arcs = PIECE_ARCS if piece_arcs is None else piece_arcs
    iv, _ = stage(intervals(df, key, parent, locality, block_rows), "intervals")
    piece = lambda c: F.floor(F.col(c) / arcs).cast("long")
    # The last descendant of a key begins two arcs before its exit.
    last = F.greatest(piece("entry"), F.floor((F.col("exit") - 2) / arcs).cast("long"))
    rows = iv.withColumn("piece", F.explode(F.sequence(piece("entry"), last))).withColumn("spine", F.col("piece") > piece("entry"))
    rows = rows.select("id", "parent", "root", "depth", "entry", F.col("exit").alias("leave"), "piece", "spine")
    return rows.repartition("root", "piece").sortWithinPartitions("root", "piece", "entry").mapInArrow(_history_batches, _HISTORY)


__all__ = ["edges", "hierarchy", "histories", "history_of", "intervals", "peel", "solve", "solve_block", "tour"]
