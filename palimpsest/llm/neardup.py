"""Texts that share most of their phrases: SetSketch registers, banded, estimated by likelihood, then verified.

A register is the exponentially spaced, truncated minimum of exponential hash values over a text's phrases:
K = floor(1 - log_B(min)), limited to 0..Q + 1. Equal registers are the likelier the more phrases two texts share, so texts
that agree in one band of registers are candidates. Of a candidate pair the Jaccard similarity is
estimated by maximum likelihood from how many registers are greater, less and equal, given both sizes; pairs
clearly below the threshold are dropped there, and the phrases of the others are compared.

Texts that share much wording without being alike (one template) fill buckets in which pairs are nearly all in vain. The members of a
bucket beyond a bound are therefore not paired there but meet over their rarest phrases: two texts at the threshold share one of the first few of each in any
common order of phrases, so no link is lost, and texts that only share the template's wording do not meet.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.session import maybe_broadcast, stage


@dataclass(frozen=True)
class NearDup:
    """``phrase`` words per phrase; pairs of at least ``threshold`` among texts of at least ``min_phrases`` phrases.

    ``bands`` of ``rows`` registers: a pair of similarity s is missed with probability (1 - s**rows)**bands at most.
    ``slack``: standard deviations below the threshold at which an estimate is trusted to be too low.
    """

    phrase: int = 5
    threshold: float = 0.8
    min_phrases: int = 1
    bands: int = 32
    rows: int = 3
    base: float = 1.02
    rate: float = 20.0
    limit: int = 65534
    slack: float = 4.5
    #: Members of a bucket beyond which it is not paired.
    crowd: int = 256

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def sketch(p, bounds, cfg: NearDup):
    """Registers (uint16, texts x registers) of phrase sets; a text without phrases has zeros."""
    import numpy as np

    from palimpsest.llm.words import mix

    n, m = len(bounds) - 1, cfg.registers
    full = np.flatnonzero(np.diff(bounds) > 0)
    low = np.full((m, n), 0, np.uint64)
    seeds = mix(np.arange(1, 2 * m + 1, dtype=np.uint64))
    a, b = seeds[:m] | np.uint64(1), seeds[m:]
    step = 32_768  # phrases per pass: they stay in the cache while all registers are taken
    low[:, full] = np.uint64(0xFFFFFFFF)
    at = 0
    while at < len(full):
        # Texts whose phrases begin within one step; a longer text is cut into parts whose minima are merged.
        lo = bounds[full[at]]
        to = max(at + 1, int(np.searchsorted(bounds[full], lo + step, "left")))
        hi = bounds[full[to - 1] + 1]
        starts = bounds[full[at:to]] - lo
        for s in range(lo, hi, step) if to == at + 1 else (lo,):
            x = mix(p[s : min(hi, s + step)] if to == at + 1 else p[lo:hi])
            y = np.empty_like(x)
            for j in range(m):
                np.multiply(x, a[j], out=y)
                np.add(y, b[j], out=y)
                np.right_shift(y, np.uint64(32), out=y)
                if to == at + 1:
                    low[j, full[at]] = min(low[j, full[at]], y.min())
                else:
                    low[j, full[at:to]] = np.minimum.reduceat(y, starts)
        at = to
    u = (low.T.astype(np.float64) + 0.5) / 4294967296.0
    k = np.floor(1 - np.log(-np.log1p(-u) / cfg.rate) / np.log(cfg.base))
    out = np.clip(k, 0, cfg.limit + 1).astype(np.uint16)
    out[np.diff(bounds) == 0] = 0
    return out


def likelihood(ka, kb, na, nb, cfg: NearDup):
    """Maximum-likelihood Jaccard similarity of register rows, given the sets' sizes."""
    import numpy as np

    more, less = (ka > kb).sum(1), (ka < kb).sum(1)
    same = cfg.registers - more - less
    u = na / (na + nb)
    v = 1 - u
    c = (cfg.base - 1) / cfg.base
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * c) / np.log(cfg.base)
    top = np.minimum(u / v, v / u)

    def value(j):
        x, y = p(u - v * j), p(v - u * j)
        eps = 1e-12
        return more * np.log(np.maximum(x, eps)) + less * np.log(np.maximum(y, eps)) + same * np.log(np.maximum(1 - x - y, eps))

    lo, hi = np.zeros_like(u), top
    g = (5**0.5 - 1) / 2
    for _ in range(22):  # golden section: the likelihood has one maximum
        x, y = hi - g * (hi - lo), lo + g * (hi - lo)
        left = value(x) > value(y)
        hi, lo = np.where(left, y, hi), np.where(left, lo, x)
    return (lo + hi) / 2


def _sketches(docs: DataFrame, cfg: NearDup) -> DataFrame:
    def run(batches):
        import numpy as np
        import pandas as pd

        from palimpsest.llm.words import groups, mix, phrases

        for pdf in batches:
            texts, ids = pdf["text"].tolist(), pdf["doc_id"].to_numpy(np.int64)
            for a, b in groups(texts):
                p, bounds = phrases(texts[a:b], cfg.phrase)
                n = np.diff(bounds)
                keep = np.flatnonzero((n >= cfg.min_phrases) & (n > 0))
                k = sketch(p, bounds, cfg)
                s1, s2 = (np.r_[np.uint64(0), np.cumsum(mix(p + np.uint64(i)))] for i in (1, 1 << 50))
                yield pd.DataFrame({
                    "doc_id": ids[a:b][keep], "n": n[keep].astype(np.int32), "h1": (s1[bounds[1:]] - s1[bounds[:-1]])[keep].view(np.int64),
                    "h2": (s2[bounds[1:]] - s2[bounds[:-1]])[keep].view(np.int64), "regs": pd.Series([k[i].tobytes() for i in keep], dtype=object),
                })

    return docs.filter("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text").mapInPandas(run, "doc_id long, n int, h1 long, h2 long, regs binary")


def _bands(reps: DataFrame, cfg: NearDup) -> DataFrame:
    """(key, doc_id, n, crowd): a row for each text and band. Of a bucket that is crowded in a batch already, ``crowd`` + 1 members keep its key, which is enough to
    know it by; the others come with a key of their own and the flag, so a hot bucket is not sent whole to one task.
    """

    def run(batches):
        import numpy as np
        import pandas as pd

        from palimpsest.llm.words import mix

        for pdf in batches:
            if not len(pdf):
                continue
            k = np.frombuffer(b"".join(pdf["regs"]), np.uint16).reshape(len(pdf), cfg.bands, cfg.rows).astype(np.uint64)
            h = np.broadcast_to(mix(np.arange(cfg.bands, dtype=np.uint64) + np.uint64(77)), k.shape[:2])
            for r in range(cfg.rows):
                h = mix(h ^ k[:, :, r])
            key, doc = h.ravel(), np.repeat(pdf["doc_id"].to_numpy(np.int64), cfg.bands)
            order = np.argsort(key, kind="stable")
            begin = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
            nth = np.arange(len(key)) - np.repeat(begin, np.diff(np.r_[begin, len(key)]))
            over = np.zeros(len(key), bool)
            over[order] = nth > cfg.crowd
            key = np.where(over, mix(doc.view(np.uint64)), key)
            yield pd.DataFrame({"key": key.view(np.int64), "doc_id": doc, "n": np.repeat(pdf["n"].to_numpy(), cfg.bands), "crowd": over})

    return reps.select("doc_id", "n", "regs").mapInPandas(run, "key long, doc_id long, n int, crowd boolean")


def bucket_pairs(key, doc, n, cfg: NearDup):
    """(a, b, na, nb) of whole buckets of at most ``crowd`` members, rows sorted by bucket and size: pairs whose sizes allow the threshold."""
    import numpy as np

    group = np.cumsum(np.r_[True, key[1:] != key[:-1]])
    at, parts = np.arange(len(key) - 1), []
    for d in range(1, cfg.crowd):
        at = at[at + d < len(key)]
        # Sizes ascend within a bucket: a partner that is too large is followed by larger ones.
        at = at[(group[at] == group[at + d]) & (n[at] >= cfg.threshold * n[at + d] - 1e-9)]
        if not len(at):
            break
        parts.append(np.stack([at, at + d]))
    i, j = np.concatenate(parts, 1) if parts else np.empty((2, 0), np.int64)
    swap = doc[i] > doc[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    other = doc[i] != doc[j]
    i, j = i[other], j[other]
    return doc[i], doc[j], n[i], n[j]


def _met(rows: DataFrame, cfg: NearDup) -> DataFrame:
    """(a, b, na, nb): pairs that meet in a bucket; b is NULL for members of crowded buckets. Buckets come one after another out of a sort, and a task holds ``crowd``
    members of one at most.
    """

    def run(batches):
        import numpy as np
        import pandas as pd

        def shown(a, b=None, na=None, nb=None):
            none = pd.array([None] * len(a), "Int64")
            return pd.DataFrame({"a": a, "b": none if b is None else pd.array(b, "Int64"), "na": none if na is None else pd.array(na, "Int64"), "nb": none if nb is None else pd.array(nb, "Int64")})

        held, full = None, None  # rows of the bucket that is going on; the bucket found to be crowded
        for pdf in batches:
            flags = pdf["crowd"].to_numpy(bool)
            if flags.any():
                yield shown(np.unique(pdf["doc_id"].to_numpy(np.int64)[flags]))
            key, doc, n = (pdf[c].to_numpy(np.int64)[~flags] for c in ("key", "doc_id", "n"))
            if held is not None:
                key, doc, n = (np.concatenate(x) for x in zip(held, (key, doc, n), strict=True))
            if not len(key):
                held = None
                continue
            begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[begin, len(key)])
            crowded = np.repeat((size > cfg.crowd) | (key[begin] == full), size)
            if crowded.any():
                yield shown(np.unique(doc[crowded]))
            last = np.arange(len(key)) >= begin[-1]
            full = key[-1] if crowded[-1] else None
            done = ~crowded & ~last
            held = None if crowded[-1] else (key[last], doc[last], n[last])
            if done.any():
                yield shown(*bucket_pairs(key[done], doc[done], n[done], cfg))
        if held is not None:
            yield shown(*bucket_pairs(*held, cfg))

    return rows.repartition("key").sortWithinPartitions("key", "n", "doc_id").mapInPandas(run, "a long, b long, na int, nb int")


def _estimated(pairs: DataFrame, cfg: NearDup) -> DataFrame:
    def run(batches):
        import numpy as np

        for pdf in batches:
            if not len(pdf):
                continue
            ka, kb = (np.frombuffer(b"".join(pdf[c]), np.uint16).reshape(len(pdf), -1) for c in ("ra", "rb"))
            j = likelihood(ka, kb, pdf["na"].to_numpy(float), pdf["nb"].to_numpy(float), cfg)
            t = cfg.threshold
            yield pdf[j >= t - cfg.slack * (t * (1 - t) / cfg.registers) ** 0.5][["a", "b"]]

    return pairs.mapInPandas(run, "a long, b long")


def _phrase_sets(docs: DataFrame, cfg: NearDup) -> DataFrame:
    def run(batches):
        import numpy as np
        import pandas as pd

        from palimpsest.llm.words import groups, whole_phrases

        for pdf in batches:
            texts, ids = pdf["text"].tolist(), pdf["doc_id"].to_numpy(np.int64)
            for a, b in groups(texts):
                p, bounds = whole_phrases(texts[a:b], cfg.phrase)
                yield pd.DataFrame({"doc_id": ids[a:b], "p": pd.Series([p[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)], dtype=object)})

    return docs.mapInPandas(run, "doc_id long, p binary")


def _verified(pairs: DataFrame, cfg: NearDup) -> DataFrame:
    def run(batches):
        import numpy as np

        for pdf in batches:
            ok = []
            for x, y in zip(pdf["pa"], pdf["pb"], strict=True):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)  # distinct within each text
                both = np.concatenate([s, t])
                both.sort(kind="stable")  # merges two sorted runs
                common = int((both[1:] == both[:-1]).sum())
                ok.append(common >= cfg.threshold * (len(s) + len(t) - common) - 1e-9)
            yield pdf[np.array(ok, bool)][["a", "b"]] if len(pdf) else pdf[["a", "b"]]

    return pairs.mapInPandas(run, "a long, b long")


def _over_rare_phrases(docs: DataFrame, cfg: NearDup) -> DataFrame:
    """(a, b, na, nb): pairs of texts that may reach the threshold because they share one of their rarest phrases.

    Of n phrases, ordered by how many of the texts have them, the first n - ceil(threshold * n) + 1 are looked at: two texts that share none of these share too few at all.
    A phrase that most texts have comes last and is not looked at, so what meets over a phrase are texts that have it among their rarest.
    """

    def spread(batches):
        import numpy as np
        import pandas as pd

        from palimpsest.llm.words import groups, whole_phrases

        for pdf in batches:
            texts, ids = pdf["text"].tolist(), pdf["doc_id"].to_numpy(np.int64)
            for a, b in groups(texts):
                p, bounds = whole_phrases(texts[a:b], cfg.phrase)
                n = np.diff(bounds)
                yield pd.DataFrame({"doc_id": np.repeat(ids[a:b], n), "n": np.repeat(n, n).astype(np.int32), "p": p.view(np.int64)})

    rows, _ = stage(docs.mapInPandas(spread, "doc_id long, n int, p long"), "phrases")
    common = rows.groupBy("p").agg(F.count("*").alias("df")).filter("df > 1")
    # A phrase of one text only is rarest of all and meets no other: it need not be joined, only counted.
    shared = rows.join(common.select("p", "df"), "p")
    singles = rows.groupBy("doc_id").agg(F.max("n").alias("n")).join(shared.groupBy("doc_id").agg(F.count("*").alias("m")), "doc_id")
    w = Window.partitionBy("doc_id").orderBy("df", "p")
    ranked = shared.withColumn("r", F.row_number().over(w)).join(singles.select("doc_id", (F.col("n") - F.col("m")).alias("alone")), "doc_id")
    first = ranked.filter(F.col("alone") + F.col("r") <= F.col("n") - F.ceil(F.col("n") * cfg.threshold - 1e-9) + 1).select("doc_id", "n", "p")
    first, _ = stage(first, "rarest")
    x, y = first.select("p", F.col("doc_id").alias("a"), F.col("n").alias("na")), first.select("p", F.col("doc_id").alias("b"), F.col("n").alias("nb"))
    return x.join(y, "p").filter((F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.lit(cfg.threshold) * F.greatest("na", "nb") - 1e-9)).select("a", "b", "na", "nb").distinct()


def near_duplicates(docs: DataFrame, cfg: NearDup = NearDup()) -> tuple[DataFrame, DataFrame]:  # noqa: B008
    """(members, links) of documents (doc_id, text).

    members: (doc_id, class_id), class_id the least doc_id with the same set of phrases; links: (a, b), a < b, the class
    ids of different classes at or above the threshold. NULL texts, NULL ids and texts with too few phrases are in neither. Other
    columns are ignored; a doc_id with several texts counts with each of them. Copies are never paired with one another, and a crowded bucket is not
    paired at all (see ``_over_rare_phrases``).
    """
    sk, _ = stage(_sketches(docs, cfg), "sketches")
    classes = sk.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("class_id"))
    members, members_path = stage(sk.select("doc_id", "h1", "h2", "n").join(classes, ["h1", "h2", "n"]).select("doc_id", "class_id").distinct(), "members")
    reps = sk.join(members.filter("doc_id = class_id").select("doc_id"), "doc_id", "left_semi")
    met, _ = stage(_met(_bands(reps, cfg), cfg), "met")
    near = met.filter("b IS NOT NULL")
    crowd, crowd_path = stage(met.filter("b IS NULL").select(F.col("a").alias("doc_id")).distinct(), "crowd")
    if not crowd.isEmpty():
        near = near.unionByName(_over_rare_phrases(docs.select("doc_id", "text").join(maybe_broadcast(crowd, crowd_path), "doc_id", "left_semi"), cfg))
    cand, cand_path = stage(near.distinct(), "candidates")
    regs = sk.select("doc_id", "regs")
    with_a = cand.join(regs.select(F.col("doc_id").alias("a"), F.col("regs").alias("ra")), "a")
    with_b = with_a.join(regs.select(F.col("doc_id").alias("b"), F.col("regs").alias("rb")), "b")
    pairs, pairs_path = stage(_estimated(with_b, cfg), "estimated")
    involved = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    ids, ids_path = stage(involved, "involved")
    some = docs.select("doc_id", "text").join(maybe_broadcast(ids, ids_path), "doc_id", "left_semi")
    sets, _ = stage(_phrase_sets(some, cfg), "sets")
    pa = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("p").alias("pa")), "a")
    pb = pa.join(sets.select(F.col("doc_id").alias("b"), F.col("p").alias("pb")), "b")
    links, _ = stage(_verified(pb, cfg).distinct(), "links")
    return members, links


def expand(members: DataFrame, links: DataFrame) -> DataFrame:
    """All pairs (doc_id_a < doc_id_b): copies among themselves and the members of linked classes."""
    m = members.withColumnRenamed("doc_id", "d")
    same = m.select("class_id", F.col("d").alias("x")).join(m.select("class_id", F.col("d").alias("y")), "class_id").filter("x < y").select("x", "y")
    across = links.join(m.select(F.col("class_id").alias("a"), F.col("d").alias("x")), "a").join(m.select(F.col("class_id").alias("b"), F.col("d").alias("y")), "b").select("x", "y")
    both = same.unionByName(across)
    return both.select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b")).filter("doc_id_a < doc_id_b").distinct()
