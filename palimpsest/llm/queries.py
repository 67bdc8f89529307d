"""Queries of the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import markup, mixing, neardup, packing, subjects
from palimpsest.llm.tokens import token_counts
from palimpsest.sources.tables import table

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


@query("p5_found")
def p5_found(spark, d):
    return markup.find_markup(table(spark, d, "documents"))


@query("p5_clean")
def p5_clean(spark, d):
    return markup.clean_texts(table(spark, d, "documents"))


#: Every pair with a phrase in common, counted: for small corpora only.
_PAIRS = r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
  s AS (SELECT DISTINCT doc_id, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) AS p FROM w WHERE len(w) >= 3),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1 HAVING count(*) >= 20), k AS (SELECT s.doc_id, p, n FROM s JOIN n ON s.doc_id = n.doc_id)
  SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM k a JOIN k b ON a.p = b.p AND a.doc_id < b.doc_id GROUP BY 1, 2 HAVING count(*) >= 0.7 * (any_value(a.n) + any_value(b.n) - count(*))"""


@query("p7_found", _PAIRS)
def p7_found(spark, d):
    cfg = neardup.NearDup(phrase=3, threshold=0.7, min_phrases=20)
    members, links = neardup.near_duplicates(table(spark, d, "documents"), cfg)
    return neardup.expand(members, links)


#: Classes of equal phrase sets and links between classes, over every phrase of every text: for small corpora only.
_CLASSES = r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
  s AS (SELECT doc_id, list_sort(list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] FOR i IN range(1, len(w) - 3)])) AS p FROM w WHERE len(w) >= 5),
  c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY p) AS class_id, p FROM s), r AS (SELECT class_id, unnest(p) AS q, len(p) AS n FROM c WHERE doc_id = class_id),
  l AS (SELECT a.class_id AS x, b.class_id AS y FROM r a JOIN r b ON a.q = b.q AND a.class_id < b.class_id GROUP BY 1, 2 HAVING count(*) >= 0.8 * (any_value(a.n) + any_value(b.n) - count(*)) - 1e-9),
  e AS (SELECT x AS class_id FROM l UNION ALL SELECT y FROM l)
  SELECT doc_id, class_id, (SELECT count(*) FROM e WHERE e.class_id = c.class_id) AS n_links FROM c"""


@query("p7_near_duplicates", _CLASSES)
def p7_near_duplicates(spark, d):
    """Five-word phrases, similarity 0.8: class and number of links of every document that has phrases."""
    members, links = neardup.near_duplicates(table(spark, d, "documents"))
    ends = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_links"))
    return members.join(ends, "class_id", "left").select("doc_id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


@query("p8_packing")
def p8_packing(spark, d):
    """Every text in containers of each kind."""
    return packing.pack(token_counts(table(spark, d, "documents"), ["doc_id"]), table(spark, d, "pack_sizes"))


@query("p8_fill")
def p8_fill(spark, d):
    return packing.fill_report(p8_packing(spark, d), table(spark, d, "pack_sizes"))


def _mix(spark, d):
    return mixing.draws(token_counts(table(spark, d, "documents"), ["doc_id", "source"]), table(spark, d, "mix_targets"))


@query("p9_mix")
def p9_mix(spark, d):
    """The mixed corpus: which text at which slot."""
    return _mix(spark, d)[0]


@query("p9_shares")
def p9_shares(spark, d):
    return _mix(spark, d)[1]


def _subjects(spark, d):
    docs = table(spark, d, "documents")
    return subjects.assign(docs, subjects.fit(docs, table(spark, d, "subject_labels"), table(spark, d, "subjects")))


@query("p10_found")
def p10_found(spark, d):
    return _subjects(spark, d)


@query("p10_composition")
def p10_composition(spark, d):
    """Make-up of the corpus: documents and characters per source and subject (a document with two subjects counts in both)."""
    docs = table(spark, d, "documents").select("doc_id", F.lower(F.trim("source")).alias("source"), F.char_length("text").cast("long").alias("size"))
    found = docs.join(_subjects(spark, d), "doc_id", "left")
    return found.groupBy("source", F.coalesce("subject", F.lit("none")).alias("subject")).agg(F.count("*").alias("documents"), F.sum("size").alias("characters"))
