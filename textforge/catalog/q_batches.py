"""Batches over a dense index of the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from textforge.catalog import sql as S
from textforge.catalog.inputs import SEED, documents
from textforge.catalog.registry import query
from textforge.operators import batches as B
from textforge.operators.ordering import dense_index

INDEXED = f"""indexed AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY {S.h(SEED, 'doc_id')}, doc_id) - 1 AS idx FROM documents),
n AS (SELECT count(*) AS n FROM documents)"""


def indexed(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "n_chars")
    return dense_index(docs, ["doc_id"], SEED), docs.count()


@query("eval_take", f"WITH {INDEXED} SELECT doc_id, idx FROM indexed WHERE idx < 8 * 25")
def eval_take(spark, sf_dir):
    return B.take_first(indexed(spark, sf_dir)[0], 8 * 25).select("doc_id", "idx")


@query("repeat_rows", f"""
WITH {INDEXED} SELECT row_no, doc_id FROM n, (SELECT unnest(range((SELECT 3 * (n // 7) * 7 FROM n))) AS row_no)
JOIN indexed ON idx = row_no % n""")
def repeat_rows(spark, sf_dir):
    rows, n = indexed(spark, sf_dir)
    return B.repeat_to(rows, n, 3 * (n // 7), 7).select("row_no", "doc_id")


@query("make_batches", f"""
WITH {INDEXED} SELECT idx // 16 AS batch_id, count(*) AS n_rows, string_agg(doc_id::VARCHAR, ',' ORDER BY idx) AS doc_ids,
  sum(n_chars)::BIGINT AS n_chars FROM indexed, n WHERE idx // 16 < n // 16 GROUP BY 1""")
def make_batches(spark, sf_dir):
    rows, n = indexed(spark, sf_dir)
    return B.make_batches(rows, 16, ["doc_id", "n_chars"], n).select(
        "batch_id", F.size("rows").cast("long").alias("n_rows"),
        F.array_join(F.transform("rows", lambda r: r.doc_id.cast("string")), ",").alias("doc_ids"),
        F.aggregate("rows", F.lit(0).cast("long"), lambda a, r: a + r.n_chars).alias("n_chars"))


@query("replica_batches", f"""
WITH {INDEXED} SELECT idx // 32 AS batch_id, (idx % 32 // 8)::INT AS replica, count(*) AS n_rows, sum(doc_id)::BIGINT AS id_sum
FROM indexed GROUP BY 1, 2""")
def replica_batches(spark, sf_dir):
    return B.replica_batches(indexed(spark, sf_dir)[0], 32, 4).groupBy("batch_id", "replica").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("doc_id").alias("id_sum"))


@query("epoch_shuffle", " UNION ALL ".join(f"""
SELECT {e} AS epoch, doc_id, row_number() OVER (ORDER BY {S.h(SEED + e, 'doc_id')}, doc_id) - 1 AS idx FROM documents""" for e in range(3)))
def epoch_shuffle(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id")
    epochs = [B.epoch_shuffle(docs, ["doc_id"], SEED, e).select(F.lit(e).alias("epoch"), "doc_id", "idx") for e in range(3)]
    return epochs[0].union(epochs[1]).union(epochs[2])
