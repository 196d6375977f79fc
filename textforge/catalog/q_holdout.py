"""Held-out set, packing and inventory queries; a document's ``source`` is its file."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textforge.catalog import sql as S
from textforge.catalog.inputs import SEED, documents, table
from textforge.catalog.registry import query
from textforge.functions.sentences import split_sentences
from textforge.operators import holdout, packing
from textforge.operators.batches import shard
from textforge.operators.ordering import dense_index
from textforge.storage import spread

N_TEST = 130
PACK_LIMIT = 9000
SMALL_INVENTORY = 200_000  # files

FILES_SQL = """files AS (SELECT (row_number() OVER (ORDER BY source) - 1) AS file_id, source, size, n_articles
  FROM (SELECT source, sum(n_chars)::BIGINT AS size, count(*) AS n_articles FROM documents GROUP BY source))"""
QUOTA_SQL = f"""{FILES_SQL}, n_files AS (SELECT count(*) AS f FROM files),
quota AS (SELECT file_id, source, n_articles,
  (floor((file_id + 1) * {N_TEST}::DOUBLE / f) - floor(file_id * {N_TEST}::DOUBLE / f))::BIGINT AS quota FROM files, n_files)"""
SAMPLE_SQL = f"""{QUOTA_SQL},
articles AS (SELECT f.file_id, doc_id AS article_no, text, lang FROM documents JOIN files f USING (source)),
sample AS (SELECT file_id, article_no FROM (
    SELECT file_id, article_no, row_number() OVER (PARTITION BY file_id ORDER BY {S.h(SEED, 'file_id', 'article_no')}, article_no) AS r
    FROM articles) JOIN quota USING (file_id) WHERE r <= quota)"""


def files(spark, sf_dir):
    """The inventory: one row per source, sorted, dense ids (an inventory fits one task)."""
    sizes = documents(spark, sf_dir).groupBy("source").agg(
        F.sum("n_chars").cast("long").alias("size"), F.count(F.lit(1)).alias("n_articles"))
    return sizes.select((F.row_number().over(Window.orderBy("source")) - 1).cast("long").alias("file_id"), "source", "size", "n_articles")


def quotas(spark, sf_dir):
    inventory = files(spark, sf_dir)
    n_files = inventory.count()
    return holdout.stratified_quota(inventory, N_TEST, n_files), n_files


def articles(spark, sf_dir, *columns):
    """One row per document; ``columns`` are computed before the join, and a short inventory is broadcast,
    so that no text moves to the few keys of the inventory."""
    docs = documents(spark, sf_dir)
    rows = (spread(docs, "doc_id") if columns else docs).select("source", F.col("doc_id").alias("article_no"), *columns)
    inventory = files(spark, sf_dir).select("file_id", "source")
    if inventory.count() <= SMALL_INVENTORY:
        inventory = F.broadcast(inventory)
    return rows.join(inventory, "source").select("file_id", *[c for c in rows.columns if c != "source"])


def sample(spark, sf_dir):
    quota, n_files = quotas(spark, sf_dir)
    return holdout.sample_per_file(articles(spark, sf_dir), quota, N_TEST, n_files, SEED)


@query("split_quota", S.with_ctes(QUOTA_SQL, "SELECT file_id, source, quota FROM quota"))
def split_quota(spark, sf_dir):
    return quotas(spark, sf_dir)[0].select("file_id", "source", "quota")


@query("split_sample", S.with_ctes(SAMPLE_SQL, "SELECT file_id, article_no FROM sample"))
def split_sample(spark, sf_dir):
    return sample(spark, sf_dir)


@query("split_counts", S.with_ctes(f"{SAMPLE_SQL}, {S.SENTENCES}", """
SELECT CASE WHEN s.article_no IS NULL THEN 'train' ELSE 'eval' END AS split, lang, count(*) AS n_articles,
  sum(n)::BIGINT AS n_sentences
FROM articles a LEFT JOIN sample s ON s.file_id = a.file_id AND s.article_no = a.article_no
JOIN (SELECT doc_id, count(*) AS n FROM sentences GROUP BY doc_id) c ON c.doc_id = a.article_no GROUP BY 1, 2"""))
def split_counts(spark, sf_dir):
    """Articles and sentences per split and language."""
    counted = articles(spark, sf_dir, "lang", F.size(split_sentences(F.col("text"))).alias("n"))
    return holdout.with_split(counted, sample(spark, sf_dir), N_TEST).groupBy("split", "lang").agg(
        F.count(F.lit(1)).alias("n_articles"), F.sum("n").cast("long").alias("n_sentences"))


@query("eval_articles", S.with_ctes(SAMPLE_SQL, """
SELECT file_id, article_no, md5(text) AS text_md5 FROM articles SEMI JOIN sample USING (file_id, article_no)"""))
def eval_articles(spark, sf_dir):
    return holdout.held_out(articles(spark, sf_dir, F.md5("text").alias("text_md5")), sample(spark, sf_dir), N_TEST)


@query("train_articles", S.with_ctes(SAMPLE_SQL, """
SELECT file_id, article_no, md5(text) AS text_md5 FROM articles ANTI JOIN sample USING (file_id, article_no)"""))
def train_articles(spark, sf_dir):
    return holdout.kept_for_training(articles(spark, sf_dir, F.md5("text").alias("text_md5")), sample(spark, sf_dir), N_TEST)


@query("heldout_overlap", S.with_ctes(SAMPLE_SQL, f"""
, hashes AS (SELECT md5({S.rstrip('text')}) AS md5 FROM articles SEMI JOIN sample USING (file_id, article_no)
  UNION SELECT md5({S.rstrip('text')}) FROM benchmark)
SELECT a.article_no, md5({S.rstrip('text')}) AS md5 FROM articles a ANTI JOIN sample s USING (file_id, article_no)
WHERE md5({S.rstrip('text')}) IN (SELECT md5 FROM hashes)""".lstrip()))
def heldout_overlap(spark, sf_dir):
    """Training articles that equal a held-out article or a benchmark item."""
    rows = articles(spark, sf_dir, "text")
    ids = sample(spark, sf_dir)
    hashes = holdout.held_out(rows, ids, N_TEST).select(holdout.article_hash(F.col("text")).alias("md5")).union(
        table(spark, sf_dir, "benchmark").select(holdout.article_hash(F.col("text")).alias("md5")))
    return holdout.held_out_overlap(holdout.kept_for_training(rows, ids, N_TEST), hashes).select("article_no", "md5")


@query("manifest_check", """
WITH found AS (SELECT doc_id, n_chars AS size, md5(text) AS md5 FROM documents WHERE doc_id % 11 <> 3),
expected AS (SELECT doc_id, n_chars AS size, CASE WHEN doc_id % 13 = 5 THEN md5(lang) ELSE md5(text) END AS md5
  FROM documents WHERE doc_id % 17 <> 4)
SELECT coalesce(f.doc_id, e.doc_id) AS doc_id, CASE WHEN e.md5 IS NULL THEN 'unexpected' WHEN f.md5 IS NULL THEN 'missing'
  WHEN e.md5 = f.md5 AND e.size = f.size THEN 'ok' ELSE 'changed' END AS status
FROM found f FULL JOIN expected e ON e.doc_id = f.doc_id""")
def manifest_check(spark, sf_dir):
    """Digests of the texts against a manifest with missing, altered and unlisted entries."""
    docs = documents(spark, sf_dir)
    found = docs.where(F.col("doc_id") % 11 != 3).select("doc_id", F.col("n_chars").alias("size"), F.md5("text").alias("md5"))
    expected = docs.where(F.col("doc_id") % 17 != 4).select(
        "doc_id", F.col("n_chars").alias("size"),
        F.when(F.col("doc_id") % 13 == 5, F.md5("lang")).otherwise(F.md5("text")).alias("md5"))
    return holdout.manifest_check(found, expected, "doc_id").select("doc_id", "status")


@query("pack_by_size", f"""
WITH RECURSIVE ordered AS (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents),
packed AS (
  SELECT doc_id, source, r, 0::BIGINT AS pack_no, n_chars AS total FROM ordered WHERE r = 1
  UNION ALL
  SELECT o.doc_id, o.source, o.r, p.pack_no + (p.total + o.n_chars > {PACK_LIMIT})::INT,
    CASE WHEN p.total + o.n_chars > {PACK_LIMIT} THEN o.n_chars ELSE p.total + o.n_chars END
  FROM packed p JOIN ordered o ON o.source = p.source AND o.r = p.r + 1)
SELECT source, doc_id, pack_no FROM packed""")
def pack_by_size(spark, sf_dir):
    """Documents as files in id order, one worker per source."""
    return packing.pack_by_size(documents(spark, sf_dir).select("source", "doc_id", "n_chars"), PACK_LIMIT,
                                "source", "doc_id", "n_chars", rows_per_block=300_000)


@query("contiguous_groups", S.with_ctes(FILES_SQL, """
SELECT file_id, source, least(file_id // ((SELECT count(*) FROM files) + 6) // 7, 6) AS worker FROM files""".replace(
    "file_id // ((SELECT count(*) FROM files) + 6) // 7", "file_id // (((SELECT count(*) FROM files) + 6) // 7)")))
def contiguous_groups(spark, sf_dir):
    inventory = files(spark, sf_dir)
    return inventory.select("file_id", "source", packing.contiguous_group(F.col("file_id"), inventory.count(), 7).cast("long").alias("worker"))


@query("shard_files", S.with_ctes(FILES_SQL, "SELECT file_id, source FROM files WHERE file_id % 3 = 1"))
def shard_files(spark, sf_dir):
    return shard(files(spark, sf_dir), 3, 1).select("file_id", "source")


@query("trim_newline", r"""
SELECT doc_id, md5(regexp_replace(text || repeat(chr(10), (doc_id % 4)::INT), '\n\n$', chr(10))) AS text_md5 FROM documents""")
def trim_newline(spark, sf_dir):
    ended = F.concat("text", F.repeat(F.lit("\n"), (F.col("doc_id") % 4).cast("int")))
    return documents(spark, sf_dir).select("doc_id", F.md5(packing.trim_one_newline(ended)).alias("text_md5"))


@query("pick_even", f"""
WITH indexed AS (SELECT doc_id, row_number() OVER (ORDER BY {S.h(SEED, 'doc_id')}, doc_id) - 1 AS idx FROM documents),
n AS (SELECT count(*) AS n FROM documents)
SELECT pick_no, doc_id FROM (SELECT unnest(range(77)) AS pick_no),
n JOIN indexed ON idx = floor(pick_no * (n / 77::DOUBLE))::BIGINT""")
def pick_even(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id")
    return packing.pick_even(dense_index(docs, ["doc_id"], SEED), docs.count(), 77).select("pick_no", "doc_id")


@query("stage_counts", S.with_ctes(SAMPLE_SQL, """
SELECT 'articles' AS stage, count(*) AS n FROM articles UNION ALL SELECT 'files', count(*) FROM files
UNION ALL SELECT 'picked', count(*) FROM sample"""))
def stage_counts(spark, sf_dir):
    def counted(stage, df):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(stage).alias("stage"), "n")

    return (counted("articles", documents(spark, sf_dir)).union(counted("files", files(spark, sf_dir)))
            .union(counted("picked", sample(spark, sf_dir))))
