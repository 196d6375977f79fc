"""Example construction, from shuffled documents to padded features."""

from __future__ import annotations

from pyspark.sql import functions as F

from textforge.catalog import sql as S
from textforge.catalog.inputs import SEED, documents, int_sum, settings, token_sum, tokenized
from textforge.catalog.q_io import PAIRS_SQL, text_pairs
from textforge.catalog.registry import query
from textforge.functions import pairs
from textforge.functions.draws import key_text
from textforge.functions.normalize import basic_tokens
from textforge.operators import examples as X
from textforge.operators.features import assemble_features
from textforge.operators.ordering import dense_index
from textforge.storage import materialize


def planned(spark, sf_dir):
    s = settings(spark, sf_dir)
    docs = tokenized(spark, sf_dir, stored=True)
    return docs, s, materialize(X.document_index(docs, s.seed)), docs.count()


@query("shuffle_index", f"""
SELECT doc_id, row_number() OVER (ORDER BY {S.h(SEED, 'doc_id')}, doc_id) - 1 AS idx FROM documents""")
def shuffle_index(spark, sf_dir):
    return dense_index(documents(spark, sf_dir).select("doc_id"), ["doc_id"], SEED).select("doc_id", "idx")


@query("duplicate_docs", "SELECT doc_id, unnest(range(3))::INT AS dupe FROM documents")
def duplicate_docs(spark, sf_dir):
    return X.duplicate(documents(spark, sf_dir).select("doc_id"), 3)


@query("target_lengths", f"""
SELECT doc_id, dupe, {S.target()} AS target FROM (SELECT doc_id, unnest(range({S.DUPE}))::INT AS dupe FROM documents)""")
def target_lengths(spark, sf_dir):
    return X.duplicate(documents(spark, sf_dir).select("doc_id"), S.DUPE).withColumn(
        "target", X.target_len(S.MAX_TOKENS, 0.1, SEED, "doc_id", "dupe"))


@query("plan_chunks", S.with_ctes(S.PLAN, """
SELECT doc_id, dupe, chunk_no, first::INT AS first, last::INT AS last, a_end::INT AS a_end, is_random FROM chunks"""))
def plan_chunks(spark, sf_dir):
    s = settings(spark, sf_dir)
    return X.planned_chunks(tokenized(spark, sf_dir, stored=True), s).select("doc_id", "dupe", "chunk_no", "first", "last", "a_end", "is_random")


def pair_digest(df, *more):
    return df.select("doc_id", "dupe", "chunk_no", *more, F.size("a").cast("long").alias("a_len"), F.size("b").cast("long").alias("b_len"),
                     int_sum("a").alias("a_sum"), int_sum("b").alias("b_sum"))


PAIR_DIGEST_SQL = "len(a)::BIGINT AS a_len, len(b)::BIGINT AS b_len, list_sum(a)::BIGINT AS a_sum, list_sum(b)::BIGINT AS b_sum"


@query("random_next", S.with_ctes(S.PAIRS, f"""
SELECT doc_id, dupe, chunk_no, partner_id, {PAIR_DIGEST_SQL} FROM pairs WHERE is_random"""))
def random_next(spark, sf_dir):
    return pair_digest(X.sentence_pairs(*planned(spark, sf_dir)).where("is_random"), "partner_id")


@query("truncate_pair", S.with_ctes(S.CUT, """
SELECT doc_id, dupe, chunk_no, fa::BIGINT AS front_a, ka::BIGINT AS keep_a, fb::BIGINT AS front_b, kb::BIGINT AS keep_b FROM cut"""))
def truncate_pair(spark, sf_dir):
    docs, s, index, n = planned(spark, sf_dir)
    key = key_text(F.lit(s.seed), "doc_id", "dupe", "chunk_no", F.lit("cut"))
    cut = X.sentence_pairs(docs, s, index, n).select(
        "doc_id", "dupe", "chunk_no", pairs.truncate_ranges(F.size("a"), F.size("b"), s.max_tokens, key).alias("t"))
    return cut.select("doc_id", "dupe", "chunk_no", *[F.col(f"t.{c}").cast("long").alias(c) for c in ("front_a", "keep_a", "front_b", "keep_b")])


@query("truncate_pair_tail", """
SELECT doc_id, la - (CASE WHEN la > lb THEN f ELSE 0 END) - (e - f) // 2 AS keep_a,
       lb - (CASE WHEN lb >= la THEN f ELSE 0 END) - ((e - f) - (e - f) // 2) AS keep_b FROM (
  SELECT *, least(e, abs(la - lb)) AS f FROM (SELECT *, greatest(0, la + lb - 120) AS e FROM (
    SELECT doc_id, len(string_split(text, ' ')) AS la, doc_id % 97 AS lb FROM documents)))""")
def truncate_pair_tail(spark, sf_dir):
    sizes = documents(spark, sf_dir).select("doc_id", F.size(F.split("text", " ")).alias("la"), (F.col("doc_id") % 97).cast("int").alias("lb"))
    cut = sizes.select("doc_id", pairs.truncate_ranges(F.col("la"), F.col("lb"), 120).alias("t"))
    return cut.select("doc_id", F.col("t.keep_a").cast("long").alias("keep_a"), F.col("t.keep_b").cast("long").alias("keep_b"))


FEATURE_SQL = f"""{PAIRS_SQL},
text_tokens AS (SELECT unique_id, {S.basic('text_a')} AS a, CASE WHEN text_b IS NOT NULL THEN {S.basic('text_b')} END AS b FROM text_pairs)"""


def pair_tokens(spark, sf_dir):
    return text_pairs(spark, sf_dir).select(
        "unique_id", basic_tokens(F.col("text_a")).alias("a"),
        F.when(F.col("text_b").isNotNull(), basic_tokens(F.col("text_b"))).alias("b"))


@query("assemble_pair", S.with_ctes(FEATURE_SQL, """
SELECT unique_id, md5(array_to_string(CASE WHEN b IS NULL OR len(b) = 0 THEN ['[CLS]'] || a || ['[SEP]']
  ELSE ['[CLS]'] || a || ['[SEP]'] || b || ['[SEP]'] END, ' ')) AS tokens_md5,
  CASE WHEN b IS NULL OR len(b) = 0 THEN 0 ELSE len(b) + 1 END::BIGINT AS segment_sum FROM text_tokens"""))
def assemble_pair(spark, sf_dir):
    return pair_tokens(spark, sf_dir).select(
        "unique_id", F.md5(F.array_join(pairs.assemble(F.col("a"), F.col("b"), "[CLS]", "[SEP]"), " ")).alias("tokens_md5"),
        int_sum(pairs.segment_ids(F.col("a"), F.col("b"))).alias("segment_sum"))


@query("assemble_features", S.with_ctes(FEATURE_SQL, """
SELECT unique_id, md5(array_to_string(t, ' ')) AS tokens_md5, len(t)::BIGINT AS n_tokens, segment_sum FROM (
  SELECT unique_id, CASE WHEN single THEN ['[CLS]'] || a[1:30] || ['[SEP]']
      ELSE ['[CLS]'] || a[1:ka] || ['[SEP]'] || b[1:kb] || ['[SEP]'] END AS t,
    CASE WHEN single THEN 0 ELSE kb + 1 END::BIGINT AS segment_sum FROM (
    SELECT *, la - (CASE WHEN la > lb THEN f ELSE 0 END) - (e - f) // 2 AS ka,
           lb - (CASE WHEN lb >= la THEN f ELSE 0 END) - ((e - f) - (e - f) // 2) AS kb FROM (
      SELECT *, least(e, abs(la - lb)) AS f FROM (
        SELECT *, b IS NULL OR len(b) = 0 AS single, greatest(0, len(a) + coalesce(len(b), 0) - 29) AS e,
               len(a) AS la, coalesce(len(b), 0) AS lb FROM text_tokens))))"""))
def assemble_features_rows(spark, sf_dir):
    return assemble_features(pair_tokens(spark, sf_dir), 32, "[CLS]", "[SEP]").select(
        "unique_id", F.md5(F.array_join("tokens", " ")).alias("tokens_md5"), F.size("tokens").cast("long").alias("n_tokens"),
        int_sum("segment_ids").alias("segment_sum"))


MASK_SQL = S.with_ctes(S.INSTANCES, """
SELECT doc_id, dupe, chunk_no, len(positions)::BIGINT AS n_masked, array_to_string(positions, ' ') AS positions,
  array_to_string(labels, ' ') AS labels, list_sum(original)::BIGINT + delta AS id_sum,
  list_sum(list_transform(original, lambda x, i: x * i))::BIGINT + weighted_delta AS weighted_sum
FROM whole JOIN masks USING (doc_id, dupe, chunk_no)""")


def mask_digest(rows):
    return rows.select(
        "doc_id", "dupe", "chunk_no", F.size("positions").cast("long").alias("n_masked"),
        F.array_join(F.col("positions").cast("array<string>"), " ").alias("positions"),
        F.array_join(F.col("labels").cast("array<string>"), " ").alias("labels"), token_sum("token_ids").alias("id_sum"),
        token_sum("token_ids", weighted=True).alias("weighted_sum"))


@query("mask_tokens", MASK_SQL)
def mask_tokens(spark, sf_dir):
    """Masking as the job runs it, on whole Arrow batches."""
    docs, s, index, n = planned(spark, sf_dir)
    return mask_digest(X.instances(X.sentence_pairs(docs, s, index, n), s))


@query("mask_tokens_columns", MASK_SQL)
def mask_tokens_columns(spark, sf_dir):
    """The column form of masking, which also takes string tokens."""
    docs, s, index, n = planned(spark, sf_dir)
    whole = X.assembled(X.sentence_pairs(docs, s, index, n), s)
    key = key_text(F.lit(s.seed), "doc_id", "dupe", "chunk_no", F.lit("mask"))
    original, positions = F.col("original"), F.col("positions")
    rows = whole.withColumn("positions", pairs.mask_positions(original, s.cls, s.sep, key, s.mask_prob, s.max_pred)).select(
        "doc_id", "dupe", "chunk_no", "positions", pairs.labels_at(original, positions).alias("labels"),
        pairs.apply_masks(original, positions, key, s.mask, s.vocab_size, lambda w: w).alias("token_ids"))
    return mask_digest(rows)


@query("encode_pad", f"""
SELECT doc_id, 24 AS width, sum(v)::BIGINT AS id_sum, count(*) FILTER (v > 0) AS mask_sum, sum(v * i)::BIGINT AS weighted_sum,
  2::BIGINT AS weight_sum, (doc_id % 2)::INT AS label
FROM (SELECT doc_id, unnest(range(1, 25)) AS i, unnest([ascii(substr(text, 1, 1)), length(lang), 7, (doc_id % 5 + 1)::INT] || list_transform(range(20), lambda x: 0)) AS v
      FROM documents) GROUP BY doc_id""")
def encode_pad(spark, sf_dir):
    rows = documents(spark, sf_dir).select(
        "doc_id", F.array(F.ascii("text"), F.length("lang"), F.lit(7), (F.col("doc_id") % 5 + 1).cast("int")).alias("token_ids"),
        F.array(F.lit(0), F.lit(0), F.lit(1), F.lit(1)).alias("segment_ids"), F.array(F.lit(1), F.lit(2)).alias("positions"),
        F.array(F.lit(9), F.lit(8)).alias("labels"), (F.col("doc_id") % 2 == 1).alias("is_random"))
    e = X.encode_and_pad(rows, 24, 6)
    return e.select(
        "doc_id", F.size("input_ids").alias("width"), int_sum("input_ids").alias("id_sum"), int_sum("input_mask").alias("mask_sum"),
        int_sum(F.transform("input_ids", lambda x, i: (x * (i + 1)).cast("long"))).alias("weighted_sum"),
        int_sum(F.col("masked_lm_weights").cast("array<long>")).alias("weight_sum"), F.get("next_sentence_labels", F.lit(0)).alias("label"))


@query("pretrain_examples", S.with_ctes(S.INSTANCES, f"""
SELECT doc_id, dupe, chunk_no, row_number() OVER (ORDER BY {S.h(SEED, 'doc_id', 'dupe', 'chunk_no')}, doc_id, dupe, chunk_no) - 1 AS idx,
  len(original)::BIGINT AS n_tokens, is_random::INT AS next_label, list_sum(original)::BIGINT + delta AS id_sum,
  list_sum(list_transform(original, lambda x, i: x * i))::BIGINT + weighted_delta AS weighted_sum,
  (kb + 1)::BIGINT AS segment_sum, list_sum(positions)::BIGINT AS position_sum, list_sum(labels)::BIGINT AS label_sum,
  len(positions)::DOUBLE AS weight_sum
FROM whole JOIN masks USING (doc_id, dupe, chunk_no)"""))
def pretrain_examples(spark, sf_dir):
    """The flagship: shuffled, masked, padded sentence-pair examples, one digest row each."""
    s = settings(spark, sf_dir)
    docs = tokenized(spark, sf_dir, stored=True)
    return X.shuffled_examples(docs, s, lambda e: e.select(
        "doc_id", "dupe", "chunk_no", token_sum("input_mask").alias("n_tokens"), F.get("next_sentence_labels", F.lit(0)).alias("next_label"),
        token_sum("input_ids").alias("id_sum"), token_sum("input_ids", weighted=True).alias("weighted_sum"),
        token_sum("segment_ids").alias("segment_sum"), token_sum("masked_lm_positions").alias("position_sum"),
        token_sum("masked_lm_ids").alias("label_sum"),
        F.aggregate("masked_lm_weights", F.lit(0.0), lambda a, x: a + x).alias("weight_sum")))


@query("example_stats", S.with_ctes(S.INSTANCES, f"""
SELECT dupe, instances, padding_share, random_share, masked_share, distinct_tokens FROM (
  SELECT dupe, count(*) AS instances, round(1 - sum(len(original)) / (count(*) * {S.MAX_SEQ}::DOUBLE), 6) AS padding_share,
    round(avg(is_random::INT), 6) AS random_share, round(sum(len(positions)) / sum(len(original))::DOUBLE, 6) AS masked_share
  FROM whole JOIN masks USING (doc_id, dupe, chunk_no) GROUP BY dupe)
JOIN (SELECT dupe, count(DISTINCT id) AS distinct_tokens FROM (
  SELECT t.dupe, CASE WHEN m.act IS NULL OR (m.act >= 0.8 AND m.act < 0.9) THEN t.tok WHEN m.act < 0.8 THEN 4 ELSE m.word END AS id
  FROM (SELECT doc_id, dupe, chunk_no, unnest(range(len(original))) AS pos, unnest(original) AS tok FROM whole) t
  LEFT JOIN masked m ON m.doc_id = t.doc_id AND m.dupe = t.dupe AND m.chunk_no = t.chunk_no AND m.pos = t.pos) GROUP BY dupe) USING (dupe)"""))
def example_stats(spark, sf_dir):
    e = X.create_examples(tokenized(spark, sf_dir, stored=True), settings(spark, sf_dir))
    return X.example_stats(e, ["dupe"]).select(
        "dupe", "instances", *[F.round(c, 6).alias(c) for c in ("padding_share", "random_share", "masked_share")], "distinct_tokens")
