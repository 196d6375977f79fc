"""Held-out set: quotas, sampling, separation, membership and manifest checks."""

from __future__ import annotations

import random
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textforge.functions.draws import order_key
from textforge.functions.sentences import rstrip
from textforge.storage import materialize


def stratified_quota(files: DataFrame, n_test: int, n_files: int) -> DataFrame:
    """Quota of each file by its dense file_id; the quotas sum to n_test."""
    def share(i):
        return F.floor(i * F.lit(float(n_test)) / F.lit(n_files))

    return files.withColumn("quota", (share(F.col("file_id") + 1) - share(F.col("file_id"))).cast("long"))


BROADCAST_IDS = 1_000_000
LEVEL_DIGITS = 3  # hex digits of the hash that one histogram tells apart
OPEN_ROWS = 10_000  # rows of a file that may be ranked


def sample_cuts(rows: DataFrame, quotas: DataFrame, key: str = "article_no", open_rows: int = OPEN_ROWS, digits: int = LEVEL_DIGITS) -> DataFrame:
    """(file_id, last): the largest hash ``_h`` of each file's sample of ``quota`` rows with the smallest hashes.

    A histogram of hash prefixes per file, combined in every task, gives the prefix in which the quota is reached; only the
    rows under that prefix go on to the next, longer one, until few are left to be ranked.  A histogram has at most
    16**digits rows per file, whatever the file's size.  Files with quota 0 have no row.
    """
    need = quotas.where("quota > 0").select("file_id", F.col("quota").cast("long").alias("_rest"))
    open_part, done = rows.select("file_id", "_h"), []
    for width in range(digits, 33, digits):
        prefix = F.substring("_h", 1, width)
        counts = open_part.groupBy("file_id", prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"), F.max("_h").alias("_top"))
        upto = Window.partitionBy("file_id").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = counts.withColumn("_upto", F.sum("_n").over(upto)).join(need, "file_id")
        reached = F.col("_upto") >= F.col("_rest")
        # The first prefix at which the quota is reached, or the last one of a file that is smaller than its quota.
        state = materialize(running.groupBy("file_id").agg(
            F.min_by(F.struct("_prefix", "_n", "_top", "_upto", "_rest"), F.when(reached, F.col("_prefix"))).alias("_hit"), F.max("_top").alias("_all")))
        settled = F.col("_hit").isNull() | (F.col("_hit._upto") == F.col("_hit._rest"))
        done.append(state.where(settled).select("file_id", F.coalesce("_hit._top", "_all").alias("last")))
        left = state.where(~settled).select("file_id", F.col("_hit._prefix").alias("_cut"), F.col("_hit._n").alias("_n"),
                                            (F.col("_hit._rest") - F.col("_hit._upto") + F.col("_hit._n")).alias("_rest"))
        largest = left.agg(F.max("_n")).first()[0]
        if largest is None:
            break
        need = left.select("file_id", "_rest")
        # One row per file.
        open_part = materialize(open_part.join(left.select("file_id", "_cut"), "file_id").where(prefix == F.col("_cut")).select("file_id", "_h"))
        if largest <= open_rows:
            order = Window.partitionBy("file_id").orderBy("_h")
            ranked = open_part.withColumn("_rank", F.row_number().over(order)).join(need, "file_id")
            done.append(ranked.where("_rank = _rest").select("file_id", F.col("_h").alias("last")))
            break
    return reduce(DataFrame.unionByName, done)


def sample_per_file(articles: DataFrame, quotas: DataFrame, n_test: int, n_files: int, seed: int, key: str = "article_no",
                    open_rows: int = OPEN_ROWS, digits: int = LEVEL_DIGITS) -> DataFrame:
    """(file_id, key) of exactly ``quota`` articles per file, in a seeded random order; a file smaller than its quota goes whole.

    Each file's cut is found by sample_cuts; the sample is then a filter, so no file's articles are ever sorted or gathered.
    Keys are unique inside a file.
    """
    rows = articles.select("file_id", key, order_key(seed, "file_id", key).alias("_h"))
    cuts = materialize(sample_cuts(rows, quotas, key, open_rows, digits))
    if n_files <= BROADCAST_IDS:
        cuts = F.broadcast(cuts)
    return rows.join(cuts, "file_id").where(F.col("_h") <= F.col("last")).select("file_id", key)


def sample_sequential(articles: DataFrame, quotas: DataFrame, seed: int, key: str = "article_no") -> DataFrame:
    """(file_id, key) as a sequential sampler draws them: a generator of its own per file, seeded with
    ``seed + 13 * file_id``, gives article numbers until ``quota`` different ones are there.

    Article numbers are dense from 0.  One row per file goes through Python.
    """
    sizes = articles.groupBy("file_id").agg(F.count(F.lit(1)).alias("n"))

    def draw(batches):
        for frame in batches:
            out = []
            for file_id, n, quota in zip(frame["file_id"], frame["n"], frame["quota"]):
                generator, chosen = random.Random(seed + 13 * int(file_id)), set()
                while len(chosen) < min(quota, n):
                    chosen.add(int(generator.random() * n))
                out += [(file_id, number) for number in chosen]
            yield pd.DataFrame(out, columns=["file_id", key])

    return sizes.join(quotas.select("file_id", "quota"), "file_id").mapInPandas(draw, f"file_id long, {key} long")


def _small(ids: DataFrame, n_test: int | None) -> DataFrame:
    """Broadcast the ids if n_test, which bounds their number, is small: the articles stay
    where they are.  Otherwise Spark shuffles both sides."""
    return F.broadcast(ids) if n_test is not None and n_test <= BROADCAST_IDS else ids


def held_out(articles: DataFrame, ids: DataFrame, n_test: int | None = None, key: str = "article_no") -> DataFrame:
    return articles.join(_small(ids, n_test), ["file_id", key], "left_semi")


def kept_for_training(articles: DataFrame, ids: DataFrame, n_test: int | None = None, key: str = "article_no") -> DataFrame:
    return articles.join(_small(ids, n_test), ["file_id", key], "left_anti")


def with_split(articles: DataFrame, ids: DataFrame, n_test: int | None = None, key: str = "article_no") -> DataFrame:
    """Single pass form: a ``split`` column, 'eval' or 'train'."""
    flagged = _small(ids.select("file_id", key, F.lit("eval").alias("_split")), n_test)
    return (articles.join(flagged, ["file_id", key], "left")
            .withColumn("split", F.coalesce("_split", F.lit("train"))).drop("_split"))


def article_hash(text):
    return F.md5(rstrip(text))


def held_out_overlap(corpus: DataFrame, hashes: DataFrame, anti: bool = False) -> DataFrame:
    """Rows whose right-trimmed text is (not) in a published hash list; empty texts never match.

    The list is made distinct and the empty-text hash removed first, so each corpus row meets
    at most one hash.  The list is left to Spark's size-checked broadcast: a short one is
    broadcast and the corpus is not shuffled, and AQE splits a hot hash of a long one.
    """
    known = hashes.where(F.col("md5") != F.md5(F.lit(""))).distinct()
    tagged = corpus.withColumn("md5", article_hash(F.col("text")))
    return tagged.join(known, "md5", "left_anti" if anti else "left_semi")


def manifest_check(found: DataFrame, expected: DataFrame, key: str = "path") -> DataFrame:
    """Full outer comparison on size and md5: ok, changed, missing or unexpected."""
    a = found.select(key, F.col("size").alias("size"), F.col("md5").alias("md5"))
    b = expected.select(key, F.col("size").alias("want_size"), F.col("md5").alias("want_md5"))
    same = (F.col("size") == F.col("want_size")) & (F.col("md5") == F.col("want_md5"))
    return a.join(b, key, "full").withColumn(
        "status",
        F.when(F.col("want_md5").isNull(), "unexpected").when(F.col("md5").isNull(), "missing")
        .when(same, "ok").otherwise("changed"))
