"""Inputs of the registered queries, derived from the given tables by Spark."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textforge.operators.examples import PairSettings
from textforge.operators.tokenizing import encode_texts, word_counts
from textforge.operators.vocab import vocab_from_lines, vocab_list
from textforge.storage import materialize, spread

SEED = 12345
SPECIALS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents")


def texts(spark, sf_dir, *columns) -> DataFrame:
    """doc_id, text and further columns, over all cores even if the file has one row group."""
    return spread(documents(spark, sf_dir).select("doc_id", "text", *columns), "doc_id")


def text_lines(spark, sf_dir) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def vocab_lines(spark, sf_dir, counts: DataFrame | None = None) -> DataFrame:
    """A vocabulary file's lines: specials, characters, then the 2,000 most frequent words.

    Bounded by construction: 2,000 words and two entries per distinct character.
    """
    if counts is None:
        counts = materialize(word_counts(texts(spark, sf_dir), "text"))
    chars = counts.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct()
    ranked = chars.agg(F.sort_array(F.collect_set("c")).alias("cs")).select(F.posexplode("cs").alias("r", "c"))
    top = (counts.orderBy(F.desc("count"), "word").limit(2000)
           .agg(F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("n"), "word"))).alias("ws"))
           .select(F.posexplode("ws").alias("r", "w")))
    special = spark.createDataFrame(list(enumerate(SPECIALS)), "line_no long, line string")
    return (special
            .union(ranked.select((5 + 2 * F.col("r")).cast("long"), "c"))
            .union(ranked.select((6 + 2 * F.col("r")).cast("long"), F.concat(F.lit("##"), "c")))
            .union(top.select((10_000_001 + F.col("r")).cast("long"), "w.word")))


_VOCABS: dict[tuple[str, str], list[str]] = {}


def vocab(spark, sf_dir, counts: DataFrame | None = None) -> list[str]:
    """The vocabulary of a table folder; read once per application, like a vocabulary file.

    ``counts`` may hold the folder's word counts, if the caller has them.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _VOCABS:
        if len(_VOCABS) >= 8:
            _VOCABS.clear()
        _VOCABS[key] = vocab_list(vocab_from_lines(vocab_lines(spark, sf_dir, counts)))
    return list(_VOCABS[key])


def vocab_table(spark, sf_dir) -> DataFrame:
    return spark.createDataFrame([(t, i) for i, t in enumerate(vocab(spark, sf_dir))], "token string, token_id int")


def tokenized(spark, sf_dir, stored: bool = False) -> DataFrame:
    """(doc_id, ids, ends) of the documents that have tokens."""
    docs = encode_texts(texts(spark, sf_dir), "text", vocab(spark, sf_dir)).where(F.size("ends") > 0)
    return materialize(docs) if stored else docs


def settings(spark, sf_dir) -> PairSettings:
    return PairSettings(max_seq=64, max_pred=10, dupe=2, seed=SEED, vocab_size=len(vocab(spark, sf_dir)))


def number(column, name: str):
    return column.cast("long").alias(name)


@lru_cache(maxsize=2)
def _summed(weighted: bool):
    @F.arrow_udf("long")
    def run(arrays: pa.Array) -> pa.Array:
        sizes = arrays.value_lengths().fill_null(0).to_numpy().astype(np.int64)
        ends = np.cumsum(sizes)
        values = arrays.flatten().to_numpy().astype(np.int64)
        if weighted:
            values *= np.arange(1, len(values) + 1) - np.repeat(ends - sizes, sizes)
        total = np.concatenate([[0], np.cumsum(values)])
        return pa.array(total[ends] - total[ends - sizes], mask=~np.asarray(arrays.is_valid()))

    return run


def token_sum(ids, weighted: bool = False):
    """Sum of an id array without null ids, each id times its place from 1 if ``weighted``; many rows at a time, no lambda call per id."""
    return _summed(weighted)(ids)


def int_sum(array):
    return F.aggregate(array, F.lit(0).cast("long"), lambda acc, x: acc + x)
