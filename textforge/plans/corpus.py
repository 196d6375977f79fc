"""Corpus preparation: extract files to held-out and packed training text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textforge.functions import markup
from textforge.functions.draws import let
from textforge.functions.normalize import strip_bom
from textforge.functions.sentences import mark_boundaries, strip
from textforge.operators import holdout, packing
from textforge.sources import sinks
from textforge.sources.extracts import SEGMENT_BYTES, extract_articles
from textforge.sources.text import list_files, read_texts, split_articles
from textforge.storage import materialize

_HEADER = "\ufdd3"  # with a 1, a header's blank line while cleaning; where a text holds it, it is escaped

SMALL_INVENTORY = 200_000  # files
WHOLE_FILE_BYTES = 64 << 20


@dataclass(frozen=True)
class CorpusSettings:
    n_test: int = 10_000
    block_bytes: int = int(26.92 * 1024 * 1024)
    n_outputs: int = 500
    workers: int = 1
    seed: int = 12345
    fragment_on_blank: bool = True
    whole_file_bytes: int = WHOLE_FILE_BYTES
    segment_bytes: int = SEGMENT_BYTES
    sequential_sample: bool = False


def sentence_text(text):
    """One stripped sentence per line; blank lines stay, one more ends the file."""
    return F.concat(F.array_join(F.transform(F.split(mark_boundaries(text), "\n"), strip), "\n"), F.lit("\n"))


def clean_extract(text, fragment_on_blank: bool = True):
    """Raw extract text to sentence text.

    Lines emptied by the cleaning cut their article in two, as blank lines delimit articles;
    fragment_on_blank=False removes them and keeps the articles whole.
    """
    bare = markup.drop_marked_lines(markup.strip_headers(strip_bom(text)))
    # The last line ends like all others.
    closed = let(bare, lambda t: F.when((t != "") & ~t.endswith("\n"), F.concat(t, F.lit("\n"))).otherwise(t))
    if fragment_on_blank:
        return sentence_text(markup.clean_markup(closed))
    escaped = F.replace(closed, F.lit(_HEADER), F.lit(_HEADER + "0"))
    kept = markup.clean_markup(F.regexp_replace(escaped, r"(?md)^\n", _HEADER + "1\n"))
    dense = F.regexp_replace(kept, r"(?md)^[ \t\r]*\n", "")
    return sentence_text(F.replace(F.replace(dense, F.lit(_HEADER + "1"), F.lit("")), F.lit(_HEADER + "0"), F.lit(_HEADER)))


def _place(uri):
    return F.regexp_replace(uri, r"^file:/+", "/")


def corpus_articles(spark: SparkSession, patterns, s: CorpusSettings) -> DataFrame:
    """(file_id, article_no, text) of all extract files.

    Files without any byte are not in Spark's listing and take no part.  A file of up to ``whole_file_bytes`` is one row and its text is never shuffled; larger files are read in parts by
    extract_articles, with the same result.
    """
    files = list_files(spark, patterns)
    texts = read_texts(spark, patterns, s.whole_file_bytes).select(
        _place("path").alias("path"), clean_extract(F.col("text"), s.fragment_on_blank).alias("text"))
    found = texts.select("path", F.posexplode(split_articles(F.col("text"))).alias("article_no", "text")).withColumn("article_no", F.col("article_no").cast("long"))
    # The inventory is what Spark's listing already holds on the driver; a short one is broadcast,
    # so that the text stays where it was read.
    known = materialize(files.select("file_id", _place("uri").alias("path"), "size"))
    n_large = known.where(F.col("size") > s.whole_file_bytes).count()
    if n_large:
        found = found.unionByName(extract_articles(spark, patterns, s.fragment_on_blank, s.whole_file_bytes, s.segment_bytes).withColumn("path", _place("path")))
    if known.count() <= SMALL_INVENTORY:
        known = F.broadcast(known)
    return found.join(known, "path").select("file_id", "article_no", "text")


def closed_articles(train: DataFrame) -> DataFrame:
    """Articles as a pack holds them: each with a blank line after it, but for each file's last one, which lacks a line break."""
    last = train.groupBy("file_id").agg(F.max("article_no").alias("_last"))
    ends = F.when(F.col("article_no") == F.col("_last"), "\n").otherwise("\n\n")
    return train.join(last, "file_id").withColumn("text", F.concat("text", ends)).drop("_last")


def prepare_corpus(spark: SparkSession, patterns, out: str, s: CorpusSettings = CorpusSettings()) -> None:
    """Write out/train (packed), out/eval_text and out/eval_md5."""
    files = materialize(list_files(spark, patterns))
    n_files = files.count()
    articles = materialize(corpus_articles(spark, patterns, s))
    quotas = holdout.stratified_quota(files, s.n_test, n_files)
    ids = materialize(holdout.sample_sequential(articles, quotas, s.seed) if s.sequential_sample
                      else holdout.sample_per_file(articles, quotas, s.n_test, n_files, s.seed))
    sinks.write_eval_set(holdout.held_out(articles, ids, s.n_test), f"{out}/eval_text", f"{out}/eval_md5")
    worked = files.withColumn("worker", packing.contiguous_group(F.col("file_id"), n_files, s.workers))
    packs = packing.pack_by_size(worked, s.block_bytes, "worker", "file_id", "size").select(
        "file_id", packing.pack_name(F.col("pack_no"), F.col("worker"), s.n_outputs).alias("pack_name"))
    train = closed_articles(holdout.kept_for_training(articles, ids, s.n_test)).join(packs, "file_id")
    sinks.write_texts(train, f"{out}/train")
