"""Readers of text collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textforge.functions.sentences import strip
from textforge.operators.ordering import sorted_index
from textforge.operators.vocab import vocab_from_lines

# Fixed value: the separator of two texts on a line.
PAIR_PATTERN = r"^(.*) \|\|\| (.*)$"
NEWLINE_PATTERN = r"\r\n|\r|\n"
BROADCAST_BLOCKS = 100_000


def as_paths(patterns: str | list[str]) -> list[str]:
    return patterns.split(",") if isinstance(patterns, str) else list(patterns)


def list_files(spark: SparkSession, patterns: str | list[str]) -> DataFrame:
    """(file_id, path, size, uri): sorted by path, ids dense; ``uri`` is the name that readers report.

    File contents are not read.
    """
    found = spark.read.format("binaryFile").load(as_paths(patterns)).select(
        "path", F.col("length").alias("size"), F.col("_metadata.file_path").alias("uri"))
    return sorted_index(found, ["path"], "file_id").select("file_id", "path", "size", "uri")


def file_digests(spark: SparkSession, patterns: str | list[str]) -> DataFrame:
    """(path, size, md5) of whole files, for manifest checks of files below 2 GB."""
    return spark.read.format("binaryFile").load(as_paths(patterns)).select(
        "path", F.col("length").alias("size"), F.md5("content").alias("md5"))


def _numbered(raw: DataFrame, number: str, text: str) -> DataFrame:
    """Number the records of each file in order while the scan stays split by blocks.

    Records are counted per file block; the running count of the earlier blocks, one row per
    block, is added to the record's position inside its block.
    """
    rows = raw.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"), F.col("value").alias(text))
    blocks = rows.groupBy("path", "_start").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("path", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row per file block: never more than scan tasks plus files.
    n_blocks = raw.rdd.getNumPartitions() + len(raw.inputFiles())
    if n_blocks <= BROADCAST_BLOCKS:
        starts = F.broadcast(starts)
    return rows.join(starts, ["path", "_start"]).select(
        "path", (F.col("_at") - F.col("_first") + F.col("_before")).alias(number), text)


def read_lines(spark: SparkSession, patterns: str | list[str]) -> DataFrame:
    """(path, line_no, line); any newline convention, files of any size."""
    return _numbered(spark.read.text(as_paths(patterns)), "line_no", "line")


def read_texts(spark: SparkSession, patterns: str | list[str], up_to: int | None = None) -> DataFrame:
    """(path, text): one row per file, of files up to a size."""
    raw = spark.read.text(as_paths(patterns), wholetext=True)
    if up_to is not None:
        raw = raw.where(F.col("_metadata.file_size") <= up_to)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def split_lines(text: Column) -> Column:
    """Lines of a text; the piece after a final newline is not a line."""
    pieces = F.split(text, NEWLINE_PATTERN)
    return F.when(F.element_at(pieces, -1) == "", F.slice(pieces, F.lit(1), F.size(pieces) - 1)).otherwise(pieces)


def split_articles(text: Column) -> Column:
    """Pieces between blank lines, empty pieces included."""
    return F.split(text, "\n\n")


def read_articles(spark: SparkSession, patterns: str | list[str], whole_files: bool = True) -> DataFrame:
    """(path, article_no, text).  whole_files=False reads large files in parts, with the same result.  Files without any byte have no row."""
    if whole_files:
        return read_texts(spark, patterns).select("path", F.posexplode(split_articles(F.col("text"))).alias("article_no", "text"))
    from textforge.sources.extracts import file_articles

    return file_articles(spark, patterns)


def document_sentences(text: Column) -> Column:
    """Stripped, non-empty lines of one article."""
    return F.filter(F.transform(F.split(text, NEWLINE_PATTERN), strip), lambda x: x != "")


def documents_from(articles: DataFrame) -> DataFrame:
    """Articles as sentence arrays; a line that strips to nothing starts a new document."""
    keys = [c for c in articles.columns if c != "text"]
    # White space-only lines delimit documents too, so they are blanked before the split.
    blanked = F.regexp_replace("text", r"(?m)^[ \t\x0B\f\r]+$", "")
    parts = articles.select(*keys, F.posexplode(F.split(blanked, r"\n{2,}")).alias("part_no", "_part"))
    return parts.select(*keys, "part_no", document_sentences(F.col("_part")).alias("sentences")).where(F.size("sentences") > 0)


def read_documents(spark: SparkSession, patterns: str | list[str]) -> DataFrame:
    return documents_from(read_articles(spark, patterns))


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    return vocab_from_lines(read_lines(spark, path))


def split_pair(line: Column) -> Column:
    """struct(text_a, text_b) of a stripped line, split at the last ' ||| '."""
    clean = strip(line)
    is_pair = clean.rlike(PAIR_PATTERN)
    return F.struct(
        F.when(is_pair, F.regexp_extract(clean, PAIR_PATTERN, 1)).otherwise(clean).alias("text_a"),
        F.when(is_pair, F.regexp_extract(clean, PAIR_PATTERN, 2)).alias("text_b"))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(unique_id, text_a, text_b), unique_id is the line number."""
    return read_lines(spark, path).select(F.col("line_no").alias("unique_id"), split_pair(F.col("line")).alias("p")).select(
        "unique_id", "p.*")


def read_hash_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("md5"))
