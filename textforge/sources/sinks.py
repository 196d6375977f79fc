"""Writers of article text, hash lists, reports, feature records and run events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textforge.operators.holdout import article_hash


def article_text(sentences: Column) -> Column:
    """One sentence per line, a blank line after the article."""
    return F.concat(F.array_join(sentences, "\n"), F.lit("\n"))


def write_texts(texts: DataFrame, path: str, pack: str = "pack_name", order: tuple[str, ...] = ("file_id", "article_no"),
                text: str = "text", rows_per_file: int = 0) -> None:
    """One folder per pack, texts in order, byte for byte as they are.

    Rows are range-partitioned by pack and order, so a large pack may span several tasks:
    its files, read by name, keep the order.
    """
    # The writer ends each row with a separator of its own; the line break that ends each text stands for it.
    rows = (texts.repartitionByRange(pack, *order).sortWithinPartitions(pack, *order)
            .select(pack, F.when(F.col(text).endswith("\n"), F.regexp_replace(text, r"\n\z", ""))
                    .otherwise(F.raise_error(F.lit("a text without a line break at its end"))).alias("value")))
    writer = rows.write.partitionBy(pack)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.text(path)


def write_articles(articles: DataFrame, path: str, pack: str = "pack_name", order: tuple[str, ...] = ("file_id", "article_no"),
                   text: str = "text", rows_per_file: int = 0) -> None:
    """write_texts of articles that end with a line break, each followed by a blank line."""
    write_texts(articles.withColumn(text, F.concat(F.col(text), F.lit("\n"))), path, pack, order, text, rows_per_file)


def write_eval_set(articles: DataFrame, text_path: str, hash_path: str,
                   order: tuple[str, ...] = ("file_id", "article_no")) -> None:
    """Held-out text and one md5 per article, in the same order."""
    rows = articles.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.select(F.concat("text", F.lit("\n")).alias("value")).write.text(text_path)
    rows.select(article_hash(F.col("text")).alias("value")).write.text(hash_path)


def write_features_json(records: DataFrame, path: str) -> None:
    records.select(F.to_json(F.struct("linex_index", "features")).alias("value")).write.text(path)


def write_metrics(key_values: DataFrame, path: str) -> None:
    """Sorted 'key = value' lines; a report has a handful of keys, so one file."""
    (key_values.orderBy("key").select(F.concat_ws(" = ", "key", F.col("value").cast("string")).alias("value"))
     .coalesce(1).write.text(path))


def append_run_events(rows: DataFrame, path: str, run: str = "run_id") -> None:
    rows.write.mode("append").partitionBy(run).json(path)
