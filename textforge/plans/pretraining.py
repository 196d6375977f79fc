"""Example generation: article text to shuffled TFRecord files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.functions.normalize import basic_tokens
from textforge.operators import examples as X
from textforge.operators.packing import pick_even
from textforge.operators.vocab import encode_sentences, vocab_list
from textforge.sources.tfrecord import write_tfrecord
from textforge.storage import materialize


def tokenize_documents(documents: DataFrame, vocab: list[str], lower: bool = True, key: str = "doc_id") -> DataFrame:
    """(doc_id, sentences array<string>) to a stored (doc_id, ids, ends); documents without tokens are dropped."""
    words = documents.select(F.col(key).alias("doc_id"),
                             F.transform("sentences", lambda x: basic_tokens(x, lower)).alias("words"))
    full = words.select("doc_id", F.filter("words", lambda w: F.size(w) > 0).alias("words"))
    return materialize(encode_sentences(full, "words", vocab).where(F.size("ends") > 0))


def generate_examples(documents: DataFrame, vocab: DataFrame, s: X.PairSettings, lower: bool = True) -> DataFrame:
    """Shuffled examples with a dense idx; the special token ids come from the vocabulary."""
    tokens = vocab_list(vocab)
    at = {t: tokens.index(t) for t in ("[CLS]", "[SEP]", "[MASK]")}
    sized = X.PairSettings(**{**s.__dict__, "cls": at["[CLS]"], "sep": at["[SEP]"], "mask": at["[MASK]"], "vocab_size": len(tokens)})
    docs = tokenize_documents(documents, tokens, lower)
    return X.shuffled_examples(docs, sized)


def write_examples(examples: DataFrame, path: str, n_files: int) -> None:
    write_tfrecord(examples, path, n_files)


def pick_evaluation_set(examples: DataFrame, k: int) -> DataFrame:
    """k evenly spaced examples of the shuffled order, indexed 0..k-1."""
    stored = materialize(examples)  # counted and read
    return pick_even(stored, stored.count(), k).drop("idx").withColumnRenamed("pick_no", "idx")
