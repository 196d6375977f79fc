"""Feature export: text pairs and activations to JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.functions.normalize import basic_tokens
from textforge.functions.pairs import pad
from textforge.operators.features import assemble_features, feature_records
from textforge.operators.vocab import encode_sentences, ids_to_tokens
from textforge.sources.sinks import write_features_json


def pair_features(pairs: DataFrame, vocab: list[str], seq_length: int, lower: bool = True) -> DataFrame:
    """(unique_id, text_a, text_b) to token ids, segment ids and mask padded to seq_length."""
    words = pairs.select("unique_id", F.array(
        basic_tokens(F.col("text_a"), lower),
        F.coalesce(basic_tokens(F.col("text_b"), lower), F.array().cast("array<string>"))).alias("words"))
    coded = encode_sentences(words, "words", vocab)
    first = F.get("ends", F.lit(0))
    halves = coded.select("unique_id", F.slice("ids", F.lit(1), first).alias("a"),
                          F.slice("ids", first + 1, F.get("ends", F.lit(1)) - first).alias("b"))
    rows = assemble_features(halves, seq_length, vocab.index("[CLS]"), vocab.index("[SEP]"))
    return rows.select(
        "unique_id", F.col("tokens").alias("token_ids"), pad(F.col("tokens"), seq_length, 0).alias("input_ids"),
        pad(F.array_repeat(F.lit(1), F.size("tokens")), seq_length, 0).alias("input_mask"),
        pad(F.col("segment_ids"), seq_length, 0).alias("input_type_ids"))


def export_features(features: DataFrame, activations: DataFrame, vocab: DataFrame, layers: list[int], path: str) -> None:
    """Write one JSON record per pair; ``activations``: (unique_id, pos, layers).

    A null id or one outside the vocabulary is an error: leaving it out would move later tokens to other activations.
    """
    spread = features.select("unique_id", F.posexplode_outer("token_ids").alias("pos", "token_id"))
    named = ids_to_tokens(spread, vocab).groupBy("unique_id").agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("_t"))
    tokens = named.select("unique_id", F.transform("_t", lambda x: x.token).alias("tokens"))
    write_features_json(feature_records(tokens, activations, layers), path)
