"""Per-token feature records and embedding lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.functions import pairs


def assemble_features(rows: DataFrame, seq_length: int, cls, sep) -> DataFrame:
    """tokens, segment_ids from token arrays ``a`` and ``b`` (null or empty: single form)."""
    single = F.col("b").isNull() | (F.size("b") == 0)
    cut = pairs.truncate_ranges(F.size("a"), F.size("b"), seq_length - 3)
    parts = rows.withColumn("_t", F.when(~single, cut)).select(
        *[c for c in rows.columns if c not in ("a", "b")],
        F.when(single, F.slice("a", 1, seq_length - 2)).otherwise(F.slice("a", F.lit(1), F.col("_t.keep_a"))).alias("a"),
        F.when(~single, F.slice("b", F.lit(1), F.col("_t.keep_b"))).alias("b"))
    return parts.select(*[c for c in parts.columns if c not in ("a", "b")],
                        pairs.assemble(F.col("a"), F.col("b"), cls, sep).alias("tokens"),
                        pairs.segment_ids(F.col("a"), F.col("b")).alias("segment_ids"))


def embedding_lookup(rows: DataFrame, table: DataFrame, key: str, ids: str = "ids") -> DataFrame:
    """Vectors of an id list in order; one row per input row, empty lists included.

    An id that the table lacks is an error.

    ``table``: (id, vector).  Rows are spread by position, so a long list or a frequent id
    does not gather in one task until the final list is rebuilt per input row.
    """
    spread = rows.select(key, F.posexplode_outer(ids).alias("pos", "id"))
    missing = F.raise_error(F.concat(F.lit("no vector for id "), F.col("id").cast("string")))
    found = spread.join(table.withColumn("_there", F.lit(True)), "id", "left").withColumn(
        "vector", F.when(F.col("pos").isNull() | F.col("_there"), F.col("vector")).otherwise(missing))
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", "vector"))
    return found.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_v")).select(
        key, F.transform("_v", lambda x: x.vector).alias("vectors"))


def feature_records(features: DataFrame, activations: DataFrame, layers: list[int], digits: int = 6) -> DataFrame:
    """(linex_index, features) for export: every real token with its chosen layers.

    A token without activations is an error.

    ``features``: (unique_id, tokens); ``activations``: (unique_id, pos, layers array<array<double>>).
    """
    def chosen(all_layers):
        return F.array(*[
            F.struct(F.lit(i).alias("index"),
                     F.transform(F.element_at(all_layers, i if i < 0 else i + 1), lambda v: F.round(v, digits)).alias("values"))
            for i in layers])

    # posexplode would infer a filter on tokens and evaluate them twice; tokens are never empty.
    tokens = features.select("unique_id", F.posexplode_outer("tokens").alias("pos", "token"))
    missing = F.raise_error(F.concat_ws(" ", F.lit("no activations for"), F.col("unique_id").cast("string"), F.col("pos").cast("string")))
    joined = tokens.join(activations, ["unique_id", "pos"], "left").withColumn("layers", F.coalesce("layers", missing))
    return joined.groupBy(F.col("unique_id").cast("int").alias("linex_index")).agg(
        F.sort_array(F.collect_list(F.struct("pos", F.struct("token", chosen(F.col("layers")).alias("layers")).alias("f")))).alias("_f")
    ).select("linex_index", F.transform("_f", lambda x: x.f).alias("features"))
