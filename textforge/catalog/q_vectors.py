"""Vector and JSON column operators over the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from textforge.catalog import sql as S
from textforge.catalog.inputs import table
from textforge.catalog.q_examples import FEATURE_SQL, pair_tokens
from textforge.catalog.registry import query
from textforge.functions import vectors as V
from textforge.operators.features import assemble_features, embedding_lookup, feature_records


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", V.as_double(F.col("embedding")).alias("v"))


VEC = "vectors AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"
LOGP = f"""{VEC},
logp AS (SELECT vec_id, label, list_transform(v, lambda x: x - m - n) AS lp FROM (
  SELECT *, ln(list_sum(list_transform(v, lambda x: exp(x - m)))) AS n FROM (SELECT *, list_max(v) AS m FROM vectors)))"""


def weighted(v):
    """Position-weighted sum: a digest that depends on every element and its place."""
    return V.array_total(F.transform(v, lambda x, i: x * (i + 1)))


WEIGHTED = "list_sum(list_transform({0}, lambda x, i: x * i))"


@query("log_softmax", f"""WITH {LOGP}
SELECT vec_id, round(list_sum(lp), 6) AS total, round({WEIGHTED.format('lp')}, 6) AS weighted, round(list_max(lp), 6) AS top,
  round(list_sum(list_transform(lp, lambda x: exp(x))), 6) AS mass FROM logp""")
def log_softmax(spark, sf_dir):
    rows = vectors(spark, sf_dir).select("vec_id", V.log_softmax(F.col("v")).alias("lp"))
    return rows.select("vec_id", F.round(V.array_total(F.col("lp")), 6).alias("total"), F.round(weighted(F.col("lp")), 6).alias("weighted"),
                       F.round(F.array_max("lp"), 6).alias("top"),
                       F.round(V.array_total(F.transform("lp", lambda x: F.exp(x))), 6).alias("mass"))


@query("argmax", f"WITH {VEC} SELECT vec_id, (list_position(v, list_max(v)) - 1)::INT AS best FROM vectors")
def argmax(spark, sf_dir):
    return vectors(spark, sf_dir).select("vec_id", V.argmax(F.col("v")).alias("best"))


@query("cross_entropy", f"WITH {LOGP} SELECT vec_id, round(-lp[label + 1], 6) AS loss FROM logp")
def cross_entropy(spark, sf_dir):
    rows = vectors(spark, sf_dir).select("vec_id", "label", V.log_softmax(F.col("v")).alias("lp"))
    return rows.select("vec_id", F.round(V.cross_entropy(F.col("lp"), F.col("label")), 6).alias("loss"))


@query("gather_positions", f"""WITH {VEC} SELECT vec_id, round(v[vec_id % 64 + 1], 9) AS a, round(v[(vec_id * 7) % 64 + 1], 9) AS b, round(v[1], 9) AS c FROM vectors""")
def gather_positions(spark, sf_dir):
    at = F.array((F.col("vec_id") % 64).cast("int"), (F.col("vec_id") * 7 % 64).cast("int"), F.lit(0))
    rows = vectors(spark, sf_dir).select("vec_id", V.gather_at(F.col("v"), at).alias("g"))
    return rows.select("vec_id", *[F.round(F.get("g", F.lit(i)), 9).alias(c) for i, c in enumerate("abc")])


@query("layer_norm", f"""WITH {VEC}, stats AS (SELECT *, list_sum(v) / len(v) AS mean FROM vectors),
normed AS (SELECT vec_id, list_transform(v, lambda x: (x - mean) / sd) AS y FROM (
  SELECT *, sqrt(list_sum(list_transform(v, lambda x: (x - mean) * (x - mean))) / len(v) + 1e-12::DOUBLE) AS sd FROM stats))
SELECT vec_id, round(list_max(y), 6) AS top, round(list_min(y), 6) AS low, round({WEIGHTED.format('y')}, 5) AS weighted FROM normed""")
def layer_norm(spark, sf_dir):
    rows = vectors(spark, sf_dir).select("vec_id", V.layer_norm(F.col("v")).alias("y"))
    return rows.select("vec_id", F.round(F.array_max("y"), 6).alias("top"), F.round(F.array_min("y"), 6).alias("low"),
                       F.round(weighted(F.col("y")), 5).alias("weighted"))


@query("embedding_lookup", """
WITH ids AS (SELECT conv_id, unnest(range(12)) AS pos, unnest(list_transform(range(12), lambda p: (conv_id * 31 + p * 17) % n)) AS id
  FROM (SELECT DISTINCT conv_id FROM conversations), (SELECT count(*) AS n FROM embeddings))
SELECT conv_id, count(*) AS n, round(sum((pos + 1) * embedding[1]::DOUBLE), 6) AS first_sum,
  round(sum((pos + 1) * list_sum(list_transform(embedding, lambda x, k: x::DOUBLE * k))), 4) AS all_sum
FROM ids JOIN embeddings ON vec_id = id GROUP BY conv_id""")
def embedding_rows(spark, sf_dir):
    found = table(spark, sf_dir, "embeddings")
    n = found.count()
    ids = table(spark, sf_dir, "conversations").select("conv_id").distinct().select(
        "conv_id", F.transform(F.sequence(F.lit(0), F.lit(11)), lambda p: (F.col("conv_id") * 31 + p * 17) % n).alias("ids"))
    rows = embedding_lookup(ids, found.select(F.col("vec_id").alias("id"), V.as_double(F.col("embedding")).alias("vector")), "conv_id")

    def total(value):
        return V.array_total(F.transform("vectors", lambda v, i: value(v) * (i + 1)))

    every = total(lambda v: V.array_total(F.transform(v, lambda x, k: x * (k + 1))))
    return rows.select("conv_id", F.size("vectors").cast("long").alias("n"), F.round(total(lambda v: F.get(v, F.lit(0))), 6).alias("first_sum"),
                       F.round(every, 4).alias("all_sum"))


@query("select_layers", f"""WITH {VEC} SELECT vec_id, round(v[64], 9) AS a, round(v[63], 9) AS b, round(v[1], 9) AS c, round(v[3], 9) AS d FROM vectors""")
def select_layers(spark, sf_dir):
    rows = vectors(spark, sf_dir).select("vec_id", V.select_layers(F.col("v"), [-1, -2, 0, 2]).alias("s"))
    return rows.select("vec_id", *[F.round(F.get("s", F.lit(i)), 9).alias(c) for i, c in enumerate("abcd")])


@query("features_json", S.with_ctes(FEATURE_SQL, """, tokens AS (
  SELECT unique_id, unnest(range(len(t))) AS pos, unnest(t) AS token FROM (SELECT unique_id, CASE WHEN single THEN ['[CLS]'] || a[1:14] || ['[SEP]']
      ELSE ['[CLS]'] || a[1:ka] || ['[SEP]'] || b[1:kb] || ['[SEP]'] END AS t FROM (
    SELECT *, la - (CASE WHEN la > lb THEN f ELSE 0 END) - (e - f) // 2 AS ka,
           lb - (CASE WHEN lb >= la THEN f ELSE 0 END) - ((e - f) - (e - f) // 2) AS kb FROM (
      SELECT *, least(e, abs(la - lb)) AS f FROM (
        SELECT *, b IS NULL OR len(b) = 0 AS single, greatest(0, len(a) + coalesce(len(b), 0) - 13) AS e,
               len(a) AS la, coalesce(len(b), 0) AS lb FROM text_tokens))))),
hit AS (SELECT unique_id, pos, token, embedding::DOUBLE[] AS v FROM tokens, (SELECT count(*) AS n FROM embeddings)
  JOIN embeddings ON vec_id = (unique_id * 16 + pos) % n)
SELECT unique_id::INT AS linex_index, count(*) AS n_tokens, string_agg(token, ' ' ORDER BY pos) AS tokens,
  round(sum(round(v[4], 6)), 6) AS last_layer, round(sum(round(v[1], 6)), 6) AS first_layer FROM hit GROUP BY unique_id""".lstrip()))
def features_json(spark, sf_dir):
    """Export records per text pair, flattened to columns."""
    n = table(spark, sf_dir, "embeddings").count()
    features = assemble_features(pair_tokens(spark, sf_dir), 16, "[CLS]", "[SEP]").select("unique_id", "tokens")
    places = features.select("unique_id", F.posexplode_outer("tokens").alias("pos", "_t")).select(
        "unique_id", "pos", ((F.col("unique_id") * 16 + F.col("pos")) % n).alias("vec_id"))
    layers = vectors(spark, sf_dir).select("vec_id", F.transform(F.slice("v", 1, 4), lambda x: F.array(x)).alias("layers"))
    activations = places.join(layers, "vec_id").select("unique_id", "pos", "layers")
    records = feature_records(features, activations, [-1, 0])

    def layer_sum(i):
        return F.round(F.aggregate("features", F.lit(0.0), lambda a, f: a + F.get(F.get(f.layers, F.lit(i))["values"], F.lit(0))), 6)

    return records.select(
        "linex_index", F.size("features").cast("long").alias("n_tokens"),
        F.array_join(F.transform("features", lambda f: f.token), " ").alias("tokens"),
        layer_sum(0).alias("last_layer"), layer_sum(1).alias("first_layer"))
