"""Evaluation metrics over the embeddings table as logits."""

from __future__ import annotations

from pyspark.sql import functions as F

from textforge.catalog.inputs import table
from textforge.catalog.registry import query
from textforge.functions.vectors import as_double
from textforge.operators import metrics as M

# Embedding = logits of 64 classes, label = target; every fifth slot is padding with weight 0.
PREDS = """preds AS (SELECT vec_id, vec_id // 5 AS example_id, (vec_id % 5)::INT AS slot, label AS label_id,
  CASE WHEN vec_id % 5 = 4 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, embedding::DOUBLE[] AS logits FROM embeddings),
scored AS (SELECT *, list_position(logits, list_max(logits)) - 1 AS pred,
  -(logits[label_id + 1] - m - ln(list_sum(list_transform(logits, lambda x: exp(x - m))))) AS loss
  FROM (SELECT *, list_max(logits) AS m FROM preds)),
following AS (SELECT vec_id, (vec_id % 2)::INT AS label_id, CASE WHEN l1 > l0 THEN 1 ELSE 0 END AS pred,
  -(CASE WHEN vec_id % 2 = 1 THEN l1 ELSE l0 END - greatest(l0, l1) - ln(exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1)))) AS loss
  FROM (SELECT vec_id, embedding[1]::DOUBLE AS l0, embedding[2]::DOUBLE AS l1 FROM embeddings))"""


def preds(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.floor(F.col("vec_id") / 5).alias("example_id"), (F.col("vec_id") % 5).cast("int").alias("slot"),
        F.col("label").alias("label_id"), F.when(F.col("vec_id") % 5 == 4, 0.0).otherwise(1.0).alias("weight"),
        as_double(F.col("embedding")).alias("logits"))


def scored(spark, sf_dir):
    return M.scored(preds(spark, sf_dir))


def following(spark, sf_dir):
    """Two-class next-sentence logits."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", (F.col("vec_id") % 2).cast("int").alias("label_id"), F.slice(as_double(F.col("embedding")), 1, 2).alias("logits"))
    return M.scored(rows)


@query("masked_accuracy", f"""WITH {PREDS}
SELECT label_id, round(CASE WHEN sum(weight) = 0 THEN 0 ELSE sum(weight * (pred = label_id)::INT) / sum(weight) END, 6) AS accuracy
FROM scored GROUP BY label_id""")
def masked_accuracy(spark, sf_dir):
    return scored(spark, sf_dir).groupBy("label_id").agg(
        F.round(M.accuracy(F.col("pred"), F.col("label_id"), F.col("weight")), 6).alias("accuracy"))


@query("masked_loss", f"""WITH {PREDS}
SELECT label_id, round(sum(weight * loss) / sum(weight), 6) AS weighted_loss, round(avg(loss), 6) AS mean_loss FROM scored GROUP BY label_id""")
def masked_loss(spark, sf_dir):
    return scored(spark, sf_dir).groupBy("label_id").agg(
        F.round(M.weighted_mean(F.col("loss"), F.col("weight")), 6).alias("weighted_loss"), F.round(F.avg("loss"), 6).alias("mean_loss"))


@query("batch_loss", f"""WITH {PREDS}
SELECT m.batch_id, round(m.loss, 6) AS masked_loss, round(n.loss, 6) AS next_loss, round(m.loss + n.loss, 6) AS total_loss
FROM (SELECT example_id // 4 AS batch_id, sum(weight * loss) / (sum(weight) + 1e-5::DOUBLE) AS loss FROM scored GROUP BY 1) m
JOIN (SELECT vec_id // 20 AS batch_id, avg(loss) AS loss FROM following GROUP BY 1) n USING (batch_id)""")
def batch_loss(spark, sf_dir):
    masked = scored(spark, sf_dir).groupBy(F.floor(F.col("example_id") / 4).alias("batch_id")).agg(
        M.batch_loss(F.col("loss"), F.col("weight")).alias("m"))
    nxt = following(spark, sf_dir).groupBy(F.floor(F.col("vec_id") / 20).alias("batch_id")).agg(F.avg("loss").alias("n"))
    return masked.join(nxt, "batch_id").select(
        "batch_id", F.round("m", 6).alias("masked_loss"), F.round("n", 6).alias("next_loss"),
        F.round(F.col("m") + F.col("n"), 6).alias("total_loss"))


REPORT = f"""{PREDS},
report AS (SELECT * FROM (SELECT sum(weight * (pred = label_id)::INT) / sum(weight) AS masked_lm_accuracy,
    sum(weight * loss) / sum(weight) AS masked_lm_loss FROM scored),
  (SELECT avg((pred = label_id)::INT) AS next_sentence_accuracy, avg(loss) AS next_sentence_loss FROM following))"""


@query("eval_report", f"""WITH {REPORT}
SELECT round(masked_lm_accuracy, 6) AS masked_lm_accuracy, round(masked_lm_loss, 6) AS masked_lm_loss,
  round(next_sentence_accuracy, 6) AS next_sentence_accuracy, round(next_sentence_loss, 6) AS next_sentence_loss FROM report""")
def eval_report(spark, sf_dir):
    r = M.eval_report(scored(spark, sf_dir), following(spark, sf_dir))
    return r.select(*[F.round(c, 6).alias(c) for c in r.columns])


@query("metrics_kv", f"""WITH {REPORT}
SELECT key, round(value, 6) AS value FROM (UNPIVOT report ON masked_lm_accuracy, masked_lm_loss, next_sentence_accuracy, next_sentence_loss
  INTO NAME key VALUE value)""")
def metrics_kv(spark, sf_dir):
    r = M.eval_report(scored(spark, sf_dir), following(spark, sf_dir))
    return M.as_key_values(r).select("key", F.round("value", 6).alias("value"))
