"""Queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from textforge.llm import centroids, decontaminate, divergence, main_text, near_dup, pieces, quality, repeats, secrets, token_counts, token_files, topk, warc
from textforge.storage import shared_folder

QUERIES: dict = {}
ORACLES: dict = {}


def _query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def _table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _new_folder(spark, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@_query("op1_exact_topk", """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
               WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                 CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""")
def op1(spark, sf_dir):
    vectors = topk.integer_vectors(_table(spark, sf_dir, "embeddings"))
    return topk.exact_top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@_query("op2_token_files")
def op2(spark, sf_dir):
    path = _new_folder(spark, "tokens")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path, _tokenizer("byte_bpe_50k.json"))
    read = token_files.with_starts(token_files.read_digests(spark, path))
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


@_query("op3_token_counts")
def op3(spark, sf_dir):
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


@_query("op4_piece_round_trip")
def op4(spark, sf_dir):
    return pieces.round_trip(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


@_query("op5_warc_round_trip")
def op5(spark, sf_dir):
    path = _new_folder(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages"), path)
    read = warc.read_records(spark.read.parquet(f"{path}/index"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op6_contaminated")
def op6(spark, sf_dir):
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query("op7_main_text")
def op7(spark, sf_dir):
    return main_text.main_texts(_table(spark, sf_dir, "pages"))


@_query("op8_secret_scan")
def op8(spark, sf_dir):
    return secrets.digest_columns(secrets.find_secrets(_table(spark, sf_dir, "documents")))


@_query("op9_quality_sample")
def op9(spark, sf_dir):
    return quality.sampled_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query("op10_near_duplicates")
def op10(spark, sf_dir):
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def _cluster_sql(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Rounds written out one after the other; a centroid is a list of components."""
    nearest = """p{r} AS MATERIALIZED (SELECT v.rid, c.cl, CAST(list_sum(list_transform(range(1, {n}), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i]))) AS BIGINT) AS d FROM v, c{r} c),
    a{r} AS MATERIALIZED (SELECT rid, d, cl FROM p{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, cl) = 1)"""
    update = """s{q} AS (SELECT cl, i, sum(x) AS sx, count(*) AS n FROM (SELECT a.cl, unnest(v.e) AS x, unnest(range({dims})) AS i FROM a{r} a JOIN v USING (rid)) GROUP BY cl, i),
    m{q} AS (SELECT cl, list(CAST((sx - ((sx % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM s{q} GROUP BY cl),
    c{q} AS MATERIALIZED (SELECT c.cl, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN m{q} m USING (cl))"""
    parts = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
             FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, e) - 1 AS cl, e FROM (
             SELECT sha256('3:' || vec_id) AS h, e FROM v ORDER BY h, e LIMIT {k}))""", nearest.format(r=0, n=dims + 1)]
    for r in range(rounds):
        parts += [update.format(q=r + 1, r=r, dims=dims), nearest.format(r=r + 1, n=dims + 1)]
    return f"""WITH {", ".join(parts)}
    SELECT vec_id, CAST(cl AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY cl) AS BIGINT) AS cluster_inertia,
           CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
    FROM a{rounds} JOIN v USING (rid) JOIN c{rounds} c USING (cl)"""


@_query("op11_centroid_clusters", _cluster_sql())
def op11(spark, sf_dir):
    return centroids.clustered(_table(spark, sf_dir, "embeddings"))


@_query("op12_repeated_passages", """
    WITH w AS (SELECT doc_id, rid, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
               FROM (SELECT doc_id, text, row_number() OVER () AS rid FROM documents)),
    starts AS (SELECT rid, unnest(range(1, len(ws) - 33)) AS pos FROM w WHERE len(ws) >= 35),
    windows AS (SELECT rid, pos, array_to_string(list_slice(ws, pos, pos + 34), ' ') AS win FROM starts JOIN w USING (rid)),
    counted AS (SELECT rid, pos, count(*) OVER (PARTITION BY win) AS n FROM windows),
    places AS (SELECT rid, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS word FROM w),
    marked AS (SELECT p.rid, p.pos, p.word, coalesce(max(CASE WHEN c.n > 1 THEN 1 ELSE 0 END) OVER (
                   PARTITION BY p.rid ORDER BY p.pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) AS gone
               FROM places p LEFT JOIN counted c USING (rid, pos)),
    kept AS (SELECT rid, CAST(sum(gone) AS BIGINT) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0), '') AS t FROM marked GROUP BY rid)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (rid)""")
def op12(spark, sf_dir):
    return repeats.without_repeats(_table(spark, sf_dir, "documents"), with_text=False).withColumnRenamed("kept", "kept_sha256")


@_query("op13_source_divergence", """
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts
          FROM documents),
    t AS MATERIALIZED (SELECT rid, lang, source, unnest(ts) AS term FROM d),
    kept AS MATERIALIZED (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
    g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
    c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    v AS (SELECT lang, count(*) AS v, sum(total) AS nl FROM kept GROUP BY lang),
    m AS MATERIALIZED (SELECT g.lang, g.source, coalesce(v, 0) AS v, nl, coalesce((SELECT sum(n) FROM c WHERE c.lang = g.lang AND c.source = g.source), 0) AS ns
          FROM g LEFT JOIN v USING (lang)),
    p AS MATERIALIZED (SELECT m.lang, m.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 2) // (m.ns + 2 * m.v) AS p,
                 1 + 1000000000 * (k.total + 2) // (m.nl + 2 * m.v) AS q
          FROM m JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
    sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
             FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
              FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
    found AS (SELECT * FROM pairs UNION ALL
              SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q),
    r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
    SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 10""")
def op13(spark, sf_dir):
    return divergence.audit(_table(spark, sf_dir, "documents"))
