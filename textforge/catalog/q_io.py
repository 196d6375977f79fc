"""Sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from textforge.catalog import sql as S
from textforge.catalog.inputs import SEED, documents, settings, table, texts, tokenized, vocab_lines
from textforge.catalog.registry import query
from textforge.functions.draws import order_key
from textforge.functions.markup import DROP_LINE_PATTERNS
from textforge.functions.normalize import decode_utf8_ignore
from textforge.functions.sentences import split_sentences
from textforge.operators.examples import padded_examples, shuffled_pairs
from textforge.operators.holdout import article_hash
from textforge.operators.ordering import dense_index
from textforge.operators.packing import pack_name
from textforge.operators.vocab import vocab_from_lines
from textforge.plans import corpus
from textforge.sources.sinks import article_text
from textforge.sources.text import documents_from, list_files, split_articles, split_lines, split_pair
from textforge.sources.tfrecord import assign_files, read_tfrecord, write_tfrecord
from textforge.storage import materialize, shared_folder

# Each document as an extract file: headers, titles and an empty line before every fourth line.
EXTRACT_SQL = """extracts AS (
  SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda l, i:
      CASE WHEN (i - 1) % 4 = 0 THEN '<doc id="' || doc_id || '" url="u">' || chr(10) || 'T' || i || chr(10) || chr(10)
           WHEN (i - 1) % 4 = 3 THEN '<doc a>' || chr(10) || '<doc b>' || chr(10) ELSE '' END || l ||
      CASE WHEN (i - 1) % 4 = 2 THEN chr(10) || '</doc>' ELSE '' END), chr(10)) || chr(10) AS text FROM documents)"""


def extracts(spark, sf_dir, *columns):
    def wrap(line, i):
        head = F.when(i % 4 == 0, F.concat(F.lit('<doc id="'), F.col("doc_id").cast("string"), F.lit('" url="u">\nT'),
                                           (i + 1).cast("string"), F.lit("\n\n")))
        head = head.when(i % 4 == 3, "<doc a>\n<doc b>\n").otherwise("")
        return F.concat(head, line, F.when(i % 4 == 2, "\n</doc>").otherwise(""))

    body = F.array_join(F.transform(F.split("text", "\n"), wrap), "\n")
    return texts(spark, sf_dir, *columns).select("doc_id", F.concat(body, F.lit("\n")).alias("text"), *columns)


EXTRACT_LINES_SQL = f"""{EXTRACT_SQL},
extract_lines AS (SELECT doc_id, unnest(range(len(l) - 1))::BIGINT AS line_no, unnest(l[1:len(l) - 1]) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM extracts))"""


def extract_lines(spark, sf_dir):
    return extracts(spark, sf_dir).select(
        "doc_id", F.posexplode(split_lines(F.col("text"))).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))


# Each document as an article file: every line is an article, every third one is followed by two blank lines.
ARTICLE_FILE_SQL = """article_files AS (
  SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda l, i:
      l || CASE WHEN i % 3 = 0 THEN chr(10) || chr(10) || chr(10) WHEN i % 3 = 1 THEN chr(10) || chr(10) ELSE chr(10) END), '')
      || chr(10) AS text FROM documents)"""


def article_files(spark, sf_dir):
    def close(line, i):
        return F.concat(line, F.when(i % 3 == 2, "\n\n\n").when(i % 3 == 0, "\n\n").otherwise("\n"))

    return texts(spark, sf_dir).select("doc_id", F.concat(F.array_join(F.transform(F.split("text", "\n"), close), ""), F.lit("\n")).alias("text"))


@query("file_inventory")
def file_inventory(spark, sf_dir):
    """The table files themselves: sorted, dense ids, sizes."""
    return list_files(spark, f"{sf_dir}/*.parquet").select(
        F.col("file_id").cast("long").alias("file_id"), F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("size").cast("long").alias("size"))


def _folder(spark, name: str) -> str:
    shared = shared_folder(spark)
    if shared is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{shared}/{name}-{uuid.uuid4().hex}"


N_HELD, N_WORKERS = 90, 3
# One extract file per source: its documents' extracts one after the other; state runs across documents.
CORPUS_SQL = f"""{EXTRACT_LINES_SQL},
names AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS file_id FROM (SELECT DISTINCT source FROM documents)),
numbered AS (SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY doc_id, line_no) AS k, line, contains(line, '<doc') AS is_doc
  FROM extract_lines JOIN documents USING (doc_id) JOIN names USING (source)),
kept AS (SELECT file_id, k, CASE WHEN is_doc THEN '' ELSE line END AS line FROM (
    SELECT *, k - 1 - coalesce(max(CASE WHEN NOT is_doc THEN k END) OVER (
      PARTITION BY file_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run_before FROM numbered)
  WHERE run_before % 2 = 0 AND (is_doc OR (NOT contains(line, '</doc>') AND line <> '' AND {" AND ".join(f"NOT regexp_matches(line, {S.q(p)})" for p in DROP_LINE_PATTERNS)}))),
sents AS (SELECT file_id, array_to_string(list_transform(string_split({S.mark("cleaned")}, chr(10)), lambda x: {S.strip("x")}), chr(10)) AS lines, k
  FROM (SELECT file_id, k, {S.strip_tags(S.unwrap_links("line"))} AS cleaned FROM kept)),
bodies AS (SELECT file_id, string_agg(lines, chr(10) ORDER BY k) || chr(10) || chr(10) AS body FROM sents GROUP BY file_id),
arts AS (SELECT file_id, unnest(range(len(p))) AS article_no, unnest(p) AS text FROM (SELECT file_id, string_split(body, chr(10) || chr(10)) AS p FROM bodies))"""


def with_source(spark, sf_dir, small: int = 500_000):
    """extracts joined to the documents' sources by doc_id; only rows that share a doc_id take part in a join.

    The list of shared ids is broadcast if it is short, else joined by a shuffle.
    """
    sources = documents(spark, sf_dir).where("doc_id IS NOT NULL").select("doc_id", "source")
    shared = materialize(sources.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("doc_id"))
    n = shared.count()
    rows = extracts(spark, sf_dir, "source").where("doc_id IS NOT NULL")
    if not n:
        return rows
    few = F.broadcast(shared) if n <= small else shared
    twice = rows.drop("source").join(few, "doc_id", "left_semi").join(sources.join(few, "doc_id", "left_semi"), "doc_id")
    return rows.join(few, "doc_id", "left_anti").unionByName(twice)


def extract_files(spark, sf_dir) -> str:
    """The documents' extracts written as one file per source; the folder's glob."""
    folder = _folder(spark, "extracts")
    rows = with_source(spark, sf_dir).select("source", "doc_id", F.regexp_replace("text", r"\n\z", "").alias("value"))
    # A source is one file here, so that the readers meet files of any size.
    rows.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "value").write.partitionBy("source").text(folder)
    return f"{folder}/*/*.txt"


@query("extract_inventory", S.with_ctes(CORPUS_SQL, """
SELECT file_id::BIGINT AS file_id, source, sum(strlen(extracts.text))::BIGINT AS size
FROM extracts JOIN documents USING (doc_id) JOIN names USING (source) GROUP BY ALL"""))
def extract_inventory(spark, sf_dir):
    """Files written from the documents, numbered in path order, with their sizes."""
    return list_files(spark, extract_files(spark, sf_dir)).select(
        F.col("file_id").cast("long").alias("file_id"), F.regexp_extract("path", "/source=([^/]*)/", 1).alias("source"), F.col("size").cast("long").alias("size"))


@query("extract_articles", S.with_ctes(CORPUS_SQL, """
SELECT file_id::BIGINT AS file_id, article_no::BIGINT AS article_no, md5(text) AS text_md5 FROM arts"""))
def extract_articles_rows(spark, sf_dir):
    """Extract files read in parts: state and article numbers are carried across segments."""
    s = corpus.CorpusSettings(whole_file_bytes=0, segment_bytes=50_000)
    return corpus.corpus_articles(spark, extract_files(spark, sf_dir), s).select(
        F.col("file_id").cast("long").alias("file_id"), "article_no", F.md5("text").alias("text_md5"))


@query("prepare_corpus_roundtrip", S.with_ctes(CORPUS_SQL, f"""
, n_files AS (SELECT count(*) AS f FROM names),
held AS (SELECT file_id, article_no FROM (
    SELECT file_id, article_no, row_number() OVER (PARTITION BY file_id ORDER BY {S.h(SEED, 'file_id', 'article_no')}) AS r FROM arts)
  CROSS JOIN n_files WHERE r <= floor((file_id + 1) * {N_HELD}::DOUBLE / f) - floor(file_id * {N_HELD}::DOUBLE / f)),
train AS (SELECT a.*, article_no = max(article_no) OVER (PARTITION BY file_id) AS is_last FROM arts a ANTI JOIN held USING (file_id, article_no)),
width AS (SELECT (f + {N_WORKERS} - 1) // {N_WORKERS} AS w FROM n_files),
packs AS (SELECT file_id, printf('part-%05d-of-%05d', file_id - least(file_id // w, {N_WORKERS} - 1) * w + 1000 * least(file_id // w, {N_WORKERS} - 1), 500) AS part
  FROM names, width),
lines AS (SELECT part, unnest(string_split(text || CASE WHEN is_last THEN '' ELSE chr(10) END, chr(10))) AS line FROM train JOIN packs USING (file_id)
  UNION ALL SELECT 'eval_text', unnest(string_split(text || chr(10), chr(10))) FROM arts SEMI JOIN held USING (file_id, article_no)
  UNION ALL SELECT 'eval_md5', md5({S.rstrip('text')}) FROM arts SEMI JOIN held USING (file_id, article_no))
SELECT part, count(*) AS n_lines, sum(length(line))::BIGINT AS n_chars, sum((line = '')::INT)::BIGINT AS n_blank,
  sum(('0x' || substr(md5(line), 1, 8))::BIGINT)::BIGINT AS line_sum FROM lines GROUP BY part""".lstrip()))
def prepare_corpus_roundtrip(spark, sf_dir):
    """The whole job on files: extracts in; packed training text, held-out text and hashes out, read back as lines."""
    out = _folder(spark, "corpus")
    s = corpus.CorpusSettings(n_test=N_HELD, block_bytes=1, workers=N_WORKERS, seed=SEED)
    corpus.prepare_corpus(spark, extract_files(spark, sf_dir), out, s)
    train = spark.read.text(f"{out}/train", lineSep="\n").select(F.col("pack_name").alias("part"), F.col("value").alias("line"))
    held = [spark.read.text(f"{out}/{name}", lineSep="\n").select(F.lit(name).alias("part"), F.col("value").alias("line")) for name in ("eval_text", "eval_md5")]
    return train.union(held[0]).union(held[1]).groupBy("part").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).cast("long").alias("n_chars"), F.sum((F.col("line") == "").cast("long")).alias("n_blank"),
        F.sum(F.conv(F.substring(F.md5("line"), 1, 8), 16, 10).cast("long")).alias("line_sum"))


@query("wiki_lines", S.with_ctes(EXTRACT_LINES_SQL, "SELECT doc_id, line_no, md5(line) AS line_md5 FROM extract_lines"))
def wiki_lines(spark, sf_dir):
    return extract_lines(spark, sf_dir).select("doc_id", "line_no", F.md5("line").alias("line_md5"))


@query("articles_split", S.with_ctes(ARTICLE_FILE_SQL, """
SELECT doc_id, unnest(range(len(p)))::BIGINT AS article_no, md5(unnest(p)) AS article_md5
FROM (SELECT doc_id, string_split(text, chr(10) || chr(10)) AS p FROM article_files)"""))
def articles_split(spark, sf_dir):
    pieces = article_files(spark, sf_dir).select("doc_id", F.posexplode(split_articles(F.col("text"))).alias("article_no", "text"))
    return pieces.select("doc_id", F.col("article_no").cast("long").alias("article_no"), F.md5("text").alias("article_md5"))


@query("documents_nonempty", S.with_ctes(ARTICLE_FILE_SQL, f"""
SELECT doc_id, count(*) AS n_documents, sum(n)::BIGINT AS n_sentences, sum(chars)::BIGINT AS n_chars FROM (
  SELECT doc_id, len(s) AS n, list_sum(list_transform(s, lambda x: length(x))) AS chars FROM (
    SELECT doc_id, list_filter(list_transform(string_split(piece, chr(10)), lambda x: {S.strip('x')}), lambda x: x <> '') AS s
    FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\\n{{2,}}')) AS piece FROM article_files)) WHERE len(s) > 0)
GROUP BY doc_id"""))
def documents_nonempty(spark, sf_dir):
    articles = article_files(spark, sf_dir).select("doc_id", F.explode(split_articles(F.col("text"))).alias("text"))
    chars = F.aggregate("sentences", F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    return documents_from(articles).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum(F.size("sentences")).cast("long").alias("n_sentences"),
        F.sum(chars).alias("n_chars"))


@query("vocab_ids", S.with_ctes(S.VOCAB, "SELECT token, token_id FROM vocab"))
def vocab_ids(spark, sf_dir):
    return vocab_from_lines(vocab_lines(spark, sf_dir))


PAIR_LINES_SQL = """pair_lines AS (
  SELECT conv_id * 1000 + turn AS line_no, CASE WHEN turn % 3 = 2 THEN replace(text, chr(10), ' ') ELSE a || ' ||| ' || b END AS line
  FROM (SELECT conv_id, turn, text, string_split(text, chr(10))[1] AS a,
               CASE WHEN contains(text, chr(10)) THEN array_to_string(string_split(text, chr(10))[2:], ' ') ELSE role || ' ||| ' || role END AS b
        FROM conversations))"""


def pair_lines(spark, sf_dir):
    parts = F.split("text", "\n")
    rest = F.array_join(F.slice(parts, F.lit(2), F.size(parts)), " ")
    a, b = F.get(parts, F.lit(0)), F.when(F.size(parts) > 1, rest).otherwise(F.concat_ws(" ||| ", "role", "role"))
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("line_no"),
        F.when(F.col("turn") % 3 == 2, F.replace("text", F.lit("\n"), F.lit(" "))).otherwise(F.concat(a, F.lit(" ||| "), b)).alias("line"))


PAIRS_SQL = f"""{PAIR_LINES_SQL},
text_pairs AS (SELECT line_no AS unique_id,
    CASE WHEN is_pair THEN regexp_extract(l, '^(.*) \\|\\|\\| (.*)$', 1) ELSE l END AS text_a,
    CASE WHEN is_pair THEN regexp_extract(l, '^(.*) \\|\\|\\| (.*)$', 2) END AS text_b
  FROM (SELECT line_no, l, regexp_matches(l, '^(.*) \\|\\|\\| (.*)$') AS is_pair
        FROM (SELECT line_no, {S.strip('line')} AS l FROM pair_lines)))"""


def text_pairs(spark, sf_dir):
    return pair_lines(spark, sf_dir).select(F.col("line_no").alias("unique_id"), split_pair(F.col("line")).alias("p")).select("unique_id", "p.*")


@query("read_pairs", S.with_ctes(PAIRS_SQL, "SELECT unique_id, text_a, text_b FROM text_pairs"))
def read_pairs(spark, sf_dir):
    return text_pairs(spark, sf_dir)


@query("tfrecord_roundtrip", S.with_ctes(S.INSTANCES, f"""
SELECT doc_id % 8 AS part, count(*) AS n, sum(list_sum(original) + delta)::BIGINT AS id_sum,
  sum(list_sum(positions))::BIGINT AS position_sum, sum(list_sum(labels))::BIGINT AS label_sum,
  sum(len(positions))::BIGINT AS weight_sum, sum(is_random::INT)::BIGINT AS random_sum
FROM (SELECT w.doc_id, w.dupe, w.chunk_no, original, is_random, positions, labels, delta
      FROM whole w JOIN masks m USING (doc_id, dupe, chunk_no)) GROUP BY 1""".replace("doc_id % 8 AS part", "0::BIGINT AS part")))
def tfrecord_roundtrip(spark, sf_dir):
    """Examples written as TFRecord files, read back and summed."""
    s = settings(spark, sf_dir)
    docs = tokenized(spark, sf_dir, stored=True)
    folder = _folder(spark, "tfrecord")
    write_tfrecord(shuffled_pairs(docs, s).drop("partner_id"), folder, int(spark.conf.get("spark.sql.shuffle.partitions")),
                   made=lambda rows: padded_examples(rows, s, "file_no"), compression="gzip")
    back = read_tfrecord(spark, folder, s.max_seq, s.max_pred)

    def total(c):
        return F.sum(F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x))

    return back.agg(
        F.lit(0).cast("long").alias("part"), F.count(F.lit(1)).alias("n"), total("input_ids").alias("id_sum"),
        total("masked_lm_positions").alias("position_sum"), total("masked_lm_ids").alias("label_sum"),
        total(F.col("masked_lm_weights").cast("array<long>")).alias("weight_sum"),
        total("next_sentence_labels").alias("random_sum"))


@query("utf8_ignore", "SELECT doc_id, md5(text) AS text_md5, true AS same FROM documents")
def utf8_ignore(spark, sf_dir):
    """Every text with stray bytes at its start, in its middle and at its end decodes to itself."""
    half = F.floor(F.length("text") / 2).cast("int")
    parts = [F.encode(F.substring("text", F.lit(1), half), "UTF-8"), F.encode(F.substring("text", half + 1, F.length("text")), "UTF-8")]
    raw = F.concat(F.unhex(F.lit("FF80")), parts[0], F.unhex(F.lit("C3FE")), parts[1], F.unhex(F.lit("E282")))
    return documents(spark, sf_dir).select("doc_id", F.md5(decode_utf8_ignore(raw)).alias("text_md5"),
                                           (decode_utf8_ignore(raw) == F.col("text")).alias("same"))


@query("article_text", S.with_ctes(S.SENTENCES, """
SELECT doc_id, md5(string_agg(sent, chr(10) ORDER BY sent_no) || chr(10)) AS article_md5 FROM sentences GROUP BY doc_id"""))
def article_text_rows(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", F.md5(article_text(split_sentences(F.col("text")))).alias("article_md5"))


@query("eval_hashes", f"SELECT doc_id, md5({S.rstrip('text || chr(10) || chr(32) || chr(10)')}) AS md5 FROM documents")
def eval_hashes(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", article_hash(F.concat("text", F.lit("\n \n"))).alias("md5"))


@query("round_robin_assign", f"""
SELECT file_no, count(*) AS n, sum(doc_id)::BIGINT AS id_sum, min(idx) AS first_idx FROM (
  SELECT doc_id, idx, (idx % 7)::INT AS file_no FROM (
    SELECT doc_id, row_number() OVER (ORDER BY {S.h(SEED, 'doc_id')}, doc_id) - 1 AS idx FROM documents)) GROUP BY file_no""")
def round_robin_assign(spark, sf_dir):
    indexed = dense_index(documents(spark, sf_dir).select("doc_id"), ["doc_id"], SEED)
    return assign_files(indexed, 7).groupBy("file_no").agg(
        F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("id_sum"), F.min("idx").alias("first_idx"))


@query("pack_names", """
SELECT doc_id, printf('part-%05d-of-%05d', (n_chars // 1000) + 1000 * (doc_id % 20), 500) AS pack_name FROM documents""")
def pack_names(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", pack_name(F.floor(F.col("n_chars") / 1000), F.col("doc_id") % 20, 500).alias("pack_name"))
