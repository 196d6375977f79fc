"""Normalisation and tokenizing."""

from __future__ import annotations

from pyspark.sql import functions as F

from textforge.catalog import sql as S
from textforge.catalog.inputs import documents, texts, tokenized, vocab, vocab_table
from textforge.catalog.registry import query
from textforge.functions import normalize as N
from textforge.operators import vocab as V
from textforge.operators.tokenizing import word_counts
from textforge.storage import materialize

# Test characters the documents lack: controls, format marks, wide spaces; CJK in place of some letters.
NOISE_FROM, NOISE_TO = "qzxk", "\x07‍ \t"
CJK_FROM, CJK_TO = "aeo", "一龥\U00020000"


def noisy(text):
    return F.translate(text, NOISE_FROM, NOISE_TO)


NOISY_SQL = f"translate(text, {S.q(NOISE_FROM)}, {S.q(NOISE_TO)})"
CJK_SQL = f"translate(text, {S.q(CJK_FROM)}, {S.q(CJK_TO)})"


def digest(tokens):
    """Count and md5 of a token array."""
    return [F.size(tokens).cast("long").alias("n_tokens"), F.md5(F.array_join(tokens, " ")).alias("tokens_md5")]


def digest_sql(tokens: str, source: str = "documents") -> str:
    return f"SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM (SELECT doc_id, {tokens} AS t FROM {source})"


def token_rows(spark, sf_dir, tokens):
    return texts(spark, sf_dir).select("doc_id", tokens.alias("t")).select("doc_id", *digest(F.col("t")))


@query("clean_text", f"SELECT doc_id, md5({S.clean(NOISY_SQL)}) AS text_md5 FROM documents")
def clean_text(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", F.md5(N.clean_text(noisy("text"))).alias("text_md5"))


@query("pad_cjk", f"SELECT doc_id, md5({S.pad_cjk(CJK_SQL)}) AS text_md5 FROM documents")
def pad_cjk(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", F.md5(N.pad_cjk(F.translate("text", CJK_FROM, CJK_TO))).alias("text_md5"))


@query("ws_tokens", digest_sql(S.tokens(NOISY_SQL)))
def ws_tokens(spark, sf_dir):
    return token_rows(spark, sf_dir, N.whitespace_tokens(noisy("text")))


@query("lower_strip_accents", f"SELECT doc_id, md5({S.fold_accents('text')}) AS text_md5 FROM documents")
def lower_strip_accents(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", F.md5(N.lower_strip_accents(F.col("text"))).alias("text_md5"))


@query("split_punct", digest_sql(S.tokens(S.pad_punct("text"))))
def split_punct(spark, sf_dir):
    return token_rows(spark, sf_dir, N.split_punct(F.col("text")))


@query("basic_tokens", digest_sql(S.basic("text")))
def basic_tokens(spark, sf_dir):
    return token_rows(spark, sf_dir, N.basic_tokens(F.col("text")))


@query("basic_tokens_cased", digest_sql(S.tokens(S.pad_punct(S.pad_cjk(S.clean("text"))))))
def basic_tokens_cased(spark, sf_dir):
    return token_rows(spark, sf_dir, N.basic_tokens(F.col("text"), lower=False))


UNUSED = ["[unused0]", "[unused1]", "[unused7]"]
UNUSED_SQL = "regexp_replace(text, '(^| )the ', '\\1[unused1] [unused3] ', 'g')"


@query("preserve_unused", f"""
WITH words AS (SELECT doc_id, unnest(range(len(w))) AS word_no, unnest(w) AS word
  FROM (SELECT doc_id, {S.tokens(S.pad_cjk(S.clean(UNUSED_SQL)))} AS w FROM documents)),
parts AS (SELECT doc_id, word_no, CASE WHEN word IN ('[unused0]', '[unused1]', '[unused7]') THEN [word]
  ELSE {S.tokens(S.pad_punct(S.fold_accents('word')))} END AS p FROM words)
{digest_sql("flatten(list(p ORDER BY word_no))", "parts GROUP BY doc_id")}""")
def preserve_unused(spark, sf_dir):
    marked = F.regexp_replace("text", "(^| )the ", "$1[unused1] [unused3] ")
    return token_rows(spark, sf_dir, N.basic_tokens(marked, unused=UNUSED))


def distinct_words(spark, sf_dir):
    """The documents' words, counted once for the table and, if it is not read yet, the vocabulary."""
    counts = materialize(word_counts(texts(spark, sf_dir), "text"))
    vocab(spark, sf_dir, counts)
    return counts.select("word")


WORDPIECE_SQL = S.with_ctes(S.PIECES, """
SELECT word, array_to_string(list_transform(ids, lambda i: tokens[i + 1]), ' ') AS pieces
FROM pieces, (SELECT list(token ORDER BY token_id) AS tokens FROM vocab)""")


@query("wordpiece", WORDPIECE_SQL)
def wordpiece(spark, sf_dir):
    """Distinct words tokenized once."""
    words = distinct_words(spark, sf_dir)
    return V.wordpieces(words, vocab(spark, sf_dir)).select("word", F.array_join("pieces", " ").alias("pieces"))


@query("wordpiece_by_join", WORDPIECE_SQL)
def wordpiece_by_join(spark, sf_dir):
    """The same without a broadcast vocabulary."""
    words, table = distinct_words(spark, sf_dir), vocab_table(spark, sf_dir)
    longest = table.agg(F.max(F.length("token"))).first()[0]
    return V.wordpiece_by_join(words, table, longest).select("word", F.array_join("pieces", " ").alias("pieces"))


@query("full_tokens", S.with_ctes(S.TOKENS, """
SELECT doc_id, len(ids) AS n_tokens, md5(array_to_string(list_transform(ids, lambda i: tokens[i + 1]), ' ')) AS tokens_md5
FROM docs, (SELECT list(token ORDER BY token_id) AS tokens FROM vocab)"""))
def full_tokens(spark, sf_dir):
    words = vocab(spark, sf_dir)
    found = V.joined_tokens(tokenized(spark, sf_dir).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids"), "ids", words)
    return found.select("doc_id", "n_tokens", F.md5("tokens").alias("tokens_md5"))


@query("tokens_to_ids", S.with_ctes(S.TOKENS, """
SELECT doc_id, len(ids)::BIGINT AS n, list_sum(ids)::BIGINT AS id_sum FROM docs"""))
def tokens_to_ids(spark, sf_dir):
    """All pieces of all words looked up in the vocabulary."""
    pieces = tokenized(spark, sf_dir).select("doc_id", F.explode(V.id_tokens(F.col("ids"), vocab(spark, sf_dir))).alias("token"))
    return V.tokens_to_ids(pieces, vocab_table(spark, sf_dir)).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("token_id").cast("long").alias("id_sum"))


@query("ids_to_tokens", S.with_ctes(S.TOKENS, """
SELECT token, count(*) AS n FROM (SELECT unnest(ids) AS token_id FROM docs) JOIN vocab USING (token_id) GROUP BY token"""))
def ids_to_tokens(spark, sf_dir):
    """Corpus counts per token: ids are counted first, so the lookup meets each id once."""
    counts = tokenized(spark, sf_dir).select(F.explode("ids").alias("token_id")).groupBy("token_id").agg(F.count(F.lit(1)).alias("n"))
    return V.ids_to_tokens(counts, vocab_table(spark, sf_dir)).select("token", "n")


@query("token_counts", S.with_ctes(S.TOKENS, """
SELECT lang, source, count(*) AS n_documents, sum(len(lens))::BIGINT AS n_sentences, sum(len(ids))::BIGINT AS n_tokens,
  max(list_max(lens))::BIGINT AS longest_sentence FROM docs JOIN documents USING (doc_id) GROUP BY lang, source"""))
def token_counts(spark, sf_dir):
    sizes = tokenized(spark, sf_dir).select("doc_id", F.size("ends").alias("s"), F.size("ids").alias("t"),
                                            F.array_max(F.transform("ends", lambda e, i: e - F.coalesce(F.get("ends", i - 1), F.lit(0)))).alias("m"))
    return sizes.join(documents(spark, sf_dir).select("doc_id", "lang", "source"), "doc_id").groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum("s").cast("long").alias("n_sentences"),
        F.sum("t").cast("long").alias("n_tokens"), F.max("m").cast("long").alias("longest_sentence"))
