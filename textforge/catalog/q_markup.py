"""Markup, headers and sentences."""

from __future__ import annotations

from pyspark.sql import functions as F

from textforge.catalog import sql as S
from textforge.catalog.inputs import table, text_lines, texts
from textforge.catalog.q_io import EXTRACT_LINES_SQL, EXTRACT_SQL, extract_lines, extracts
from textforge.catalog.registry import query
from textforge.functions import markup
from textforge.functions.sentences import split_sentences
from textforge.operators.headers import drop_doc_headers
from textforge.storage import spread

# Test markup put before a line, by line number and document.
SAMPLES = [
    "[[x]] ", "[[x|y]] ", "[[File:a|b|c]] ", "[[Category:Q]] ", "<ref name=a>", "<ref>z</ref>", "k <section a=b/>text<br/> z ",
    "<chem>H2O</chem> ", "<br>", "[w] ", "alt=", "", "[[a|[[b]]]] ", "<b<sup>r> ", "<gallery mode=x>[[Image:p.png|q|r]]</gallery>",
    "<poem style=i>v</poem> <graph>{a}</graph>", "<div class=c>d</div style>", "<, ref x</ref><mapframe a=1 /><nowiki>n</nowiki>",
]
SAMPLE_SQL = "[" + ", ".join(S.q(s) for s in SAMPLES) + "]"
MARKED_SQL = f"""{S.LINES},
marked AS (SELECT doc_id, line_no, ({SAMPLE_SQL})[(line_no + doc_id) % {len(SAMPLES)} + 1] || line AS line FROM lines)"""


def marked_lines(spark, sf_dir):
    pick = F.element_at(F.lit(SAMPLES), ((F.col("line_no") + F.col("doc_id")) % len(SAMPLES) + 1).cast("int"))
    return text_lines(spark, sf_dir).withColumn("line", F.concat(pick, "line"))


@query("drop_doc_headers", S.with_ctes(EXTRACT_LINES_SQL, """
SELECT doc_id, line_no, CASE WHEN is_doc THEN '' ELSE md5(line) END AS line_md5 FROM (
  SELECT *, line_no - 1 - coalesce(max(CASE WHEN NOT is_doc THEN line_no END) OVER (
      PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS run_before
  FROM (SELECT *, contains(line, '<doc') AS is_doc FROM extract_lines))
WHERE run_before % 2 = 0 AND (is_doc OR (NOT contains(line, '</doc>') AND line <> ''))"""))
def drop_headers(spark, sf_dir):
    kept = drop_doc_headers(extract_lines(spark, sf_dir), "doc_id", lines_per_block=1000)
    return kept.select("doc_id", "line_no", F.when(F.col("line") == "", "").otherwise(F.md5("line")).alias("line_md5"))


@query("drop_doc_headers_text", S.with_ctes(EXTRACT_LINES_SQL, """
SELECT doc_id, md5(string_agg(CASE WHEN is_doc THEN '' ELSE line END || chr(10), '' ORDER BY line_no)) AS text_md5 FROM (
  SELECT *, line_no - 1 - coalesce(max(CASE WHEN NOT is_doc THEN line_no END) OVER (
      PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS run_before
  FROM (SELECT *, contains(line, '<doc') AS is_doc FROM extract_lines))
WHERE run_before % 2 = 0 AND (is_doc OR (NOT contains(line, '</doc>') AND line <> ''))
GROUP BY doc_id"""))
def drop_headers_text(spark, sf_dir):
    """The same on whole files, without a shuffle."""
    return extracts(spark, sf_dir).select("doc_id", F.md5(markup.strip_headers(F.col("text"))).alias("text_md5"))


DROP_SQL = " AND ".join(f"NOT regexp_matches(line, {S.q(p)})" for p in markup.DROP_LINE_PATTERNS)


@query("drop_category_lines", S.with_ctes(MARKED_SQL, f"SELECT doc_id, line_no::BIGINT AS line_no FROM marked WHERE {DROP_SQL}"))
def drop_category_lines(spark, sf_dir):
    return marked_lines(spark, sf_dir).where(markup.keeps_line(F.col("line"))).select("doc_id", F.col("line_no").cast("long").alias("line_no"))


@query("unwrap_links", S.with_ctes(MARKED_SQL, f"""
SELECT doc_id, line_no::BIGINT AS line_no, md5({S.unwrap_links('line')}) AS line_md5 FROM marked"""))
def unwrap_links(spark, sf_dir):
    return marked_lines(spark, sf_dir).select("doc_id", F.col("line_no").cast("long").alias("line_no"),
                                              F.md5(markup.unwrap_links(F.col("line"))).alias("line_md5"))


@query("strip_tags", f"SELECT page_id, md5({S.strip_tags('html')}) AS html_md5 FROM pages")
def strip_tags(spark, sf_dir):
    return spread(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id").select("page_id", F.md5(markup.strip_tags(F.col("html"))).alias("html_md5"))


CLEANED_SQL = f"""{MARKED_SQL},
cleaned AS (SELECT doc_id, line_no, {S.strip_tags(S.unwrap_links('line'))} AS line FROM marked WHERE {DROP_SQL})"""


def marked_texts(spark, sf_dir):
    """Documents with the test markup, whole texts."""
    pick = F.lit(SAMPLES)
    lines = F.transform(F.split("text", "\n"), lambda l, i: F.concat(
        F.element_at(pick, ((i + F.col("doc_id")) % len(SAMPLES) + 1).cast("int")), l))
    return texts(spark, sf_dir).select("doc_id", F.array_join(lines, "\n").alias("text"))


@query("clean_markup", S.with_ctes(CLEANED_SQL, """
SELECT doc_id, count(*) AS n_lines, sum(length(line))::BIGINT AS n_chars,
  md5(string_agg(line, chr(10) ORDER BY line_no)) AS text_md5 FROM cleaned GROUP BY doc_id"""))
def clean_markup(spark, sf_dir):
    kept = F.filter(F.split("text", "\n"), markup.keeps_line)
    cleaned = marked_texts(spark, sf_dir).select("doc_id", kept.alias("kept")).where(F.size("kept") > 0).select(
        "doc_id", F.size("kept").cast("long").alias("n_lines"), markup.clean_markup(F.array_join("kept", "\n")).alias("text"))
    return cleaned.select("doc_id", "n_lines", (F.length("text") - F.col("n_lines") + 1).cast("long").alias("n_chars"),
                          F.md5("text").alias("text_md5"))


@query("article_fragments", S.with_ctes(CLEANED_SQL, f"""
SELECT doc_id, count(*) AS n_fragments, sum(CASE WHEN f = '' THEN 1 ELSE 0 END)::BIGINT AS n_empty FROM (
  SELECT doc_id, unnest(string_split(string_agg(CASE WHEN {S.strip('line')} = '' THEN '' ELSE line END, chr(10) ORDER BY line_no), chr(10) || chr(10))) AS f
  FROM cleaned GROUP BY doc_id) GROUP BY doc_id"""))
def article_fragments(spark, sf_dir):
    """Lines emptied by the cleaning are kept and cut their article into pieces."""
    kept = F.array_join(F.filter(F.split("text", "\n"), markup.keeps_line), "\n")
    cleaned = marked_texts(spark, sf_dir).where(
        F.exists(F.split("text", "\n"), markup.keeps_line)).select("doc_id", markup.clean_markup(kept).alias("text"))
    blanked = F.regexp_replace("text", r"(?m)^[ \t\x0B\f\r]+$", "")
    parts = cleaned.select("doc_id", F.explode(F.split(blanked, "\n\n")).alias("f"))
    return parts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_fragments"),
                                       F.sum((F.col("f") == "").cast("long")).alias("n_empty"))


@query("split_sentences", S.with_ctes(S.SENTENCES, """
SELECT doc_id, sent_no::BIGINT AS sent_no, md5(sent) AS sent_md5 FROM sentences"""))
def split_sentences_rows(spark, sf_dir):
    return texts(spark, sf_dir).select("doc_id", F.posexplode(split_sentences(F.col("text"))).alias("sent_no", "sent")).select(
        "doc_id", F.col("sent_no").cast("long").alias("sent_no"), F.md5("sent").alias("sent_md5"))


@query("sentence_counts", S.with_ctes(S.SENTENCES, """
SELECT doc_id, count(*) AS n_sentences, max(length(sent))::BIGINT AS longest FROM sentences GROUP BY doc_id"""))
def sentence_counts(spark, sf_dir):
    sents = split_sentences(F.col("text"))
    return texts(spark, sf_dir).select("doc_id", sents.alias("s")).select(
        "doc_id", F.size("s").cast("long").alias("n_sentences"),
        F.array_max(F.transform("s", lambda x: F.length(x))).cast("long").alias("longest"))
