import re

import numpy as np
import sentencepiece
from brute import components
from test_secrets import PATTERNS

import corpus_pipeline
from textforge.llm import quality, secrets
from textforge.storage import materialize

SF = "/root/testdata/sf0.01"


def test_stages_and_run(spark):
    """Every stage against a brute-force check of its own input."""
    docs = materialize(spark.read.parquet(f"{SF}/documents.parquet"))
    first = docs.columns
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(materialize(stage(spark, tables[-1], SF)))
    rows = [t.collect() for t in tables]
    assert all(t.columns == first for t in tables[:-1])
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert {r.doc_id for r in rows[1]} == {r.doc_id for r in quality.sampled_documents(docs, labels).collect()}
    good = {r.doc_id for r in labels.where("quality = 1 AND toxic = 0").collect()}
    kept = {r.doc_id for r in rows[1]}
    assert len(good & kept) >= 0.97 * len(good)
    assert {r.doc_id for r in rows[2]} == {c for _, _, c in components([(r.doc_id, r.text) for r in rows[1]])}
    items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    plain = {r.doc_id: " ".join(re.findall(r"\w+", r.text.lower())) for r in rows[2]}
    holding = {d for d, text in plain.items() if any(i in text for i in items)}
    left = {r.doc_id for r in rows[3]}
    assert not left & holding and len(left) >= len(rows[2]) - len(holding) - 2
    for r, old in zip(sorted(rows[4]), sorted(rows[3])):
        assert r.doc_id == old.doc_id and r.n_chars == len(r.text)
        assert not any(len(m[g]) >= least for _, p, g, least in PATTERNS for m in p.finditer(r.text))
        if not any(len(m[g]) >= least for _, p, g, least in PATTERNS for m in p.finditer(old.text)) and r.text != old.text:
            assert secrets.MARK.decode() in r.text
    sp = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.PIECES)
    text = {r.doc_id: r.text for r in rows[4]}
    assert len(rows[5]) == len(rows[4])
    for r in rows[5]:
        assert r.same and r.n_tokens == len(r.ids) and sp.decode(r.ids) == text[r.doc_id]
    result = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens").collect()}
    assert result == {r.doc_id: r.n_tokens for r in rows[5]}


def test_odd_rows_pass_every_stage(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, None, None, "s", 0), (2, "", "x", None, 0), (3, "a b", "en", "s", 3), (3, "a b", "en", "s", 3), (4, "token=" + "q" * 40, None, None, 46),
            (5, "word another " * 50_000, "en", "s", 650_000), (None, "lone text here", None, None, 14)]
    for name, data, kind in (("labels", [(3, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int"), ("benchmark", [(1, None), (None, "x")], "item_id long, text string")):
        spark.createDataFrame(data, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, str(tmp_path)))
        got = docs.collect()
        assert len(got) == (7 if data else 0) and all(r.same for r in got)
