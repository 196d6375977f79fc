import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textforge.llm import queries, token_counts, token_files

TEXTS = [None, "", " ", "a", "The cat's  hat\n\n don't 12 34x!?\t\r\n", "x  y", "x 　 y z\u0085 w", "été  où — “q” 漢字 かな", "a<|endoftext|> b <|startoftext|>c",
         "İİ ΣAΣ ﬁ é \U0001f600\U0001f600", "  lead", "trail   ", "q\x00r \x1c s", "A" * 5000, "word " * 30000, "you're I'll 'S 'm"]


def rows(spark, texts=TEXTS):
    data = [(None if k == 3 else k // 2 * 2, t, 1, "z") for k, t in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id long, text string, n_tokens int, unit string"), data


@pytest.fixture(scope="module")
def library():
    return {n: Tokenizer.from_file(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_counts_equal_the_library(spark, library, name):
    df, data = rows(spark)
    got = token_counts.token_counts(df, public_tokenizers.path(name))
    want = [(d, len((t or "").encode()), len(library[name].encode(t or "", add_special_tokens=False).ids)) for d, t, _, _ in data]
    assert sorted(map(str, ((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()))) == sorted(map(str, ((*w, w[2] > 2048) for w in want)))


def test_files_hold_the_library_ids(spark, library, tmp_path):
    df, data = rows(spark)
    token_files.write_tokens(df.repartition(3), f"file://{tmp_path}/t", public_tokenizers.path("byte_bpe_50k.json"))
    read = token_files.with_starts(token_files.read_tokens(spark, f"file://{tmp_path}/t")).orderBy("start").collect()
    want = sorted((str(d), [*library["byte_bpe_50k.json"].encode(t or "", add_special_tokens=False).ids, 0]) for d, t, _, _ in data)
    assert sorted((str(r.doc_id), r.ids) for r in read) == want
    known = [r.doc_id for r in read if r.doc_id is not None]
    assert known == sorted(known) and read[0].doc_id is None
    at = 0
    for r in read:
        assert r.start == at
        at += r.n_tokens
    again = token_files.read_digests(spark, f"file://{tmp_path}/t").collect()
    assert sorted(r.ids_crc32 for r in again) == sorted(zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in read)


def test_pack_round_trip():
    draw = np.random.default_rng(5)
    for ids in (np.zeros(0, np.uint32), np.zeros(9, np.uint32), draw.integers(0, 3_000_000, 200_000).astype(np.uint32), draw.zipf(1.3, 999).clip(0, 70_000).astype(np.uint32)):
        ranked, control, data = token_files.pack(ids)
        assert (token_files.unpack(ranked, control, data, len(ids)) == ids).all()


def test_empty_tables(spark, tmp_path):
    df, _ = rows(spark, [])
    assert token_counts.token_counts(df, public_tokenizers.path("word_bpe_49k.json")).collect() == []
    token_files.write_tokens(df, f"file://{tmp_path}/e", public_tokenizers.path("byte_bpe_50k.json"))
    assert token_files.with_starts(token_files.read_tokens(spark, f"file://{tmp_path}/e")).collect() == []


def test_queries_equal_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    at = 0
    files = {r.doc_id: r for r in queries.op2(spark, sf).collect()}
    counts = {r.doc_id: r for r in queries.op3(spark, sf).collect()}
    assert len(files) == len(counts) == len(docs)
    for d in sorted(docs):
        ids = [*library["byte_bpe_50k.json"].encode(docs[d] or "", add_special_tokens=False).ids, 0]
        assert (files[d].start, files[d].n_tokens, files[d].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert counts[d].n_tokens == len(library["word_bpe_49k.json"].encode(docs[d] or "", add_special_tokens=False).ids)
        at += len(ids)


def test_random_unicode_units(library):
    import pyarrow as pa

    from textforge.llm import arrays

    draw = random.Random(1)
    alphabet = " \n\t\r\x0b\x85\xa0 　᠎​ab'sé1²!?_漢́<|endoftext|>"
    spec = token_files.tokenizer_text(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = token_files.UnitEncoder(spec)
    texts = ["".join(draw.choices(alphabet, k=draw.randrange(0, 40))) for _ in range(3000)]
    ids, sizes = token_files.encode_texts(encoder, pa.array(texts), 7)
    want = [[*e.ids, 7] for e in library["byte_bpe_50k.json"].encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_units_go_through_the_library_together(library, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_files, "KNOWN_UNITS", 40)
    encoder = token_files.UnitEncoder(token_files.tokenizer_text(public_tokenizers.path("byte_bpe_50k.json")))
    calls = []

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            def call(*args, **more):
                calls.append(name)
                return getattr(self.inner, name)(*args, **more)

            return call

    encoder.tokenizer = Counted(encoder.tokenizer)
    draw = random.Random(3)
    for _ in range(6):
        texts = [" ".join(draw.choices(["one", "two,", "x9.", "isn't", "a<|endoftext|>b", "été", f"w{draw.random()}"], k=30)) for _ in range(20)]
        for part in (texts, [x.replace("<|endoftext|>", ";") for x in texts]):
            ids, sizes = token_files.encode_texts(encoder, pa.array(part), 7)
            want = [[*e.ids, 7] for e in library["byte_bpe_50k.json"].encode_batch(part, add_special_tokens=False)]
            assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert calls.count("encode_batch_fast") <= 12
    assert encoder.numbered([" two", ","])[0].tolist() == [encoder.numbers[" two"], encoder.numbers[","]]
