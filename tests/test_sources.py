import glob
import gzip
import json
import os
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textforge.operators.examples import PairSettings
from textforge.operators.features import feature_records
from textforge.operators.metrics import as_key_values
from textforge.operators.vocab import vocab_list
from textforge.plans import corpus, feature_export, pretraining
from textforge.sources import sinks, text, tfrecord


def put(folder, name, content):
    path = os.path.join(str(folder), name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(content)
    return path


def test_list_files(spark, tmp_path):
    for name, body in (("b_1", "xx"), ("a_2", "x"), ("c_3", "")):
        put(tmp_path, name, body)
    got = text.list_files(spark, f"{tmp_path}/a_*,{tmp_path}/b_*").orderBy("file_id").collect()
    assert [(r.file_id, r.path[-3:], r["size"]) for r in got] == [(0, "a_2", 1), (1, "b_1", 2)]
    digest = text.file_digests(spark, f"{tmp_path}/b_1").first()
    assert digest.md5 == "9336ebf25087d91c818ee6e9ec29f8c1"


def test_read_lines_numbers_across_blocks(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    put(tmp_path, "big", "\r\n".join(lines) + "\r\n")
    put(tmp_path, "small", "a\n\nb")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        got = text.read_lines(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() > 1
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    big = sorted((r.line_no, r.line) for r in rows if r.path.endswith("big"))
    assert big == list(enumerate(lines))
    assert sorted((r.line_no, r.line) for r in rows if r.path.endswith("small")) == [(0, "a"), (1, ""), (2, "b")]


def test_read_articles_and_documents(spark, tmp_path):
    put(tmp_path, "f", "\nA1\nA2\n\nB1\n\n\nC1\n\n")
    got = text.read_articles(spark, str(tmp_path)).orderBy("article_no").collect()
    assert [r.text for r in got] == ["\nA1\nA2", "B1", "\nC1", ""]
    split = text.read_articles(spark, str(tmp_path), whole_files=False).orderBy("article_no").collect()
    assert [r.text for r in split] == ["\nA1\nA2", "B1", "\nC1", ""]
    docs = text.read_documents(spark, str(tmp_path)).orderBy("article_no").collect()
    assert [r.sentences for r in docs] == [["A1", "A2"], ["B1"], ["C1"]]


def test_read_vocab_and_pairs(spark, tmp_path):
    assert vocab_list(text.read_vocab(spark, put(tmp_path, "v", "a\nb\na\nc\n"))) == ["a", "b", "c"]
    assert vocab_list(text.read_vocab(spark, put(tmp_path, "w", "a\n\nb\n"))) == ["a", "", "b"]
    got = text.read_pairs(spark, put(tmp_path, "p", "x ||| y ||| z\nalone\n")).orderBy("unique_id").collect()
    assert [tuple(r) for r in got] == [(0, "x ||| y", "z"), (1, "alone", None)]
    assert text.read_hash_list(spark, put(tmp_path, "h", "aa\nbb\n")).count() == 2


def example_rows(spark, n, seq=16, pred=3):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        ids = rng.integers(0, 300_000, seq).tolist()
        rows.append((i, ids, [1] * seq, [0] * seq, rng.integers(0, seq, pred).tolist(), rng.integers(0, 200, pred).tolist(),
                     [1.0, 0.5, 0.0], [i % 2]))
    return spark.createDataFrame(rows, "idx long, " + tfrecord.SCHEMA)


def test_tfrecord_round_trip(spark, tmp_path):
    rows, path = example_rows(spark, 500), str(tmp_path / "out")
    tfrecord.write_tfrecord(rows, path, 4)
    names = sorted(os.path.basename(p) for p in glob.glob(path + "/*"))
    assert [n[:10] for n in names] == [f"part-{i:05d}" for i in range(4)] and len({n[10:] for n in names}) == 1
    back = tfrecord.read_tfrecord(spark, path, 16, 3)
    key = [F.col(c).cast("array<string>") for c in tfrecord.FEATURES]
    want = sorted(str(tuple(r)) for r in rows.select(*key).collect())
    assert sorted(str(tuple(r)) for r in back.select(*key).collect()) == want
    first = [r.input_ids for r in tfrecord.read_tfrecord(spark, path + "/part-00001*", 16, 3).collect()]
    assert first == [r.input_ids for r in rows.where("idx % 4 = 1").orderBy("idx").collect()]
    tfrecord.write_tfrecord(rows.where("idx < 10"), path, 2, mode="overwrite")
    assert tfrecord.read_tfrecord(spark, path, 16, 3).count() == 10
    assert len(glob.glob(path + "/*")) == 2


def test_tfrecord_errors(spark, tmp_path):
    path = str(tmp_path / "out")
    tfrecord.write_tfrecord(example_rows(spark, 3), path, 1)
    with pytest.raises(Exception, match="wrong length"):
        tfrecord.read_tfrecord(spark, path, 17, 3).collect()
    name, = glob.glob(path + "/part-00000*")
    data = bytearray(open(name, "rb").read())
    data[40] ^= 1
    open(name, "wb").write(data)
    with pytest.raises(Exception, match="corrupt"):
        tfrecord.read_tfrecord(spark, path, 16, 3).collect()
    open(name, "wb").write(bytes(data[:-3]))
    with pytest.raises(Exception, match="truncated|corrupt"):
        tfrecord.read_tfrecord(spark, path, 16, 3).collect()


def test_known_checksums():
    """CRC32C check value of '123456789' is e3069283; the mask rotates by 15 and adds a constant."""
    crc = 0xE3069283
    want = (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF
    assert int(tfrecord.masked_crcs([b"123456789"])[0]) == want
    assert [int(x) for x in tfrecord.masked_crcs([b"123456789", b"1", b"123456789"])][::2] == [want, want]
    batch = pa.RecordBatch.from_pydict({n: pa.array([[1, 127, 128, 70000], [0, -1, 2**31 - 1, 16384]], pa.list_(pa.int32()))
                                        if n not in tfrecord.FLOAT_FEATURES else pa.array([[0.5] * 4, [1.0] * 4], pa.list_(pa.float32()))
                                        for n in tfrecord.FEATURES})
    coded = tfrecord.encode_examples(batch.slice(1))
    assert tfrecord.decode_examples(coded, lambda n: 4, "x").to_pylist() == batch.slice(1).to_pylist()
    # next_sentence_labels = [1] as one map entry: key, then an int64 list of one packed varint.
    name = b"next_sentence_labels"
    one = pa.RecordBatch.from_pydict({n: pa.array([[1]], pa.list_(pa.float32() if n in tfrecord.FLOAT_FEATURES else pa.int32()))
                                      for n in tfrecord.FEATURES})
    assert tfrecord.encode_examples(one)[0].endswith(b"\x0a\x1d\x0a\x14" + name + b"\x12\x05\x1a\x03\x0a\x01\x01")


def test_report_sinks(spark, tmp_path):
    report = spark.createDataFrame([(0.5, 2.0)], "masked_lm_loss double, acc double")
    sinks.write_metrics(as_key_values(report), str(tmp_path / "m"))
    assert [r.value for r in spark.read.text(str(tmp_path / "m")).collect()] == ["acc = 2.0", "masked_lm_loss = 0.5"]
    rows = spark.createDataFrame([("r1", "batch", 8)], "run_id string, key string, value long")
    for _ in range(2):
        sinks.append_run_events(rows, str(tmp_path / "e"))
    assert spark.read.json(str(tmp_path / "e")).count() == 2
    feats = spark.createDataFrame([(0, ["[CLS]", "a"])], "unique_id int, tokens array<string>")
    acts = spark.createDataFrame([(0, i, [[0.25, 1.0]]) for i in range(2)], "unique_id int, pos int, layers array<array<double>>")
    sinks.write_features_json(feature_records(feats, acts, [-1]), str(tmp_path / "j"))
    line = json.loads(spark.read.text(str(tmp_path / "j")).first()["value"])
    assert line == {"linex_index": 0, "features": [
        {"token": t, "layers": [{"index": -1, "values": [0.25, 1.0]}]} for t in ("[CLS]", "a")]}


def extract(n, start):
    out = []
    for d in range(start, start + n):
        out.append(f'<doc id="{d}" url="u" title="T">\nTitle {d}\n\nThe first of {d} is [[x|here]]. It goes on!\n'
                   f"<br>\nSecond line of {d}.\n[[Category:Q]]\n</doc>\n")
    return "".join(out)


@pytest.mark.parametrize("fragment", [True, False])
def test_prepare_corpus(spark, tmp_path, fragment):
    (tmp_path / "in").mkdir()
    for f in range(5):
        put(tmp_path / "in", f"wiki_{f:02d}", extract(8, 100 * f))
    out = str(tmp_path / "out")
    sizes = [os.path.getsize(p) for p in sorted(glob.glob(f"{tmp_path}/in/*"))]
    s = corpus.CorpusSettings(n_test=6, block_bytes=2 * max(sizes), fragment_on_blank=fragment)
    corpus.prepare_corpus(spark, f"{tmp_path}/in/wiki_*", out, s)
    hashes = [r.value for r in spark.read.text(f"{out}/eval_md5").collect()]
    assert len(hashes) == 6
    train = spark.read.text(f"{out}/train", lineSep="\n")
    assert {r.pack_name for r in train.select("pack_name").distinct().collect()} == {f"part-0000{i}-of-00500" for i in range(3)}
    lines = [r.value for r in train.collect()] + [r.value for r in spark.read.text(f"{out}/eval_text").collect()]
    body = sorted(x for x in lines if x)
    want = sorted(x for f in range(5) for d in range(100 * f, 100 * f + 8)
                  for x in (f"The first of {d} is here.", "It goes on!", f"Second line of {d}."))
    assert body == want
    whole = corpus.corpus_articles(spark, f"{tmp_path}/in/wiki_*", s).where("text <> ''")
    assert whole.count() == (80 if fragment else 40)


def test_file_sizes_do_not_change_articles(spark, tmp_path):
    body = extract(6, 0) + "<doc a>\n<doc b>\n\nTail [[File:q]]. Last one.\n</doc>\n"
    put(tmp_path, "wiki_1", body)
    put(tmp_path, "wiki_2", body * 400)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        rows = corpus.corpus_articles(spark, f"{tmp_path}/wiki_*", corpus.CorpusSettings()).orderBy("file_id", "article_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    one, many = ([r.text for r in rows if r.file_id == f] for f in (0, 1))
    assert many[: len(one) - 1] == one[:-1] and len(many) > 400 and [r.article_no for r in rows if r.file_id == 1] == list(range(len(many)))


def test_tfrecord_append_patterns_and_empty_files(spark, tmp_path):
    rows, path = example_rows(spark, 20), str(tmp_path / "t")
    for _ in range(2):
        tfrecord.write_tfrecord(rows, path, 3)
    assert tfrecord.read_tfrecord(spark, path, 16, 3).count() == 40 and len(glob.glob(f"{path}/part-*")) == 6
    put(path, "notes.txt", "kept")
    tfrecord.write_tfrecord(rows.where("idx < 2"), path, 5, mode="overwrite")
    assert len(glob.glob(f"{path}/part-*")) == 5 and os.path.exists(f"{path}/notes.txt")
    tfrecord.write_tfrecord(rows, str(tmp_path / "u"), 2)
    assert tfrecord.read_tfrecord(spark, f"{path}/part-*,{tmp_path}/u", 16, 3).count() == 22
    assert tfrecord.read_tfrecord(spark, [f"{path}/part-0000[01]*"], 16, 3).count() == 2
    with pytest.raises(ValueError):
        tfrecord.read_tfrecord(spark, f"{tmp_path}/none*", 16, 3)


def test_failed_overwrite_keeps_the_old_files(spark, tmp_path):
    rows, path = example_rows(spark, 20), str(tmp_path / "t")
    tfrecord.write_tfrecord(rows, path, 2)
    bad = rows.withColumn("input_ids", F.when(F.col("idx") == 7, F.raise_error(F.lit("bad row")).cast("array<int>")).otherwise(F.col("input_ids")))
    with pytest.raises(Exception, match="bad row"):
        tfrecord.write_tfrecord(bad, path, 2, mode="overwrite")
    assert tfrecord.read_tfrecord(spark, f"{path}/part-*", 16, 3).count() == 20


def test_generate_and_pick(spark, tmp_path):
    lines = "\n\n".join("\n".join(f"a b unaffable {w} x." for w in "abcdefgh"[: 3 + i % 5]) for i in range(30)) + "\n\n"
    docs = text.read_documents(spark, put(tmp_path, "t", lines)).select(F.col("article_no").cast("long").alias("doc_id"), "sentences")
    words = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]", "un", "##aff", "##able", "a", "b", "c", ".", "x"]
    vocab = text.read_vocab(spark, put(tmp_path, "v", "\n".join(words) + "\n"))
    made = pretraining.generate_examples(docs, vocab, PairSettings(max_seq=24, max_pred=4, dupe=2))
    n = made.count()
    assert sorted(r.idx for r in made.select("idx").collect()) == list(range(n)) and n > 60
    picked = pretraining.pick_evaluation_set(made, 10)
    pretraining.write_examples(picked, str(tmp_path / "eval"), 1)
    back = tfrecord.read_tfrecord(spark, str(tmp_path / "eval"), 24, 4)
    assert back.count() == 10
    assert [r.input_ids for r in back.collect()] == [r.input_ids for r in picked.orderBy("idx").collect()]


def test_feature_export(spark, tmp_path):
    pairs = text.read_pairs(spark, put(tmp_path, "p", "A unaffable ||| b\nb b\n"))
    words = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]", "un", "##aff", "##able", "a", "b"]
    feats = feature_export.pair_features(pairs, words, 12)
    rows = {r.unique_id: r for r in feats.collect()}
    assert rows[0].input_ids == [2, 8, 5, 6, 7, 3, 9, 3, 0, 0, 0, 0] and rows[0].input_type_ids == [0] * 6 + [1, 1] + [0] * 4
    assert rows[1].input_ids == [2, 9, 9, 3] + [0] * 8 and rows[1].input_mask == [1] * 4 + [0] * 8
    acts = feats.select("unique_id", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("pos")).withColumn(
        "layers", F.array(F.array(F.lit(0.5)), F.array(F.col("pos") * 1.0)))
    vocab = spark.createDataFrame(list(enumerate(words)), "token_id int, token string")
    feature_export.export_features(feats, acts, vocab, [-1], str(tmp_path / "out"))
    got = {r["linex_index"]: r for r in (json.loads(x.value) for x in spark.read.text(str(tmp_path / "out")).collect())}
    assert [f["token"] for f in got[0]["features"]] == ["[CLS]", "a", "un", "##aff", "##able", "[SEP]", "b", "[SEP]"]
    assert got[1]["features"][2]["layers"] == [{"index": -1, "values": [2.0]}]
    unknown = feats.withColumn("token_ids", F.array(F.lit(0), F.lit(len(words)), F.lit(1)))
    with pytest.raises(Exception, match="id not in vocabulary: 10"):
        feature_export.export_features(unknown, acts, vocab, [-1], str(tmp_path / "bad"))


def test_column_operators_run_on_a_stream(spark, tmp_path):
    from textforge.functions.markup import clean_markup
    from textforge.functions.normalize import basic_tokens

    (tmp_path / "s").mkdir()
    put(tmp_path / "s", "one", "[[x|Y]] <br>z!\n")
    stream = spark.readStream.text(str(tmp_path / "s")).select(basic_tokens(clean_markup(F.col("value"))).alias("t"))
    q = stream.writeStream.format("memory").queryName("cleaned").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("select * from cleaned").first()["t"] == ["y", "z", "!"]


def test_tfrecord_own_layout_is_read_without_a_walk_per_record(monkeypatch):
    rng = np.random.default_rng(3)
    kinds = {n: pa.float32() if n in tfrecord.FLOAT_FEATURES else pa.int32() for n in tfrecord.FEATURES}
    batch = pa.RecordBatch.from_pydict({n: pa.array((rng.integers(-2, 40_000, (60, 30)) * (rng.random((60, 30)) < 0.5)).tolist()
                                                    if str(k) == "int32" else rng.random((60, 30)).astype("float32").tolist(), pa.list_(k)) for n, k in kinds.items()})
    coded = tfrecord.encode_examples(batch)
    slow = {n: b"".join(r[n] for r in map(tfrecord._packed_features, coded)) for n in tfrecord.FEATURES}
    assert {n: raw.tobytes() for n, (raw, _) in tfrecord._same_layout(coded).items()} == slow
    assert tfrecord._same_layout([coded[0], coded[1][:-1]]) is None and tfrecord._same_layout([coded[0], b""]) is None
    monkeypatch.setattr(tfrecord, "_packed_features", None)
    assert tfrecord.decode_examples(coded, lambda n: 30, "x").equals(batch)


def test_tfrecord_gzip_files_hold_the_same_bytes(spark, tmp_path):
    rows = example_rows(spark, 50)
    for kind in ("none", "gzip"):
        tfrecord.write_tfrecord(rows.select("idx", F.struct(*tfrecord.FEATURES).alias("held")), str(tmp_path / kind), 3,
                                made=lambda dealt: dealt.select("file_no", "held.*"), compression=kind)
    plain, packed = (sorted(glob.glob(f"{tmp_path}/{kind}/part-*")) for kind in ("none", "gzip"))
    assert all(p.endswith(".gz") for p in packed) and [gzip.open(p).read() for p in packed] == [open(p, "rb").read() for p in plain]
    assert tfrecord.read_tfrecord(spark, str(tmp_path / "gzip"), 16, 3).count() == 50
    tfrecord.write_tfrecord(rows.where("idx < 1"), str(tmp_path / "gzip"), 2, mode="overwrite", compression="gzip")
    assert tfrecord.read_tfrecord(spark, str(tmp_path / "gzip"), 16, 3).count() == 1 and len(glob.glob(f"{tmp_path}/gzip/part-*")) == 2
    with pytest.raises(Exception, match="compression"):
        tfrecord.write_tfrecord(rows, str(tmp_path / "x"), 2, compression="lzo")
