import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textforge.functions import pairs
from textforge.functions.draws import key_text, order_key
from textforge.functions.normalize import sentence_words
from textforge.operators import batches, holdout, metrics, packing, runlog, tokenizing
from textforge.operators import vocab as V
from textforge.operators.examples import (PairSettings, assembled, chunk_ranges, create_examples, example_stats, instances, padded_examples, shuffle_examples,
                                          shuffled_examples, shuffled_pairs)
from textforge.operators.features import assemble_features, embedding_lookup, feature_records
from textforge.operators.headers import drop_doc_headers
from textforge.operators.ordering import block_of, carried, dense_index, value_cuts
from textforge.storage import materialize
from test_functions import HEADER_CASES, header_properties


def test_dense_index_is_a_permutation(spark):
    for n in (0, 1, 5000):
        rows = spark.range(n).withColumnRenamed("id", "k")
        got = dense_index(rows, ["k"], 7).collect()
        assert sorted(r.idx for r in got) == list(range(n))
    other = dense_index(rows, ["k"], 8).where("idx = 0").first()["k"]
    assert dense_index(rows.repartition(64), ["k"], 7).where("idx = 0").first()["k"] == dense_index(
        rows.coalesce(1).withColumn("payload", F.lit("x")), ["k"], 7).where("idx = 0").first()["k"] != other


def test_block_of(spark):
    rows = spark.range(1000).withColumn("v", F.expr("pmod(id * 7919, 1000) * pmod(id * 7919, 1000)"))
    cuts = value_cuts(rows, "v", rows_per_block=90)
    assert 8 <= len(cuts) <= 12
    for r in rows.withColumn("b", block_of(F.col("v"), cuts)).collect():
        assert r.b == sum(c <= r.v for c in cuts)
    sizes = rows.groupBy(block_of(F.col("v"), cuts).alias("b")).count().collect()
    assert max(r["count"] for r in sizes) < 200


@pytest.mark.parametrize("how, forward", [("max", True), ("min", False), ("sum", True), ("min", True), ("max", False)])
def test_carried_equals_one_window(spark, how, forward):
    rng = np.random.default_rng(3)
    data = [(int(g), i, int(rng.integers(0, 1000)) if rng.random() < 0.4 else None)
            for i, g in enumerate(rng.choice([0, 0, 0, 1, 2], 400))]
    rows = spark.createDataFrame(data, "g int, i int, v int")
    got = {(r.g, r.i): r.out for r in carried(rows, ["g"], F.floor(F.col("i") / 17), ["i"], F.col("v"), "out", how, forward).collect()}
    assert len(got) == len(data)
    for g, i, _ in data:
        seen = [v for h, j, v in data if h == g and v is not None and (j < i if forward else j > i)]
        want = {"max": max, "min": min, "sum": sum}[how](seen) if seen else (0 if how == "sum" else None)
        assert got[(g, i)] == want


def test_drop_doc_headers(spark):
    rng = np.random.default_rng(5)
    kinds = ["<doc a>", "<doc b>", "</doc>", "", "body"]
    files = {f: [kinds[i] for i in rng.integers(0, 5, 60)] for f in range(30)}
    files |= {100 + k: lines for k, (lines, _) in enumerate(HEADER_CASES)}
    rows = spark.createDataFrame([(f, i, x) for f, ls in files.items() for i, x in enumerate(ls)], "file int, line_no long, line string")
    for block in (4, 1000):
        got = {}
        for r in drop_doc_headers(rows, "file", block).orderBy("file", "line_no").collect():
            got.setdefault(r.file, []).append(r.line)
        for k, (_, want) in enumerate(HEADER_CASES):
            assert got.get(100 + k, []) == want
        for f in range(30):
            header_properties(files[f], got.get(f, []))


def test_quota_and_sample(spark):
    inventory = spark.range(4).withColumnRenamed("id", "file_id")
    quotas = holdout.stratified_quota(inventory, 10, 4)
    assert [r.quota for r in quotas.orderBy("file_id").collect()] == [2, 3, 2, 3]
    articles = spark.createDataFrame([(f, a) for f in range(4) for a in range(2 if f == 3 else 50)], "file_id long, article_no int")
    ids = holdout.sample_per_file(articles, quotas, 10, 4, 12345)
    counts = {r.file_id: r["count"] for r in ids.groupBy("file_id").count().collect()}
    assert counts == {0: 2, 1: 3, 2: 2, 3: 2}  # the last file has only two articles
    train, held = holdout.kept_for_training(articles, ids), holdout.held_out(articles, ids)
    assert train.count() + held.count() == articles.count() and train.intersect(held).count() == 0
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan  # the sample is a filter


def test_overlap_ignores_empty_texts(spark):
    corpus = spark.createDataFrame([(1, "a \n"), (2, ""), (3, "b")], "id int, text string")
    hashes = spark.createDataFrame([("a",), ("",), ("a",)], "t string").select(F.md5("t").alias("md5"))
    assert [r.id for r in holdout.held_out_overlap(corpus, hashes).collect()] == [1]
    assert sorted(r.id for r in holdout.held_out_overlap(corpus, hashes, anti=True).collect()) == [2, 3]


def next_fit(sizes, limit):
    pack, total, out = 0, None, []
    for s in sizes:
        if total is not None and total + s > limit:
            pack, total = pack + 1, 0
        total = (total or 0) + s
        out.append(pack)
    return out


def packs(spark, sizes_by_worker, limit, rows_per_block):
    rows = spark.createDataFrame([(w, i, s) for w, ss in sizes_by_worker.items() for i, s in enumerate(ss)], "w string, i long, s long")
    got = packing.pack_by_size(rows, limit, "w", "i", "s", rows_per_block).orderBy("w", "i").collect()
    return {w: [r.pack_no for r in got if r.w == w] for w in sizes_by_worker}


def test_pack_by_size(spark):
    assert packs(spark, {"a": [10, 15, 5, 30, 1]}, 30, 1000) == {"a": [0, 0, 0, 1, 2]}
    rng = np.random.default_rng(11)
    sizes = {"hot": rng.integers(0, 40, 700).tolist(), "b": rng.integers(0, 200, 90).tolist(), "c": [500, 0, 0, 500, 1],
             "d": [0, 0, 0], "e": [3] * 60}
    for block in (7, 50, 10_000):
        got = packs(spark, sizes, 100, block)
        assert got == {w: next_fit(ss, 100) for w, ss in sizes.items()}, block


def test_contiguous_groups_and_names(spark):
    got = spark.range(10).select(packing.contiguous_group(F.col("id"), 10, 4).alias("g")).collect()
    assert [r.g for r in got] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]
    name = spark.range(1).select(packing.pack_name(F.lit(3), F.lit(2), 500).alias("n")).first()["n"]
    assert name == "part-02003-of-00500"


def test_trim_newline(value):
    assert value(packing.trim_one_newline(F.col("t")), t="a\n\n") == "a\n"
    assert value(packing.trim_one_newline(F.col("t")), t="a\n") == "a\n"


@pytest.mark.parametrize("n, k, want", [(7, 3, [0, 2, 4]), (2, 4, [0, 0, 1, 1])])
def test_pick_even(spark, n, k, want):
    rows = spark.range(n).withColumnRenamed("id", "idx")
    assert [r.idx for r in packing.pick_even(rows, n, k).orderBy("pick_no").collect()] == want


def test_vocab(spark):
    lines = spark.createDataFrame([(i, x) for i, x in enumerate(["a", " b ", "a", "c"])], "line_no long, line string")
    assert V.vocab_list(V.vocab_from_lines(lines)) == ["a", "b", "c"]


VOCAB = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]", "un", "##aff", "##able", "a", "##b", "##bb", "b"]


@pytest.mark.parametrize("word, want", [
    ("unaffable", ["un", "##aff", "##able"]), ("abbb", ["a", "##bb", "##b"]), ("ax", ["[UNK]"]), ("a" * 201, ["[UNK]"]), ("b", ["b"])])
def test_wordpieces(spark, word, want):
    words = spark.createDataFrame([(word,)], "word string")
    vocab = spark.createDataFrame([(t,) for t in VOCAB], "token string")
    assert V.wordpieces(words, VOCAB).first()["pieces"] == want
    assert V.wordpiece_by_join(words, vocab, 6).first()["pieces"] == want


def test_encode_sentences(spark):
    docs = [(1, [["unaffable", "a"], ["b"]]), (2, []), (3, [["ax"], []])]
    rows = spark.createDataFrame(docs, "doc_id int, words array<array<string>>").coalesce(1)
    got = {r.doc_id: (r.ids, r.ends) for r in V.encode_sentences(rows, "words", VOCAB).collect()}
    assert got == {1: ([5, 6, 7, 8, 11], [4, 5]), 2: ([], []), 3: ([1], [1, 1])}


def test_lookup_errors(spark):
    vocab = spark.createDataFrame(list(enumerate(VOCAB)), "token_id int, token string")
    good = spark.createDataFrame([("a",), ("b",)], "token string")
    assert sorted(r.token_id for r in V.tokens_to_ids(good, vocab).collect()) == [8, 11]
    with pytest.raises(Exception, match="not in vocabulary"):
        V.tokens_to_ids(spark.createDataFrame([("zz",)], "token string"), vocab).collect()
    with pytest.raises(Exception, match="not in vocabulary"):
        V.ids_to_tokens(spark.createDataFrame([(99,)], "token_id int"), vocab).collect()


def test_chunk_ranges_cover_the_document():
    rng = np.random.default_rng(2)
    shares = []
    for doc in range(200):
        lens = rng.integers(1, 30, rng.integers(1, 40)).tolist()
        at = 0
        for no, first, last, a_end, is_random, a_at, a_len, next_len in chunk_ranges(np.cumsum(lens), 61, 1, doc, 0):
            assert first == at and first < a_end <= last and a_at == sum(lens[:first]) and a_len == sum(lens[first:a_end])
            assert next_len == sum(lens[a_end:last])
            assert last == len(lens) or sum(lens[first:last]) >= 61
            assert sum(lens[first:last - 1]) < 61
            assert is_random or a_end < last
            shares.append(is_random)
            at = a_end if is_random else last
        assert at == len(lens)
    assert 0.4 < np.mean(shares) < 0.8


def corpus(spark, n, parts=4):
    rng = np.random.default_rng(9)
    docs = []
    for d in range(n):
        lens = rng.integers(1, 25, rng.integers(1, 20)).tolist()
        docs.append((d, (rng.integers(5, 500, sum(lens))).tolist(), np.cumsum(lens).tolist()))
    return spark.createDataFrame(docs, "doc_id long, ids array<int>, ends array<int>").repartition(parts)


S = PairSettings(max_seq=32, max_pred=5, dupe=2, vocab_size=500)


def test_examples_have_fixed_shape(spark):
    docs = corpus(spark, 60)
    rows = create_examples(docs, S).collect()
    lengths = {r.doc_id: r.ends[-1] for r in docs.collect()}
    assert {r.doc_id for r in rows} == set(lengths)
    assert {r.dupe for r in rows} == {0, 1}
    for r in rows:
        assert len(r.input_ids) == len(r.input_mask) == len(r.segment_ids) == 32
        assert len(r.masked_lm_positions) == len(r.masked_lm_ids) == len(r.masked_lm_weights) == 5
        used = sum(r.input_mask)
        assert r.input_mask == [1] * used + [0] * (32 - used) and not any(r.input_ids[used:])
        assert r.input_ids[0] == 2 and r.input_ids[used - 1] == 3
        n = int(sum(r.masked_lm_weights))
        assert n == min(5, max(1, round(used * 0.15)))
        assert all(0 <= t < 500 for t in r.input_ids)
        assert r.next_sentence_labels in ([0], [1])


def test_examples_do_not_depend_on_partitions(spark):
    def digest(parts):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            e = shuffle_examples(create_examples(corpus(spark, 40, parts), S), 5)
            return sorted((r.idx, tuple(r.input_ids), tuple(r.masked_lm_ids), r.next_sentence_labels[0]) for r in e.collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)

    one = digest(1)
    assert one == digest(7) == digest(64)


def test_single_document_is_its_own_partner(spark):
    assert create_examples(corpus(spark, 1), S).count() > 0


def test_batches(spark):
    rows = spark.range(10).withColumnRenamed("id", "idx").withColumn("x", F.col("idx") * 2)
    full = batches.make_batches(rows, 4, ["x"], 10).orderBy("batch_id").collect()
    assert [[x.x for x in b.rows] for b in full] == [[0, 2, 4, 6], [8, 10, 12, 14]]
    assert batches.make_batches(rows, 4, ["x"]).count() == 3
    assert batches.per_replica(12, 4) == 3
    with pytest.raises(ValueError, match="use 8"):
        batches.per_replica(10, 4)
    again = batches.repeat_to(rows.where("idx < 3"), 3, 2, 4).orderBy("row_no").collect()
    assert [(r.row_no, r.idx) for r in again] == [(i, i % 3) for i in range(8)]
    assert [r.idx for r in batches.take_first(rows, 2).orderBy("idx").collect()] == [0, 1]
    first, second = (batches.epoch_shuffle(rows.drop("idx"), ["x"], 1, e).orderBy("idx").collect() for e in (0, 1))
    assert [r.x for r in first] != [r.x for r in second]


def test_metrics(spark):
    rows = spark.createDataFrame([(1, 1, 1.0), (2, 0, 1.0), (3, 3, 0.0)], "pred int, label int, w double")
    assert rows.agg(metrics.accuracy(F.col("pred"), F.col("label"), F.col("w")).alias("a")).first()["a"] == 0.5
    assert rows.agg(metrics.accuracy(F.col("pred"), F.col("label"), F.lit(0.0)).alias("a")).first()["a"] == 0
    losses = spark.createDataFrame([(2.0, 1.0), (4.0, 0.0)], "l double, w double")
    assert np.isclose(losses.agg(metrics.batch_loss(F.col("l"), F.col("w")).alias("a")).first()["a"], 2 / 1.00001)


def test_run_log(spark):
    saves = spark.createDataFrame([(1, 600), (1, 1200)], "run_id int, step int")
    got = runlog.block_steps(saves, ["run_id"], "step", F.floor(F.col("step") / 1000)).orderBy("step").collect()
    assert [(r.first_step, r.step_count) for r in got] == [(1, 600), (601, 600)]
    want = {256: 150000, 1024: 150000, 1536: 150000, 2048: 150000, 3072: 175000, 4096: 175000, 8192: 225000}
    rows = spark.createDataFrame([(b,) for b in want], "b long").select("b", runlog.eval_interval(F.col("b")).alias("e"))
    assert {r.b: r.e for r in rows.collect()} == want


def test_features(spark):
    rows = spark.createDataFrame(
        [(1, "is this jack ##son ##ville ?".split(), "no it is not .".split()), (2, "the dog is hairy .".split(), None),
         (3, list("abcdefghij"), list("wxyz"))], "unique_id int, a array<string>, b array<string>")
    got = {r.unique_id: (r.tokens, r.segment_ids) for r in assemble_features(rows, 20, "[CLS]", "[SEP]").collect()}
    assert got[1] == ("[CLS] is this jack ##son ##ville ? [SEP] no it is not . [SEP]".split(), [0] * 8 + [1] * 6)
    assert got[2] == ("[CLS] the dog is hairy . [SEP]".split(), [0] * 7)
    short = {r.unique_id: r.tokens for r in assemble_features(rows, 12, "[CLS]", "[SEP]").collect()}
    assert short[3] == "[CLS] a b c d e [SEP] w x y z [SEP]".split()
    table = spark.createDataFrame([(i, [float(i), -float(i)]) for i in range(4)], "id long, vector array<double>")
    ids = spark.createDataFrame([(7, [3, 0, 3])], "k int, ids array<long>")
    assert embedding_lookup(ids, table, "k").first()["vectors"] == [[3, -3], [0, 0], [3, -3]]
    empty = spark.createDataFrame([(7, []), (8, [1])], "k int, ids array<long>")
    assert {r.k: r.vectors for r in embedding_lookup(empty, table, "k").collect()} == {7: [], 8: [[1, -1]]}
    with pytest.raises(Exception, match="no vector for id 9"):
        embedding_lookup(spark.createDataFrame([(7, [3, 9])], "k int, ids array<long>"), table, "k").collect()
    acts = spark.createDataFrame([(2, i, [[i + 0.12345678], [0.5], [2.0], [i * 1.0]]) for i in range(9)],
                                 "unique_id int, pos int, layers array<array<double>>")
    feats = assemble_features(rows, 20, "[CLS]", "[SEP]").select("unique_id", "tokens").where("unique_id = 2")
    record = feature_records(feats, acts, [-1, 0]).first()
    assert record.linex_index == 2 and [f.token for f in record.features] == got[2][0]
    assert record.features[3]["layers"][0]["values"] == [3.0] and record.features[3]["layers"][1]["values"] == [3.123457]
    assert [x["index"] for x in record.features[0]["layers"]] == [-1, 0]
    with pytest.raises(Exception, match="no activations for 2 4"):
        feature_records(feats, acts.where("pos <> 4"), [-1, 0]).collect()


def test_sample_cuts_on_a_hot_file(spark):
    sizes = {0: 3000, 1: 1, 2: 40, 3: 7, 4: 0}
    rows = spark.createDataFrame([(f, i) for f, n in sizes.items() for i in range(n)], "file_id long, article_no long")
    quotas = spark.createDataFrame([(0, 1234), (1, 1), (2, 13), (3, 50), (4, 2), (5, 0)], "file_id long, quota long")
    ranked = rows.withColumn("h", order_key(9, "file_id", "article_no")).collect()
    want = set()
    for f, q in ((0, 1234), (1, 1), (2, 13), (3, 7)):
        want |= {(r.file_id, r.article_no) for r in sorted((r for r in ranked if r.file_id == f), key=lambda r: r.h)[:q]}
    for digits, open_rows in ((1, 1), (1, 20), (3, 10_000), (2, 1)):
        got = holdout.sample_per_file(rows, quotas, 1300, 6, 9, open_rows=open_rows, digits=digits).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_sequential_sample_draws_as_one_generator_per_file(spark):
    rows = spark.createDataFrame([(f, i) for f, n in ((0, 30), (1, 4), (2, 9)) for i in range(n)], "file_id long, article_no long")
    quotas = spark.createDataFrame([(0, 5), (1, 9), (2, 0)], "file_id long, quota long")
    got = {}
    for r in holdout.sample_sequential(rows, quotas, 12345).collect():
        got.setdefault(r.file_id, set()).add(r.article_no)
    generator, want = random.Random(12345), []
    while len(want) < 5:
        number = int(generator.random() * 30)
        if number not in want:
            want.append(number)
    assert got == {0: set(want), 1: {0, 1, 2, 3}}


MIXED = list(" \n\t\r\x0b\x0c\x85.!?\"')](ABabΣ́ͅ­ 　İ一É﷑012") + ["Mr.", "etc.", " A", "Α", "각", "\U00020000", "\U0001f600", "क़", "יִ"]


def test_texts_are_tokenized_as_by_the_column_rules(spark):
    r = random.Random(3)
    texts = ["".join(r.choice(MIXED) for _ in range(r.randrange(40))) for _ in range(3000)] + [None, "", "x" * 300]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, t string").repartition(3)
    marks = [c for c in sorted({c for t in texts if t for c in t.lower()}) if not c.isspace()]
    vocab = ["[UNK]", *marks[::2], *[f"##{c}" for c in marks], "ab", "mr", "##ba", "##b1"]
    words = rows.select("doc_id", sentence_words(F.col("t")).alias("words"))
    want = {r.doc_id: (r.ids, r.ends) for r in V.encode_sentences(words, "words", vocab).collect()}
    assert {r.doc_id: (r.ids, r.ends) for r in tokenizing.encode_texts(rows, "t", vocab).collect()} == want
    counts = words.select(F.explode(F.flatten("words")).alias("word")).groupBy("word").count()
    assert sorted(map(tuple, tokenizing.word_counts(rows, "t").collect())) == sorted(map(tuple, counts.collect()))


def test_encoding_a_word_tries_no_more_ends_than_the_vocabulary_has():
    class Counted(str):
        slices = 0

        def __getitem__(self, at):
            Counted.slices += 1
            return str(self)[at]

    assert V.word_encoder(["[UNK]", "a", "##a", "##aa"])(Counted("a" * 200)) == [1] + [3] * 99 + [2]
    assert Counted.slices <= 2 * 200


def test_frequent_tokens_are_looked_up_without_an_exchange_of_the_rows(spark):
    vocab = spark.range(50).selectExpr("concat('t', id) AS token", "CAST(id AS INT) AS token_id").repartition(2)
    rows = spark.range(100).selectExpr("id", "IF(id < 90, 't1', 't2') AS token", "CAST(id % 3 AS INT) AS token_id")
    for found in (V.tokens_to_ids(rows.drop("token_id"), vocab), V.ids_to_tokens(rows.drop("token"), vocab)):
        assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 100


def test_pieces_by_join_look_up_existing_lengths_only(spark):
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate(["[UNK]", "abcde", "a", "##b", "##a", "b"])], "token string, token_id int")
    words = spark.createDataFrame([(w,) for w in ("abcde", "abab", "ba", "abc", "")], "word string")
    found = V.wordpiece_by_join(words, vocab, 5)
    assert {r.word: r.pieces for r in found.collect()} == {"abcde": ["abcde"], "abab": ["a", "##b", "##a", "##b"], "ba": ["b", "##a"],
                                                           "abc": ["[UNK]"], "": []}
    assert "sequence(1, least(" not in found._jdf.queryExecution().analyzed().toString()


def test_chunks_are_planned_on_plain_numbers(monkeypatch):
    ends = np.cumsum(np.arange(1, 60) % 9 + 1).astype(np.int32)
    monkeypatch.setattr(np, "searchsorted", None)  # an array call per chunk was most of the planning
    chunks = chunk_ranges(ends, 30, 7, 1, 0)
    total = [0, *ends.tolist()]
    for no, first, last, a_end, _, a_at, a_len, next_len in chunks:
        assert total[last] - total[first] >= 30 or last == len(ends)
        assert last - first == 1 or total[last - 1] - total[first] < 30
        assert (a_at, a_len, next_len) == (total[first], total[a_end] - total[first], total[last] - total[a_end])


def test_instances_equal_the_column_forms_and_queue_no_source_arrays(spark):
    rng = random.Random(5)
    rows = []
    for k in range(400):
        a, b = ([rng.randrange(2, 40) for _ in range(n)] for n in (rng.choice((0, 1, 5, 20, 90)), rng.choice((0, 1, 6, 25, 120))))
        rows.append((k if k % 9 else None, k % 2, k, k % 3 == 0, a, b))
    docs = spark.createDataFrame(rows, "doc_id long, dupe int, chunk_no int, is_random boolean, ids array<int>, b array<int>")
    found = docs.select("doc_id", "dupe", "chunk_no", "is_random", F.slice("ids", 1, 80).alias("a"), "b")
    s = PairSettings(max_seq=24, max_pred=4, dupe=2, vocab_size=40)
    key = key_text(F.lit(s.seed), "doc_id", "dupe", "chunk_no", F.lit("mask"))
    whole = assembled(found, s)
    columns = whole.withColumn("_m", pairs.mask_ids(F.col("original"), s.cls, s.sep, key, s.mask_prob, s.max_pred, s.mask, s.vocab_size)).select(
        "doc_id", "dupe", "chunk_no", "is_random", "segment_ids", "_m.*")
    got = instances(found, s)
    assert sorted(map(str, got.collect())) == sorted(map(str, columns.collect()))
    assert "ArrowEvalPython" not in got._jdf.queryExecution().executedPlan().toString()


def test_joined_tokens_equal_the_literal_table(spark):
    words = ["[PAD]", "a", "##b", "é", ""]
    rows = spark.createDataFrame([(1, [1, 2, 4, 3]), (2, []), (None, [0]), (2, [2] * 3000)], "doc_id long, ids array<int>")
    want = rows.select("doc_id", F.array_join(V.id_tokens(F.col("ids"), words), " ").alias("tokens"))
    got = V.joined_tokens(rows, "ids", words)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_words_are_split_once_per_token(spark, monkeypatch):
    rows = spark.createDataFrame([("it's fine.",)] * 500 + [("x, it's",), (None,)], "t string").coalesce(1)
    calls = spark.sparkContext.accumulator(0)
    split = tokenizing.word_splitter

    def counting(table):
        words = split(table)

        def run(token):
            calls.add(1)
            return words(token)

        return run

    monkeypatch.setattr(tokenizing, "word_splitter", counting)
    monkeypatch.setattr(tokenizing, "COUNTED", 10)
    got = {r.word: r["count"] for r in tokenizing.word_counts(rows, "t").collect()}
    assert got == {"it": 501, "'": 501, "s": 501, "fine": 500, ".": 500, "x": 1, ",": 1}
    assert calls.value <= 4  # the empty text is a token, too


def test_example_stats_count_distinct_tokens(spark):
    rows = [(None, [2, 7, 7, 3, 0], [1, 1, 1, 1, 0], [1.0, 0.0], [0]), (None, [2, 9, 3, 0, 0], [1, 1, 1, 0, 0], [1.0, 1.0], [1]), (1, [2, 0, 3, 5, 0], [1, 1, 1, 1, 0], [0.0, 0.0], [1])]
    made = spark.createDataFrame(rows, "g int, input_ids array<int>, input_mask array<int>, masked_lm_weights array<float>, next_sentence_labels array<int>")
    got = {r.g: r for r in example_stats(made, ["g"]).collect()}
    assert {g: (r.instances, r.distinct_tokens, r.random_share) for g, r in got.items()} == {None: (2, 4, 0.5), 1: (1, 4, 1.0)}
    assert got[None].padding_share == pytest.approx(0.3) and got[None].masked_share == pytest.approx(3 / 7)
    whole = example_stats(made, []).first()
    assert (whole.instances, whole.distinct_tokens) == (3, 6)
    assert example_stats(made.limit(0), []).first().instances == 0


@pytest.mark.parametrize("odd", [False, True])
def test_pairs_are_numbered_like_examples(spark, odd):
    docs = corpus(spark, 30)
    if odd:  # a doc_id that repeats, and one that is null
        docs = docs.unionByName(docs.where("doc_id < 2")).unionByName(docs.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType)))
    docs = materialize(docs)
    digest = ["doc_id", "dupe", "chunk_no", "next_sentence_labels", "input_ids", "masked_lm_positions", "masked_lm_ids"]
    want = shuffled_examples(docs, S)
    found = padded_examples(shuffled_pairs(docs, S), S, "idx")
    if odd:
        want, found = want.drop("idx"), found.drop("idx")
    columns = [c for c in [*digest, "idx"] if c in want.columns]
    assert sorted(str(tuple(r)) for r in found.select(*columns).collect()) == sorted(str(tuple(r)) for r in want.select(*columns).collect())
    if not odd:
        assert sorted(r.idx for r in found.select("idx").collect()) == list(range(found.count()))


def test_pieces_by_join_only_join_the_vocabulary(spark):
    words = spark.createDataFrame([("ab",), ("ab",), ("q",), ("",), (None,), ("a" * 9,), ("\0ab",), ("abz",)], "word string")
    vocab = spark.createDataFrame([("ab", 0), ("a", 1), ("##a", 2), ("##b", 3), ("\0ab", 4), ("[UNK]", 5), ("\0\0ab", 6)], "token string, token_id int")
    found = V.wordpiece_by_join(words, vocab, 5, max_chars=8)
    assert {r.word: r.pieces for r in found.collect()} == {
        "ab": ["ab"], "q": ["[UNK]"], "": [], None: ["[UNK]"], "a" * 9: ["[UNK]"], "\0ab": ["\0ab"], "abz": ["[UNK]"]}
    assert found.count() == 7
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
