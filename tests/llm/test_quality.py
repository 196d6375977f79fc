import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from textforge.llm import quality

DOCS = "doc_id long, text string, lang string, good boolean, key double"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(6)
    words = [f"w{k}" for k in range(300)]
    rows, kinds = [], {}
    for k in range(900):
        text = draw.choices(words, k=draw.randrange(20, 200))
        kind = draw.choices(("good", "toxic", "junk"), (8, 1, 1))[0]
        if kind == "toxic":
            for _ in range(3):
                text.insert(draw.randrange(len(text)), draw.choice(("vile", "nasty")))
        if kind == "junk":
            text = [f"{w} |" for w in text]
        kinds[k] = kind
        rows.append((k, " ".join(text), "en", None, 1.0))
    labels = [(k, int(kinds[k] != "junk"), int(kinds[k] == "toxic")) for k in range(0, 900, 2)]
    return rows, labels, kinds


def test_held_out_accuracy(spark, corpus):
    rows, labels, kinds = corpus
    kept = {r.doc_id for r in quality.sampled_documents(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    unseen = [k for k in kinds if k % 2]
    for kind, least in (("good", 0.97), ("toxic", 0.0), ("junk", 0.0)):
        of = [k in kept for k in unseen if kinds[k] == kind]
        assert sum(of) / len(of) >= least and (kind == "good" or sum(of) / len(of) <= 0.05)


def test_kept_rows_have_all_columns_and_agree(spark, corpus):
    rows, labels, _ = corpus
    rows = rows + [(None, None, "x", True, None), (5000, None, None, None, None), (5001, "", "y", False, 2.0), rows[0], (5002, "w1 w2 " * 40_000, "z", None, 0.0)]
    df, named = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels + [labels[0], (None, 1, 0), (7, None, 0)], LABELS)
    kept = quality.keep_sampled(df, named)
    assert kept.schema == df.schema
    listed = quality.sampled_documents(df, named).collect()
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in listed)
    assert {None, 5000, 5001, 5002} <= {r.doc_id for r in listed}


def test_without_labels_or_documents(spark, corpus):
    rows, labels, _ = corpus
    df, none = spark.createDataFrame(rows[:20], DOCS), spark.createDataFrame([], LABELS)
    assert quality.keep_sampled(df, none).count() == 20
    assert quality.keep_sampled(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS)).count() == 0


def test_kth_largest(spark):
    draw = random.Random(2)
    values = [draw.gauss(0, 1) for _ in range(500)] + [0.25] * 100 + [1e9, -1e9]
    df = spark.createDataFrame([(v,) for v in values], "key double").cache()
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 100, 300, 601, 602):
        assert quality.kth_largest(df, k, bins=16) == ordered[k - 1]


M64 = (1 << 64) - 1


def mixed(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> shift)) * factor) & M64
    return x ^ (x >> 31)


def plain_features(text, s):
    runs = [w.lower() for w in re.findall(r"\w+|[^\w\s]+", text)]
    hashed = [xxhash.xxh3_64_intdigest(w, s.seed) for w in runs]
    found = {h % s.word_buckets for h in hashed}
    for a, b in zip(hashed, hashed[1:]):
        found.add(s.word_buckets + mixed((a * 0x9E3779B97F4A7C15 + b) & M64) % s.pair_buckets)
    if any(all(hashed[i + j] == hashed[i + j + 2] for j in range(4)) for i in range(len(hashed) - 5)):
        found.add(s.size - 1)
    return found


def plain_ratio(raw, target, rate, s):
    a, b, c = s.strength * rate, s.strength * (1 - rate), s.strength
    beta = lambda x, y: math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y)
    own = s.differs * math.exp(beta(target + a, raw - target + b) - beta(a, b))
    common = (1 - s.differs) * rate**target * (1 - rate) ** (raw - target)
    return own / (own + common) * math.log((target + a) / (raw + c) / rate)


@pytest.mark.parametrize("share", [None, 0.5])
def test_models_weights_and_draw(spark, corpus, share):
    """Counts, ratios, weights, noise and the draw, each document by itself."""
    s = quality.QualitySettings(word_buckets=512, pair_buckets=256, share=share)
    rows, labels, _ = corpus
    rows = rows[:300] + [(300, "", "en", None, 0.0), (301, "a b " * 9, "en", None, 0.0), (302, None, None, None, None)]
    good = {k for k, q, t in labels if q and not t}
    features = [plain_features(r[1] or "", s) for r in rows]
    raw, target = Counter(f for fs in features for f in fs), Counter(f for r, fs in zip(rows, features) if r[0] in good for f in fs)
    rate = sum(r[0] in good for r in rows) / len(rows)
    expected = {}
    for r, fs in zip(rows, features):
        own = r[0] in good
        weight = sum(plain_ratio(raw[f] - 1, min(max(target[f] - own, 0), raw[f] - 1), rate, s) for f in fs)
        noise = ((mixed((xxhash.xxh3_64_intdigest(r[1] or "", s.seed) + mixed(r[0] + s.seed)) & M64) >> 11) / (1 << 53)) + 2.0**-54
        expected[r[0]] = (weight, weight - math.log(-math.log(noise)))
    keys = sorted((key for k, (_, key) in expected.items() if share or k in good), reverse=True)
    last = keys[round(share * len(rows)) - 1 if share else math.ceil(s.recall * len(keys)) - 1]
    found = {r.doc_id: r for r in quality.sampled_documents(spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(labels, LABELS), s).collect()}
    assert set(found) == {k for k, (_, key) in expected.items() if key >= last}
    for k, r in found.items():
        assert (r.log_weight, r.key) == pytest.approx(expected[k], rel=1e-4, abs=1e-3)
    plain = sorted(expected, key=lambda k: -expected[k][0])[: len(found)]
    assert set(plain) != set(found)  # noise decides some


def test_ratios_of_chance_are_small():
    s = quality.QualitySettings()
    raw, target = np.array([0, 1, 10, 1000, 1000, 1000]), np.array([0, 0, 3, 300, 0, 900])
    r = quality.log_ratios(raw, target, 0.3, s)
    assert np.all(np.abs(r[:4]) < 0.01) and r[4] < -5 and r[5] > 1


def test_null_ids_are_not_labelled():
    sample = quality.Sample(np.array([0, 7]))
    assert sample.holds(pa.array([7, None, 3, 0])).tolist() == [True, False, False, True]


def test_counts_are_sent_in_parts_and_freed_memory_is_released(corpus, monkeypatch):
    rows, _, _ = corpus
    batch = pa.RecordBatch.from_pydict({"id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    s, released = quality.QualitySettings(), []
    sample = quality.Sample(np.arange(0, 900, 2))
    whole = pa.Table.from_batches(quality._counted(sample, s)([batch])).to_pydict()
    monkeypatch.setattr(quality, "SENT", 1000)
    monkeypatch.setattr(quality.arrays, "release", lambda: released.append(1))
    parts = list(quality._counted(sample, s)([batch]))
    assert pa.Table.from_batches(parts).to_pydict() == whole and len(parts) > 1 and max(p.num_rows for p in parts) <= 1000 and released
