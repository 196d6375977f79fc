import random
import re

import numpy as np
import pyarrow as pa

from textforge.llm import divergence
from textforge.llm.divergence import AuditSettings, audit, merged_runs, pair_corrections, term_index

SCHEMA = "text string, lang string, source string, n long, term string, gid long, doc_id long"


def brute(rows, s=AuditSettings()):
    """(lang, source, part, item, value, rank) with every term of every pair."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
            for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = {}
        for _, _, ts in own:
            for t in set(ts):
                df[t] = df.get(t, 0) + 1
        kept = [t for t, n in df.items() if n >= s.least_docs]
        sources = sorted({d[1] for d in own})
        count = {src: {t: 0 for t in kept} for src in sources}
        for _, src, ts in own:
            for t in ts:
                if t in count[src]:
                    count[src][t] += 1
        total = {t: sum(count[src][t] for src in sources) for t in kept}

        def shares(of):
            volume = sum(of.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (n + 2) // volume for t, n in of.items()}

        p, q = {src: shares(count[src]) for src in sources}, shares(total)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for src in sources:
            pairs = [(-sum(f(p[src][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != src]
            words = [(-f(p[src][t], q[t]), t.encode()) for t in kept if count[src][t] and p[src][t] > q[t]]
            for part, found, top in (("pair", pairs, None), ("term", words, s.top)):
                out += [(lang, src, part, item.decode(), -x, r) for r, (x, item) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def run(spark, rows, s=AuditSettings(), parts=3):
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in audit(df, s).collect())


def corpus(seed, n):
    draw = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("x", "yy", "Z", "é", "ß")]
    rows = []
    for _ in range(n):
        lang, source = draw.choice(["en", "de", None]), draw.choice(["s1", "s2", "s3", "S4", "é", None])
        bias = (len(source or "") + ord((source or "0")[0])) % 20
        text = draw.choice([" ", "1", "-", "\n"]).join(draw.choice(words[: 20 + bias]) for _ in range(draw.randint(0, 30)))
        rows.append((text, lang, source))
    return rows


def test_equals_brute_force(spark):
    rows = corpus(1, 400)
    want = brute(rows)
    assert {r[2] for r in want} == {"pair", "term"}
    assert run(spark, rows) == want
    # Many small runs and flushed partial sums give the same.
    assert run(spark, rows, AuditSettings(memory_rows=20, chunk_bytes=300, pair_rows=8), 5) == want
    s = AuditSettings(least_docs=40, top=3)
    assert run(spark, rows, s) == brute(rows, s)


def test_edges(spark):
    rows = [(None, None, None), ("", "en", "a"), ("ABC abc Ábc", "en", "a"), ("123 !", "en", "b"), (None, "en", "c"), ("x" * 5000, "fr", "a"), ("abc", "en", "a"),
            ("abc", "en", "a"), ("@[`{\x7f", "xx", "q"), ("  z", "en", "b")]
    for least in (1, 2, 10):
        s = AuditSettings(least_docs=least)
        assert run(spark, rows, s) == brute(rows, s)
    assert run(spark, []) == []


def test_a_hot_source_and_one_common_term(spark):
    rows = [("the common words", "en", "hot")] * 500 + [(f"the w{chr(97 + i % 7)}", "en", f"s{i % 9}") for i in range(200)]
    assert run(spark, rows, AuditSettings(memory_rows=4, chunk_bytes=100), 4) == brute(rows)


def test_runs_merge_like_one_table(spark):
    draw = random.Random(4)
    entries = [(draw.choice("ab"), draw.choice(["", "é", "z", "zz"]), draw.choice("pqr"), draw.randint(1, 9), 1) for _ in range(200)]
    runs = []
    for k in range(5):
        part = {}
        for lang, term, source, n, df in entries[k::5]:
            have = part.get((lang, term, source), (0, 0))
            part[lang, term, source] = (have[0] + n, have[1] + df)
        rows = [(*key, *v) for key, v in sorted(part.items())]
        runs.append(pa.table(list(map(list, zip(*rows))), names=["lang", "term", "source", "n", "df"]))
    want = {}
    for lang, term, source, n, df in entries:
        have = want.get((lang, term, source), (0, 0))
        want[lang, term, source] = (have[0] + n, have[1] + df)
    got = merged_runs(runs).to_pylist()
    assert {(r["lang"], r["term"], r["source"]): (r["n"], r["df"]) for r in got} == want and len(got) == len(want)
    numbers = {}
    for r in got:
        numbers.setdefault((r["lang"], r["term"]), set()).add(r["number"])
    assert all(len(v) == 1 for v in numbers.values()) and [min(numbers[k]) for k in sorted(numbers)] == list(range(len(numbers)))


def test_corrections_meet_every_pair_of_a_list():
    list_of, group = np.array([1, 1, 1, 2, 3, 3]), np.array([4, 5, 9, 4, 4, 9])
    p, zero = np.array([10, 20, 30, 5, 6, 7]), np.array([2, 3, 4, 2, 2, 4])
    got = sorted((int(a), int(b)) for x, y, _ in pair_corrections(list_of, group, p, zero) for a, b in zip(x, y))
    assert got == [(4, 5), (4, 9), (4, 9), (5, 9)]


def test_index_counts_documents_once(spark):
    df = spark.createDataFrame([("a a b", "en", "x"), ("a", "en", "y"), ("B", "en", "x")], "text string, lang string, source string")
    got = sorted(tuple(r) for r in term_index(df, AuditSettings(least_docs=2)).select("term", "source", "n", "total").collect())
    assert got == [("", "x", 0, 0), ("", "y", 0, 0), ("a", "x", 2, 3), ("a", "y", 1, 3), ("b", "x", 2, 2)]


def test_shards_are_merged_in_windows(spark, monkeypatch):
    s = AuditSettings(least_docs=1, block_rows=4, merge_rows=60)
    draw = random.Random(8)
    runs = []
    for _ in range(6):
        keys = sorted({(draw.choice("ab"), draw.choice(["", "é", "z"]) + str(draw.randint(0, 300)), draw.choice("pq")) for _ in range(400)})
        runs.append(pa.table([*map(list, zip(*keys)), [1] * len(keys), [1] * len(keys)], names=["lang", "term", "source", "n", "df"]))
    blocks = pa.Table.from_batches([b for part in runs for b in divergence._spilled(part, 2, s.block_rows)]).sort_by([(c, "ascending") for c in ("shard", "lang", "term")])
    seen = []
    monkeypatch.setattr(divergence, "merged_runs", lambda held: seen.append(sum(t.num_rows for t in held)) or merged_runs(held))
    got = pa.Table.from_batches(divergence._merge(s)(blocks.to_batches(max_chunksize=7))).to_pylist()
    want = {}
    for part in runs:
        for r in part.to_pylist():
            want[r["lang"], r["term"], r["source"]] = want.get((r["lang"], r["term"], r["source"]), 0) + 1
    assert {(r["lang"], r["term"], r["source"]): r["n"] for r in got} == want and len(got) == len(want)
    assert len({r["term_no"] for r in got}) == len({k[:2] for k in want}) == sum(r["head"] for r in got) and {r["term_no"] >> 32 for r in got} == {0, 1}
    assert sum(seen) == sum(t.num_rows for t in runs) and max(seen) < 100
    rows = corpus(3, 200)
    assert run(spark, rows, AuditSettings(memory_rows=20, chunk_bytes=300, block_rows=2, merge_rows=3)) == brute(rows)
