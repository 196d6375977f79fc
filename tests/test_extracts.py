"""Articles of extract files, read whole and in parts of a few bytes."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textforge.plans import corpus
from textforge.sources import extracts, text
from textforge.sources.extracts import article_cuts, output_lines

LINES = ["<doc id=1>", "<doc", "Title", "", "x", "</doc>", "One. Two! \"Three\"", "[[Category:Q]]", "<br>", "  ", " <br> ", "[[a|b]] z", "Mr. X. Y", "é ", "﷐",
         "﷑a. B", "﷓", "a</doc>b", "<doc a></doc>", "\x85", "<ref>q</ref>", "tail "]


def reader(body, fragment):
    """A sequential reader of an extract whose lines are cleaned and cut by the columns under test: line rules only."""
    skip, out = False, []
    for line in body:
        if skip:
            skip = False
        elif "<doc" in line:
            skip = True
            out.append("\n")
        elif "</doc>" not in line and len(line) != 1:
            out.append(line)
    return out


def write(folder, bodies):
    folder.mkdir(exist_ok=True)
    for k, body in enumerate(bodies):
        with open(folder / f"wiki_{k:03d}", "wb") as f:
            f.write(body.encode())
    return f"{folder}/wiki_*"


def random_bodies(seed, n):
    draw = random.Random(seed)
    out = []
    for k in range(n):
        ends = ["\n"] * 8 + (["\r\n", "\r"] if k % 3 == 0 else [])
        body = "".join(draw.choice(LINES) + draw.choice(ends) for _ in range(draw.randint(0, 40)))
        if draw.random() < 0.5:
            body += draw.choice(["x", "</doc>", "", "y z.", "<doc a>", "\r", "é", "﷐"])
        out.append(("﻿" if k % 7 == 3 else "") + body)
    return out


def small_splits(spark, monkeypatch, size, fn):
    """fn() while text files are scanned in splits of a few bytes; tables stored from that scan are read as usual."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    stored = extracts.materialize

    def restore():
        for k, v in old.items():
            spark.conf.set(k, v)

    def first(df):
        for k, v in zip(old, (size, 1)):
            spark.conf.set(k, str(v))
        found = stored(df)
        restore()
        monkeypatch.setattr(extracts, "materialize", stored)
        return found

    monkeypatch.setattr(extracts, "materialize", first)
    try:
        return fn()
    finally:
        restore()


def rows(df):
    return sorted(tuple(r) for r in df.select("file_id", "article_no", "text").collect())


@pytest.mark.parametrize("fragment", [True, False])
@pytest.mark.parametrize("split", [17, 60])
def test_parts_equal_whole_files(spark, tmp_path, monkeypatch, fragment, split):
    path = write(tmp_path / "in", [*random_bodies(split, 10), "", "x", "\n", "<doc a>\nT", "a\n\n\n<doc b>\n<doc c>\nq"])
    whole = rows(corpus.corpus_articles(spark, path, corpus.CorpusSettings(fragment_on_blank=fragment)))
    s = corpus.CorpusSettings(fragment_on_blank=fragment, whole_file_bytes=0, segment_bytes=30)
    parts = small_splits(spark, monkeypatch, split, lambda: rows(corpus.corpus_articles(spark, path, s)))
    assert len(whole) > 30 and len({r[0] for r in whole}) == 14
    assert parts == whole


def test_whole_files_follow_the_sequential_reader(spark, tmp_path, value):
    import io

    bodies = random_bodies(5, 20)
    path = write(tmp_path / "in", bodies)
    got = {}
    for f, no, t in rows(corpus.corpus_articles(spark, path, corpus.CorpusSettings())):
        got.setdefault(f, []).append(t)
    from textforge.functions import markup
    from textforge.functions.sentences import split_sentences

    every = sorted({line.rstrip("\n") for b in bodies for line in reader(io.StringIO(b.removeprefix("﻿"), newline=None), True)})
    df = spark.createDataFrame([(x,) for x in every], "line string")
    cleaned = {r.line: (r.keep, r.s) for r in df.select("line", markup.keeps_line(F.col("line")).alias("keep"),
                                                      split_sentences(markup.clean_markup(F.col("line"))).alias("s")).collect()}
    for k, body in enumerate(bodies):
        lines = []
        for line in reader(io.StringIO(body.removeprefix("﻿"), newline=None), True):
            keep, sentences = cleaned[line.rstrip("\n")]
            if keep:
                lines += sentences
        assert "\n\n".join(got[k]) == "".join(x + "\n" for x in lines) + "\n", k


def test_article_files_in_parts(spark, tmp_path, monkeypatch):
    draw = random.Random(8)
    bodies = ["".join(draw.choice(["a", "b\r", "\n", "\n", "\n\n", "é "]) for _ in range(draw.randint(1, 60))) for _ in range(8)]
    path = write(tmp_path / "in", bodies)
    want = sorted((k, no, t) for k, b in enumerate(bodies) if b for no, t in enumerate(b.split("\n\n")))

    def key(df):
        return sorted((int(r.path[-3:]), r.article_no, r.text) for r in df.collect())

    assert key(text.read_articles(spark, path)) == want
    assert small_splits(spark, monkeypatch, 5, lambda: key(text.read_articles(spark, path, whole_files=False))) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["h", "k", "", "d"]), max_size=14), st.integers(0, 14), st.integers(0, 3))
def test_parts_compose(kinds, cut, state):
    """Two parts, the second entered with the first one's exit, give the lines and articles of the whole."""
    header = np.array([k == "h" for k in kinds], bool)
    keep = np.array([k in ("k", "") for k in kinds], bool)
    body = pa.array(["t" if k == "k" else "" for k in kinds], pa.string())

    def run(a, b, state):
        lines, skip = output_lines(header[a:b], keep[a:b], body[a:b], state // 2) if b > a else (pa.array([], pa.string()), state // 2)
        cuts, pending = article_cuts(lines, state % 2)
        return lines.to_pylist(), cuts.tolist(), 2 * skip + pending

    cut = min(cut, len(kinds))
    one, two = run(0, cut, state), None
    two = run(cut, len(kinds), one[2])
    assert (one[0] + two[0], one[1] + two[1], two[2]) == run(0, len(kinds), state)


def test_segments_do_not_depend_on_batches():
    lines = pa.RecordBatch.from_pydict({"path": ["p"] * 5 + ["q"], "start": [0, 0, 0, 9, 9, 0], "size": [20] * 5 + [3], "raw": [4] * 6, "open": [True] * 6,
                                        "single": [False] * 4 + [True, False], "header": [False] * 6, "keep": [True] * 6, "body": ["abc"] * 4 + ["x", "abc"]})
    run = extracts._segments(1 << 20)
    whole = [b.to_pylist()[0] for b in run(iter([lines]))]
    single = [b.to_pylist()[0] for b in run(iter([lines.slice(k, 1) for k in range(6)]))]
    assert whole == single and [(r["path"], r["start"], r["seg"], len(r["body"])) for r in whole] == [("p", 0, 0, 3), ("p", 9, 0, 1), ("p", 9, 1, 1), ("q", 0, 0, 1)]
