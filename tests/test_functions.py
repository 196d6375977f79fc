import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from textforge.functions import markup, normalize, pairs, vectors
from textforge.functions.sentences import rstrip, split_sentences
from textforge.sources.text import document_sentences, split_articles, split_lines, split_pair

T = F.col("t")


@pytest.mark.parametrize("text, want", [
    ("[[z]]", "z"), ("[[File:a.jpg]]", "File:a.jpg"), ("[[x|y]]", "y"), ("[[File:a|thumb|cap]]", ""),
    ("a [w] b", "a w b"), ("alt=q", "q"), ("[[a|[[b]]]]", "b"), ("<chem>H2O</chem>", ">H2O"),
    ("k <section begin=a/>text<br/> z", "k  z"), ("<references/>", ""), ("<br/>", "<br/>"), ("<b<sup>r>", ""),
    ("<includeonly>x</includeonly>y", "y"), ("<graph>{a}</graph>", ""), ("<poem style=i>v</poem>", "v"),
    ("</doc>", "\r"), ("<div class=c>d</div style>", "d"), ("no markup", "no markup"),
])
def test_clean_markup(value, text, want):
    assert value(markup.clean_markup(T), t=text) == want


def test_rules_stay_inside_a_line(value):
    assert value(markup.clean_markup(T), t="<ref\na>\n[[x\ny]]") == "<ref\na>\n[[x\ny]]"


def test_line_filters(value):
    assert value(markup.keeps_line(T), t="a [[Category:Q]] b") is False
    assert value(markup.keeps_line(T), t="<doc id=1>") is False
    assert value(markup.keeps_line(T), t="a <doc id=1>") is True
    assert value(markup.drop_marked_lines(T), t="a\n<doc x>\nb\nc [[Category:Q]]") == "a\nb"
    assert value(markup.drop_marked_lines(T), t="[[Category:Q]]\nb\n") == "b\n"


# Lines of an extract and what stays of them, worked out by hand.
HEADER_CASES = [
    (["<doc a>", "Title", "", "body", "</doc>"], ["", "body"]),
    (["<doc a>", "<doc b>", "x"], ["", "x"]),
    (["<doc a>", "<doc b>", "<doc c>", "x", "y"], ["", "", "y"]),
    (["<doc a>", "</doc>", "</doc>", "body"], ["", "body"]),
    (["<doc a>", "", "", "body"], ["", "body"]),
    (["x <doc b>", "T", "x <doc b>"], ["", ""]),
    (["body", "", "</doc>", "T"], ["body", "T"]),
    (["</doc>", ""], []),
    (["<doc a>"], [""]),
]


def header_properties(lines, kept):
    """Headers left: half of each run of header lines, rounded up; what else stays is plain, in order."""
    runs, n = 0, 0
    for line in [*lines, ""]:
        n, runs = (n + 1, runs) if "<doc" in line else (0, runs + (n + 1) // 2)
    assert kept.count("") == runs and not any("</doc>" in x or "<doc" in x for x in kept)
    left = iter(lines)
    assert all(x in left for x in kept if x)


def test_strip_headers(value):
    for lines, want in HEADER_CASES:
        assert value(markup.strip_headers(T), t="".join(x + "\n" for x in lines)) == "".join(x + "\n" for x in want), lines
    rng = np.random.default_rng(1)
    kinds = ["<doc a>", "x <doc b>", "</doc>", "", "body", "Tail"]
    for _ in range(60):
        lines = [kinds[i] for i in rng.integers(0, len(kinds), rng.integers(1, 14))]
        got = value(markup.strip_headers(T), t="".join(x + "\n" for x in lines))
        assert got == "" or got.endswith("\n")
        header_properties(lines, got.split("\n")[:-1])
    assert value(markup.strip_headers(T), t="<doc a>\r\nT\r\n\r\nab\r\n") == "\nab\n"
    assert value(markup.strip_headers(T), t="ab\nc") == "ab\n"


def test_sentences(value):
    assert value(split_sentences(T), t="A b. C d! E? \"Q.\" X\nnext. lower Mr. X went. Yes") == [
        "A b.", "C d!", "E?", '"Q."', "X", "next. lower Mr. X went.", "Yes"]
    assert value(split_sentences(T), t="a\n\nb") == ["a", "", "b"]
    assert value(rstrip(T), t="a  \n\n") == "a"


def test_normalisation(value):
    assert value(normalize.clean_text(T), t="a\x00b‍c\td\x07e f�g") == "abc de fg"
    assert value(normalize.pad_cjk(T), t="ab一c") == "ab 一 c"
    assert value(normalize.lower_strip_accents(T), t="É") == "e"
    assert value(normalize.split_punct(T), t="a$b") == ["a", "$", "b"]
    assert value(normalize.split_punct(T), t="a€b") == ["a€b"]
    assert value(normalize.split_punct(T), t="«a»!!") == ["«", "a", "»", "!", "!"]
    assert value(normalize.whitespace_tokens(T), t=" a b c \n") == ["a", "b", "c"]
    assert value(normalize.strip_bom(T), t="﻿ab") == "ab"
    assert value(normalize.decode_utf8_ignore(F.unhex(F.lit("61FF62")))) == "ab"
    assert value(normalize.basic_tokens(T, unused=["[unused1]"]), t="A [unused1] [unused2]") == [
        "a", "[unused1]", "[", "unused2", "]"]
    assert value(normalize.basic_tokens(T, lower=False), t="Éa, b") == ["Éa", ",", "b"]
    assert value(normalize.sentence_words(T), t="A b. C!\n\n...") == [["a", "b", "."], ["c", "!"], [".", ".", "."]]


def test_accents_equal_canonical_decomposition(spark):
    chars = [chr(c) for c in range(0x20, 0x3100)] + [chr(c) for c in range(0xAC00, 0xD7A4, 7)] + [
        chr(c) for c in range(0xF900, 0xFB50)] + [chr(0x1D15E), chr(0x2F800)]
    chars = [c for c in chars if unicodedata.category(c) != "Cn"]
    rows = spark.createDataFrame([(f"x{c}y",) for c in chars], "t string").select(
        "t", normalize.strip_accents(T).alias("v"), T.rlike(r"\p{Mn}").alias("jvm_mark"))
    for r in rows.collect():
        # The JVM's Unicode tables are older: a few characters were added or reclassified since.
        if r.jvm_mark != (unicodedata.category(r.t[1]) == "Mn"):
            assert unicodedata.normalize("NFD", r.t) == r.t
            continue
        want = "".join(x for x in unicodedata.normalize("NFD", r.t) if unicodedata.category(x) != "Mn")
        assert r.v == want, (r.t, r.v, want)


def test_text_splits(value):
    assert value(split_articles(T), t="\nA1\nA2\n\nB1\n\n\nC1\n\n") == ["\nA1\nA2", "B1", "\nC1", ""]
    assert value(split_lines(T), t="a\r\nb\rc\n") == ["a", "b", "c"]
    assert value(document_sentences(T), t=" a \n\t\nb") == ["a", "b"]
    p = value(split_pair(T), t=" a ||| b ||| c ")
    assert (p.text_a, p.text_b) == ("a ||| b", "c")
    p = value(split_pair(T), t="alone")
    assert (p.text_a, p.text_b) == ("alone", None)


def longer_first(la, lb, m):
    while la + lb > m:
        if la > lb:
            la -= 1
        else:
            lb -= 1
    return la, lb


def test_truncation_lengths(spark):
    cases = [(a, b, m) for a in range(0, 12) for b in range(0, 12) for m in range(0, 16)]
    rows = spark.createDataFrame(cases, "a int, b int, m int").select(
        "a", "b", "m", pairs.truncate_ranges(F.col("a"), F.col("b"), F.col("m")).alias("t"),
        pairs.truncate_ranges(F.col("a"), F.col("b"), F.col("m"), F.concat_ws("|", "a", "b", "m")).alias("r"))
    for x in rows.collect():
        want = longer_first(x.a, x.b, x.m)
        assert (x.t.keep_a, x.t.keep_b) == want and (x.r.keep_a, x.r.keep_b) == want
        assert x.t.front_a == x.t.front_b == 0
        assert 0 <= x.r.front_a <= x.a - x.r.keep_a and 0 <= x.r.front_b <= x.b - x.r.keep_b


def test_truncation_takes_both_ends(spark):
    rows = spark.range(300).select(pairs.truncate_ranges(F.lit(100), F.lit(0), 40, F.col("id").cast("string")).alias("t"))
    front = [r.t.front_a for r in rows.collect()]
    assert 28 < np.mean(front) < 32 and len(set(front)) > 5


def test_assemble(value):
    a, b = F.array(F.lit("x"), F.lit("y")), F.array(F.lit("z"))
    assert value(pairs.assemble(a, b, "[CLS]", "[SEP]")) == ["[CLS]", "x", "y", "[SEP]", "z", "[SEP]"]
    assert value(pairs.segment_ids(a, b)) == [0, 0, 0, 0, 1, 1]
    none = F.lit(None).cast("array<string>")
    assert value(pairs.assemble(a, none, "[CLS]", "[SEP]")) == ["[CLS]", "x", "y", "[SEP]"]
    assert value(pairs.segment_ids(a, none)) == [0, 0, 0, 0]


@pytest.mark.parametrize("n, want", [(10, 2), (30, 4), (5, 1), (1, 1), (1000, 76)])
def test_prediction_count(value, n, want):
    assert value(pairs.prediction_count(F.lit(n), 0.15, 76)) == want


def test_masks(spark):
    rows = spark.range(400).select("id", F.concat(F.array(F.lit(2)), F.sequence(F.lit(10), F.lit(49)), F.array(F.lit(3))).alias("t"))
    key = F.col("id").cast("string")
    drawn = rows.withColumn("p", pairs.mask_positions(F.col("t"), 2, 3, key, 0.15, 20))
    out = drawn.select("t", "p", pairs.labels_at(F.col("t"), F.col("p")).alias("l"),
                       pairs.apply_masks(F.col("t"), F.col("p"), key, 4, 1000, lambda w: w + 2000).alias("m")).collect()
    kinds = {"mask": 0, "same": 0, "word": 0}
    hit = np.zeros(42)
    for r in out:
        assert len(r.p) == 6 and r.p == sorted(set(r.p)) and 0 not in r.p and 41 not in r.p
        assert r.l == [r.t[i] for i in r.p] and len(r.m) == len(r.t)
        assert all(r.m[i] == r.t[i] for i in range(42) if i not in r.p)
        for i in r.p:
            hit[i] += 1
            kinds["mask" if r.m[i] == 4 else "same" if r.m[i] == r.t[i] else "word"] += 1
    total = sum(kinds.values())
    assert 0.76 < kinds["mask"] / total < 0.84 and 0.07 < kinds["same"] / total < 0.13 and 0.07 < kinds["word"] / total < 0.13
    assert hit[1:41].min() > 30


def test_pad(value, spark):
    assert value(pairs.pad(F.array(F.lit(1), F.lit(2)), 4, 0)) == [1, 2, 0, 0]
    assert value(pairs.pad(F.array(F.lit(1), F.lit(2)), 2, 0)) == [1, 2]
    with pytest.raises(Exception, match="longer than 1"):
        spark.range(1).select(pairs.pad(F.array((F.col("id") + 1).cast("int"), F.lit(2)), 1, 0)).collect()


def test_vectors(value):
    v = F.array(*[F.lit(float(x)) for x in (1, 3, 3)])
    assert value(vectors.argmax(v)) == 1
    lp = value(vectors.log_softmax(v))
    x = np.array([1.0, 3, 3])
    assert np.allclose(lp, x - 3 - np.log(np.exp(x - 3).sum()))
    assert np.isclose(sum(value(vectors.softmax(v))), 1)
    big = F.array(F.lit(1e4), F.lit(0.0))
    assert np.allclose(value(vectors.log_softmax(big)), [0, -1e4])
    assert np.isclose(value(vectors.cross_entropy(F.array(F.lit(-0.5), F.lit(-2.0)), F.lit(1))), 2)
    assert value(vectors.gather_at(v, F.array(F.lit(2), F.lit(0)))) == [3.0, 1.0]
    normed = np.array(value(vectors.layer_norm(v)))
    assert np.allclose(normed, (x - x.mean()) / np.sqrt(x.var() + 1e-12))
    assert value(vectors.select_layers(F.array(*[F.lit(i) for i in (10, 20, 30, 40)]), [-1, 0])) == [40, 10]


def test_batch_masking_equals_column_masking(spark):
    rows = spark.range(300).withColumn("n", (F.col("id") % 40).cast("int")).select(
        F.col("id").cast("string").alias("key"),
        F.concat(F.array(F.lit(2)), F.when(F.col("n") > 0, F.sequence(F.lit(10), F.col("n") + 9)).otherwise(F.array()).cast("array<int>"),
                 F.array(F.lit(3))).alias("t"))
    key, t, p = F.col("key"), F.col("t"), F.col("p")
    column = rows.withColumn("p", pairs.mask_positions(t, 2, 3, key, 0.3, 7)).select(
        "key", pairs.apply_masks(t, p, key, 4, 99, lambda w: w).alias("token_ids"), p.alias("positions"), pairs.labels_at(t, p).alias("labels"))
    batch = rows.select("key", pairs.mask_ids(t, 2, 3, key, 0.3, 7, 4, 99).alias("m")).select("key", "m.*")
    assert sorted(map(tuple, batch.collect()), key=str) == sorted(map(tuple, column.collect()), key=str)
