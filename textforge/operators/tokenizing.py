"""Words and token ids of whole texts, a dictionary lookup per white-space token.

The rules are those of ``functions.normalize.sentence_words``.  All but the sentence boundaries work on single
characters, so the Column expressions are evaluated once on every character, and tasks apply the resulting table to the
distinct white-space tokens they meet instead of a dozen passes to every text.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textforge.functions.normalize import clean_text, lower_strip_accents, pad_cjk, pad_punct
from textforge.functions.sentences import ABBREVIATION_PATTERN, ABBREVIATIONS, BOUNDARY_PATTERN
from textforge.operators.vocab import MAX_WORD, word_encoder

ROWS = 256  # texts that are Python strings at a time
COUNTED = 2048  # texts whose words are counted at a time
KEPT = 300_000  # white-space tokens that a task remembers

_ABBREVIATED = re.compile(ABBREVIATION_PATTERN)
_GAPS = re.compile(r"[ \u2028\u2029]+")
_ESCAPE = "\ufdd1"
_SIGMA = "Σ"


@lru_cache(maxsize=2)
def _characters(spark: SparkSession, app_id: str) -> tuple[dict[int, str], str]:
    """What the word rules make of each character they change, and the upper-case letters."""
    code = F.col("id")
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    made = pad_punct(lower_strip_accents(pad_cjk(clean_text(F.col("c"), keep_newline=True))))
    # Planes 4 to 13 are unassigned, 15 and 16 private: the rules leave them alone.
    rows = (spark.range(0x41000).withColumn("id", code + F.when(code >= 0x40000, 0xA0000).otherwise(0)).where((code < 0xD800) | (code > 0xDFFF)).select("id", char.alias("c"))
            .select("id", "c", made.alias("made"), F.col("c").rlike(r"^\p{Lu}\z").alias("upper")).where("made <> c OR upper").toArrow())
    code, char, made, upper = (rows.column(c).to_pylist() for c in ("id", "c", "made", "upper"))
    return dict(zip(code, made)), "".join(c for c, is_upper in zip(char, upper) if is_upper)


def _shared(spark: SparkSession, *more):
    return spark.sparkContext.broadcast((*_characters(spark, spark.sparkContext.applicationId), *more))


def _final_sigmas(token: str, table: dict[int, str]) -> str:
    """The only letter whose lower case depends on its neighbours; characters that the rules drop are none."""
    token = "".join(c for c in token if table.get(ord(c)) != "")
    low = token.lower()
    return "".join(low[len(token[:i].lower())] if c == _SIGMA else c for i, c in enumerate(token))


def word_splitter(table: dict[int, str]):
    """White-space token -> words."""
    def words(token: str) -> list[str]:
        if token.isascii() and token.isalnum():
            return [token.lower()]
        if _SIGMA in token:
            token = _final_sigmas(token, table)
        return [w for w in _GAPS.split(token.translate(table)) if w]

    return words


def boundary_marker(upper: str):
    """text -> the text with line breaks between sentences, as mark_boundaries puts them."""
    boundary = re.compile(BOUNDARY_PATTERN.replace(r"\p{Lu}", f"[{upper}]"))
    short = [f"{a}." for a in ABBREVIATIONS]

    def mark(text: str) -> str:
        if not any(a in text for a in short):
            return boundary.sub(r"\1\n\2", text)
        kept = _ABBREVIATED.sub(rf"\1\2{_ESCAPE}1", text.replace(_ESCAPE, f"{_ESCAPE}2"))
        return boundary.sub(r"\1\n\2", kept).replace(f"{_ESCAPE}1", ".").replace(f"{_ESCAPE}2", _ESCAPE)

    return mark


class _Remembered(dict):
    """Token -> value, computed when first asked for; the caller empties it when it grows."""

    def __init__(self, compute):
        self.compute = compute

    def __missing__(self, token):
        found = self[token] = self.compute(token)
        return found


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """(word, count) of a text column; the tokens of some thousand texts are counted by Arrow, their words by Spark."""
    shared = _shared(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, upper = shared.value
        words, mark = _Remembered(word_splitter(table)), boundary_marker(upper)
        for batch in batches:
            for at in range(0, batch.num_rows, COUNTED):
                if len(words) > KEPT:
                    words.clear()
                texts = pc.fill_null(batch.column(0).slice(at, COUNTED), "")
                if pc.any(pc.match_substring(texts, "\f")).as_py():  # the only gap that is a word's end at boundaries alone
                    texts = pa.array([mark(t) for t in texts.to_pylist()], pa.string())
                for gap in "\n\t\r":
                    texts = pc.replace_substring(texts, gap, " ")
                tokens, n = pc.split_pattern(texts, " ").flatten().value_counts().flatten()
                # Other tokens than ASCII letters and digits are split one by one.
                plain = pc.and_(pc.string_is_ascii(tokens), pc.ascii_is_alnum(tokens))
                rest = pc.invert(plain)
                split = [(word, k) for token, k in zip(tokens.filter(rest).to_pylist(), n.filter(rest).to_pylist()) for word in words[token]]
                for part in ((pc.ascii_lower(tokens.filter(plain)), n.filter(plain)),
                             (pa.array([w for w, _ in split], pa.string()), pa.array([k for _, k in split], pa.int64()))):
                    yield pa.RecordBatch.from_arrays(list(part), names=["word", "n"])

    found = df.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("count"))


def encode_texts(df: DataFrame, text: str, vocab: list[str], out: str = "ids", ends: str = "ends", max_chars: int = MAX_WORD) -> DataFrame:
    """Replace a text column by flat token ids and the running token count after each sentence that has tokens.

    No shuffle: the vocabulary (at most MAX_VOCAB tokens) is broadcast.
    """
    shared = _shared(df.sparkSession, vocab)
    rest = [c for c in df.columns if c != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, upper, tokens = shared.value
        words, mark, encode = word_splitter(table), boundary_marker(upper), word_encoder(tokens, max_chars)
        known = _Remembered(lambda token: array("i", chain.from_iterable(map(encode, words(token)))).tobytes())
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids, counts, ids_at, counts_at = bytearray(), array("i"), [0], [0]
                for value in part.column(part.schema.get_field_index(text)).to_pylist():
                    for line in mark(value or "").split("\n"):
                        before = len(ids)
                        ids += b"".join(map(known.__getitem__, line.split(" ")))
                        if len(ids) > before:
                            counts.append(len(ids) // 4 - ids_at[-1])
                    ids_at.append(len(ids) // 4)
                    counts_at.append(len(counts))
                lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(values)]))
                         for offsets, values in ((ids_at, ids), (counts_at, counts))]
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in rest), *lists], [*rest, out, ends])
                if len(known) > KEPT:
                    known.clear()

    return df.mapInArrow(run, f"{schema}, `{out}` array<int>, `{ends}` array<int>")
