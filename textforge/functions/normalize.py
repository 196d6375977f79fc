"""Text normalisation before word pieces: cleaning, CJK padding, accents, punctuation.

Everything is a native Column expression.  ``word_text`` runs the whole chain on a
document at once, with line breaks as sentence separators, so each regex makes one
pass per document instead of one per word.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from textforge.functions.draws import let
from textforge.functions.sentences import mark_boundaries

# The eight CJK ideograph ranges.
CJK_RANGES = [
    (0x4E00, 0x9FFF), (0x3400, 0x4DBF), (0x20000, 0x2A6DF), (0x2A700, 0x2B73F),
    (0x2B740, 0x2B81F), (0x2B820, 0x2CEAF), (0xF900, 0xFAFF), (0x2F800, 0x2FA1F),
]
# ASCII symbols that count as punctuation, beside category P.
ASCII_PUNCT_RANGES = [(33, 47), (58, 64), (91, 96), (123, 126)]

NON_ASCII = r"[^\x00-\x7F]"
UNUSED_TOKEN_PATTERN = r"^\[unused\d+\]$"


def char_class(ranges) -> str:
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges)


CJK_PATTERN = f"[{char_class(CJK_RANGES)}]"
PUNCT_PATTERN = f"[{char_class(ASCII_PUNCT_RANGES)}\\p{{P}}]"


def decode_utf8_ignore(data: Column) -> Column:
    """Bytes to text; invalid sequences are dropped."""
    return F.replace(F.make_valid_utf8(data.cast("string")), F.lit("\ufffd"), F.lit(""))


def strip_bom(text: Column) -> Column:
    return F.regexp_replace(text, r"^\x{FEFF}", "")


def clean_text(text: Column, keep_newline: bool = False) -> Column:
    """Drop control and format characters, NUL and U+FFFD; white space becomes ' '."""
    kept = F.regexp_replace(text, r"[\x00\x{FFFD}\p{Cf}]|[\p{Cc}&&[^\t\n\r]]", "")
    return F.regexp_replace(kept, r"[\p{Zs}\t\r]" if keep_newline else r"[\p{Zs}\t\n\r]", " ")


def pad_cjk(text: Column) -> Column:
    return F.regexp_replace(text, CJK_PATTERN, " $0 ")


def whitespace_tokens(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda t: t != "")


def _cleaned_tokens(text: Column) -> Column:
    """whitespace_tokens after clean_text, which leaves only these separators."""
    return F.filter(F.split(text, r"[ \n\x{2028}\x{2029}]+"), lambda t: t != "")


@lru_cache(maxsize=1)
def _decompositions():
    """Characters whose canonical decomposition, without marks, differs from themselves."""
    single, multiple = {}, {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF:
            continue
        c = chr(cp)
        base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if base == c or not base:
            continue
        (single if len(base) == 1 else multiple)[c] = base
    return single, multiple


def _jamo(syllable: Column) -> Column:
    """Canonical decomposition of one Hangul syllable into two or three jamo."""
    def char(cp: Column) -> Column:
        return F.decode(F.unhex(F.lpad(F.hex(cp), 4, "0")), "UTF-16BE")

    s = F.ascii(syllable).cast("long") - 0xAC00
    tail = s % 28
    return F.concat(
        char(F.floor(s / 588) + 0x1100),
        char(F.floor((s % 588) / 28) + 0x1161),
        F.when(tail > 0, char(tail + 0x11A7)).otherwise(""),
    )


def strip_accents(text: Column) -> Column:
    """Canonical decomposition, then removal of non-spacing marks."""
    single, multiple = _decompositions()
    rare = f"[\\x{{AC00}}-\\x{{D7A3}}{''.join(multiple)}]"

    def decompose(c: Column) -> Column:
        return F.when(c.rlike(r"^[\x{AC00}-\x{D7A3}]$"), _jamo(c)).otherwise(c)

    def expand(t: Column) -> Column:
        by_char = F.array_join(F.transform(F.split(t, ""), decompose), "")
        return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), multiple.items(), by_char)

    def fold(t: Column) -> Column:
        # ASCII rows skip everything; the rare branch runs only on rows that hold such characters.
        simple = F.translate(F.when(t.rlike(rare), expand(t)).otherwise(t), "".join(single), "".join(single.values()))
        return F.when(t.rlike(NON_ASCII), F.regexp_replace(simple, r"\p{Mn}", "")).otherwise(t)

    return let(text, fold)


def lower_strip_accents(text: Column) -> Column:
    return strip_accents(F.lower(text))


def pad_punct(text: Column) -> Column:
    return F.regexp_replace(text, PUNCT_PATTERN, " $0 ")


def split_punct(token: Column) -> Column:
    return whitespace_tokens(pad_punct(token))


def basic_tokens(text: Column, lower: bool = True, unused: list[str] | None = None) -> Column:
    """Clean, pad CJK, split on white space, fold case and accents, split punctuation.

    ``unused``: placeholder tokens of the vocabulary ([unused0], ...) kept as they are.
    """
    padded = pad_cjk(clean_text(text))
    fold = lower_strip_accents if lower else (lambda c: c)
    if not unused:
        return _cleaned_tokens(pad_punct(fold(padded)))
    kept = F.array(*[F.lit(t) for t in unused])

    def pieces(tok: Column) -> Column:
        keep = tok.rlike(UNUSED_TOKEN_PATTERN) & F.array_contains(kept, tok)
        return F.when(keep, F.array(tok)).otherwise(split_punct(fold(tok)))

    return F.flatten(F.transform(whitespace_tokens(padded), pieces))


def sentence_words(text: Column, lower: bool = True) -> Column:
    """array<array<string>>: basic tokens of each sentence, sentences without tokens dropped."""
    lines = pad_cjk(clean_text(mark_boundaries(text), keep_newline=True))
    folded = lower_strip_accents(lines) if lower else lines
    words = F.transform(F.split(pad_punct(folded), "\n"), _cleaned_tokens)
    return F.filter(words, lambda w: F.size(w) > 0)
