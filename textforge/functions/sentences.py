"""Rule-based sentence boundaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abbreviations whose full stop does not end a sentence.
ABBREVIATIONS = ["Mr", "Mrs", "Ms", "Dr", "Prof", "St", "Jr", "Sr", "vs", "etc", "Inc", "Ltd", "Fig", "Vol"]

_ESCAPE = "\ufdd1"  # a noncharacter; where a text holds it, it is escaped
_CUT, _DOT, _SELF = _ESCAPE + "0", _ESCAPE + "1", _ESCAPE + "2"

ABBREVIATION_PATTERN = r"""(^|[ \t\n\r\f("'\[])(""" + "|".join(ABBREVIATIONS) + r")\."
BOUNDARY_PATTERN = r"""([.!?]["')\]]*)[ \t\r\f]+(["'(\[]*\p{Lu})"""


def mark_boundaries(text: Column, cut: str = "\n") -> Column:
    """Put ``cut`` between sentences; existing line breaks stay boundaries."""
    kept = F.regexp_replace(F.replace(text, F.lit(_ESCAPE), F.lit(_SELF)), ABBREVIATION_PATTERN, "$1$2" + _DOT)
    cut_up = F.regexp_replace(kept, BOUNDARY_PATTERN, "$1" + _CUT + "$2")
    return F.replace(F.replace(F.replace(cut_up, F.lit(_DOT), F.lit(".")), F.lit(_CUT), F.lit(cut)), F.lit(_SELF), F.lit(_ESCAPE))


def split_sentences(text: Column) -> Column:
    """array<string> of stripped sentences, empty ones (blank lines) kept as ''."""
    return F.transform(F.split(mark_boundaries(text), "\n"), strip)


def strip(text: Column) -> Column:
    """Remove white space, in the Unicode sense, from both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+\z", "")
