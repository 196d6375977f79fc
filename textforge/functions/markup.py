"""Markup removal on article text.

All rules act within one line: every negated class also excludes the line break,
so the same expression serves a single line and a whole multi-line article.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from textforge.functions.draws import let

# Line filters, rewrites and deletions, in order of application.
DROP_LINE_PATTERNS = [r"^<doc [^>\n]*>$", r"\[\[Category:[^\]\[\n]*\]\]"]

LINK_RULES = [
    (r"\[\[([^\]|\[\n]*)\]\]", "$1"),
    (r"\[\[([^\]|\[\n]*)\]\]", "$1"),
    (r"\[\[[^\]|\[\n]*\|([^\]|\[\n]*)\]\]", "$1"),
    (r"\[\[[^\]|\[\n]*\|([^\]|\[\n]*)\]\]", "$1"),
    (r"\[\[:*[Ff]ile:[^\]\[\n]*\]\]", ""),
    (r"\[\[[Mm]edia:[^\]\[\n]*\]\]", ""),
    (r"\[\[[Ii]mage:[^\]\[\n]*\]\]", ""),
    (r"\[([^\]|\[\n]*)\]", "$1"),
    (r"\[\[[^\]\[\n]*\]\]", ""),
]

TAG_RULES = [
    (r"<chem([^<\n]*)</chem>", "$1"),
    (r"<ins([^<\n]*)</ins>", "$1"),
    (r"<, ref [^<\n]*</ref>", ""),
    (r"<includeonly[^<\n]*</includeonly>", ""),
    (r"<graph[^<\n]*</graph>", ""),
    (r"<section[^\\\n]*/>", ""),
    (r"<meta[^\\\n]*/>", ""),
    (r"<hr[^\\\n]*/>", ""),
    (r"<gallery[^>\n]*>", ""),
    (r"<ref[^<\n]*</ref>", ""),
    (r"<ref[^>\n]*>", ""),
    (r"<http[^>\n]*>", ""),
    (r"<Ref[^>\n]*>", ""),
    (r"<mapframe [^/\n]*/>", ""),
    (r"<mapframe[^>\n]*>", ""),
]

LITERAL_TAGS_BEFORE_DIV = ["</mapframe>", "<poem>", "</poem>", "<math>", "</math>", "<ref>", "</ref>"]

DIV_RULES = [(r"<div[^>\n]*>", ""), (r"</div[^>\n]*>", "")]

LITERAL_TAGS = [
    "</div style>", "</div>", "<sup>", "</sup>", "<br>", "</br>", "<BR>", "</BR>", "<Br>", "</Br>",
    "<del>", "</del>", "<nowiki>", "</nowiki>", "<NOWIKI>", "</NOWIKI>", "<onlyinclude>", "</onlyinclude>",
    "<includeonly>", "</includeonly>", "<small>", "</small>", "<chem>", "</chem>", "<noinclude>",
    "</noinclude>", "<gallery>", "</gallery>", "<graph>{", "<graph>", "}</graph>", "</graph>", "</references>",
]

POEM_RULE = (r"<poem [^>\n]*>", "")


def _rewrite(text: Column, rules) -> Column:
    return reduce(lambda c, r: F.regexp_replace(c, F.lit(r[0]), F.lit(r[1])), rules, text)


def _delete(text: Column, literals) -> Column:
    # F.replace works on the UTF-8 bytes and returns its input when nothing matches.
    return reduce(lambda c, s: F.replace(c, F.lit(s), F.lit("")), literals, text)


def keeps_line(line: Column) -> Column:
    """False for doc headers and for lines holding a category link."""
    return reduce(lambda a, b: a & b, [~line.rlike(p) for p in DROP_LINE_PATTERNS])


def drop_marked_lines(text: Column) -> Column:
    """keeps_line for a whole multi-line text."""
    header = r"(?md)^<doc [^>\n]*>(?:\n|\z)"
    category = r"(?md)^[^\n]*\[\[Category:[^\]\[\n]*\]\][^\n]*(?:\n|\z)"
    gone = F.regexp_replace(F.regexp_replace(text, header, ""), category, "")
    # A dropped last line takes its separator with it.
    cut_end = gone.endswith("\n") & ~text.endswith("\n")
    return F.when(cut_end, F.regexp_replace(gone, r"\n\z", "")).otherwise(gone)


def unwrap_links(text: Column) -> Column:
    """Resolve [[x]], [[a|b]], media links and single brackets; drop alt=."""
    linked = let(text, lambda t: F.when(t.contains("["), _rewrite(t, LINK_RULES)).otherwise(t))
    return F.replace(linked, F.lit("alt="), F.lit(""))


def strip_tags(text: Column) -> Column:
    """Apply the tag rules in order; texts without '<' skip the chain."""
    def chain(t: Column) -> Column:
        body = F.replace(t, F.lit("</doc>"), F.lit("\r"))
        body = _delete(_rewrite(body, TAG_RULES), LITERAL_TAGS_BEFORE_DIV)
        body = _delete(_rewrite(body, DIV_RULES), LITERAL_TAGS)
        return _rewrite(body, [POEM_RULE])

    return let(text, lambda t: F.when(t.contains("<"), chain(t)).otherwise(t))


def clean_markup(text: Column) -> Column:
    """Links, then tags, on a line or a whole article (lines already filtered)."""
    return strip_tags(unwrap_links(text))


_MARK = "\ufdd0"  # a Unicode noncharacter; where a text holds it, it is escaped


def strip_headers(text: Column) -> Column:
    """Header and title removal on the whole text of one extract file.

    A regex scan pairs each header line with the line after it from left to right,
    which is exactly the keep/skip state of a sequential reader.
    """
    one_newline = F.regexp_replace(F.replace(text, F.lit(_MARK), F.lit(_MARK + "0")), r"\r\n|\r", "\n")
    paired = F.regexp_replace(one_newline, r"(?md)^[^\n]*<doc[^\n]*(?:\n[^\n]*(?:\n|\z)|\z)", _MARK + "1\n")
    no_close = F.regexp_replace(paired, r"(?md)^[^\n]*</doc>[^\n]*(?:\n|\z)", "")
    no_blank = F.regexp_replace(no_close, r"(?md)^\n", "")
    # A last line of one character without its line break counts as empty.
    no_tail = F.regexp_replace(no_blank, "(?:(?<=\n)|\\A)(?:[^\n\ufdd0]|\ufdd00)\\z", "")
    return F.replace(F.replace(no_tail, F.lit(_MARK + "1"), F.lit("")), F.lit(_MARK + "0"), F.lit(_MARK))
