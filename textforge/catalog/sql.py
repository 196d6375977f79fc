"""Fragments of the SQL counterparts."""

from __future__ import annotations

from textforge.functions import markup, normalize, sentences

SEED = 12345


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def h(*keys) -> str:
    return "md5(concat_ws('|', " + ", ".join(str(k) for k in keys) + "))"


def u(hash_sql: str, at: int = 1) -> str:
    return f"(('0x' || substr({hash_sql}, {at}, 8))::BIGINT::DOUBLE / 4294967296::DOUBLE)"


def u_wide(hash_sql: str) -> str:
    return f"(('0x' || substr({hash_sql}, 1, 13))::BIGINT::DOUBLE / 4503599627370496::DOUBLE)"


def sub(x: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(repl.replace('$', chr(92)))}, 'g')"


def fold(x: str, rules) -> str:
    for pattern, repl in rules:
        x = sub(x, pattern, repl)
    return x


def delete(x: str, literals) -> str:
    for s in literals:
        x = f"replace({x}, {q(s)}, '')"
    return x


def unwrap_links(x: str) -> str:
    return f"replace({fold(x, markup.LINK_RULES)}, 'alt=', '')"


def strip_tags(x: str) -> str:
    x = f"replace({x}, '</doc>', chr(13))"
    x = delete(fold(x, markup.TAG_RULES), markup.LITERAL_TAGS_BEFORE_DIV)
    return fold(delete(fold(x, markup.DIV_RULES), markup.LITERAL_TAGS), [markup.POEM_RULE])


WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"


def strip(x: str) -> str:
    return sub(x, rf"^{WS}+|{WS}+$", "")


def rstrip(x: str) -> str:
    return sub(x, rf"{WS}+$", "")


def mark(x: str, cut: str = "\n") -> str:
    x = sub(x, sentences.ABBREVIATION_PATTERN, "$1$2" + sentences._DOT)
    x = sub(x, sentences.BOUNDARY_PATTERN, "$1" + cut + "$2")
    return f"replace({x}, {q(sentences._DOT)}, '.')"


CONTROL = r"[\x{00}\x{FFFD}\p{Cf}\x{01}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}\x{7F}-\x{9F}]"


def clean(x: str, keep_newline: bool = False) -> str:
    return sub(sub(x, CONTROL, ""), r"[\p{Zs}\t\r]" if keep_newline else r"[\p{Zs}\t\n\r]", " ")


def pad_cjk(x: str) -> str:
    return sub(x, f"({normalize.CJK_PATTERN})", " $1 ")


def pad_punct(x: str) -> str:
    return sub(x, f"({normalize.PUNCT_PATTERN})", " $1 ")


def fold_accents(x: str) -> str:
    return f"strip_accents(lower({x}))"


def tokens(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '[\s\x{{2028}}\x{{2029}}\p{{Z}}]+'), lambda w: w <> '')"


def basic(x: str) -> str:
    return tokens(pad_punct(fold_accents(pad_cjk(clean(x)))))


LINES = r"""lines AS (
  SELECT doc_id, unnest(range(len(l)))::INT AS line_no, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""

# One sentence per row; words of a sentence after normalisation.
SENTENCES = f"""sentences AS (
  SELECT doc_id, unnest(range(len(l)))::INT AS sent_no, {strip('unnest(l)')} AS sent
  FROM (SELECT doc_id, string_split({mark('text')}, chr(10)) AS l FROM documents))"""

SENT_WORDS = f"""sent_words AS (
  SELECT doc_id, sent_no, words FROM (
    SELECT doc_id, unnest(range(len(l))) AS sent_no, {tokens('unnest(l)')} AS words
    FROM (SELECT doc_id, string_split({pad_punct(fold_accents(pad_cjk(clean(mark('text'), True))))}, chr(10)) AS l
          FROM documents)) WHERE len(words) > 0)"""

VOCAB = f"""{SENT_WORDS},
word_counts AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM sent_words) GROUP BY word),
chars AS (SELECT c, row_number() OVER (ORDER BY c) AS r FROM (
  SELECT DISTINCT unnest(regexp_extract_all(word, '.')) AS c FROM word_counts)),
vocab_lines AS (
  SELECT unnest(range(5)) AS line_no, unnest(['[PAD]','[UNK]','[CLS]','[SEP]','[MASK]']) AS line
  UNION ALL SELECT 3 + 2 * r, c FROM chars
  UNION ALL SELECT 4 + 2 * r, '##' || c FROM chars
  UNION ALL SELECT 10000000 + row_number() OVER (ORDER BY n DESC, word), word FROM word_counts
    QUALIFY row_number() OVER (ORDER BY n DESC, word) <= 2000),
vocab AS (SELECT token, (row_number() OVER (ORDER BY first_at) - 1)::INT AS token_id FROM (
  SELECT line AS token, min(line_no) AS first_at FROM vocab_lines GROUP BY line))"""

PIECES = f"""{VOCAB},
spans AS (SELECT word, s, unnest(range(1, least(m, length(word) - s + 1) + 1)) AS l
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS s, m
        FROM word_counts, (SELECT max(length(token)) AS m FROM vocab) WHERE length(word) <= 200)),
hits AS (SELECT word, s, max(l) AS l, arg_max(token_id, l) AS token_id
  FROM spans JOIN vocab ON token = (CASE WHEN s > 1 THEN '##' ELSE '' END) || substr(word, s, l) GROUP BY word, s),
steps AS (SELECT word, map(list(s), list(l)) AS ls, map(list(s), list(token_id)) AS ts FROM hits GROUP BY word),
walk AS (
  SELECT word, length(word) AS size, 1::BIGINT AS reach, []::INT[] AS ids, ls, ts FROM steps
  UNION ALL
  SELECT word, size, reach + ls[reach], list_append(ids, ts[reach]), ls, ts FROM walk WHERE ls[reach] IS NOT NULL),
pieces AS (SELECT w.word, coalesce(k.ids, [1]::INT[]) AS ids FROM word_counts w
  LEFT JOIN walk k ON k.word = w.word AND k.reach = length(w.word) + 1)"""

TOKENS = f"""{PIECES},
sent_ids AS (SELECT doc_id, sent_no, flatten(list(ids ORDER BY word_no)) AS ids FROM (
    SELECT doc_id, sent_no, unnest(range(len(words))) AS word_no, unnest(words) AS word FROM sent_words)
  JOIN pieces USING (word) GROUP BY doc_id, sent_no),
docs AS (SELECT doc_id, flatten(list(ids ORDER BY sent_no)) AS ids, list(len(ids) ORDER BY sent_no) AS lens
  FROM sent_ids GROUP BY doc_id)"""

MAX_SEQ, MAX_PRED, DUPE = 64, 10, 2
MAX_TOKENS = MAX_SEQ - 3


def target(doc: str = "doc_id", dupe: str = "dupe") -> str:
    key = h(SEED, doc, dupe, "'target'")
    return (f"(CASE WHEN {u(key)} < 0.1 THEN 2 + floor({u(key, 9)} * {MAX_TOKENS - 1}) ELSE {MAX_TOKENS} END)::INT")


PLAN = f"""{TOKENS},
doc_totals AS (SELECT doc_id, len(lens) AS n,
    list_prepend(0::BIGINT, list_transform(lens, lambda x, i: list_sum(lens[1:i])::BIGINT)) AS total FROM docs),
targets AS (SELECT doc_id, dupe, {target()} AS target FROM (
  SELECT doc_id, unnest(range({DUPE}))::INT AS dupe FROM docs)),
plan AS (
  SELECT doc_id, dupe, target, -1 AS chunk_no, 0::BIGINT AS first, 0::BIGINT AS last, 0::BIGINT AS a_end,
         true AS is_random, 0::BIGINT AS nxt FROM targets
  UNION ALL
  SELECT doc_id, dupe, target, cn, st, la, st + ae, rnd, CASE WHEN rnd THEN st + ae ELSE la END
  FROM (SELECT *, CASE WHEN k = 1 THEN 1 ELSE 1 + floor({u('hh')} * (k - 1))::BIGINT END AS ae,
               (k = 1 OR {u('hh', 9)} < 0.5) AS rnd
        FROM (SELECT *, la - st AS k FROM (
          SELECT p.doc_id, p.dupe, p.target, p.chunk_no + 1 AS cn, p.nxt AS st,
                 least(len(list_filter(d.total, lambda t: t < d.total[p.nxt + 1] + p.target)), d.n) AS la,
                 {h(SEED, 'p.doc_id', 'p.dupe', 'p.chunk_no + 1', "'chunk'")} AS hh
          FROM plan p JOIN doc_totals d ON d.doc_id = p.doc_id WHERE p.nxt < d.n)))),
chunks AS (SELECT doc_id, dupe, target, chunk_no, first, last, a_end, is_random FROM plan WHERE chunk_no >= 0)"""

PAIRS = f"""{PLAN},
doc_index AS (SELECT doc_id, row_number() OVER (ORDER BY {h(SEED, 'doc_id')}, doc_id) - 1 AS doc_idx FROM docs),
partner AS (SELECT c.*, CASE WHEN n = 1 THEN 0 WHEN draw >= doc_idx THEN draw + 1 ELSE draw END AS partner_idx
  FROM (SELECT c.*, i.doc_idx, t.n,
          floor({u_wide(h(SEED, 'c.doc_id', 'dupe', 'chunk_no', "'partner'"))} * greatest(t.n - 1, 1))::BIGINT AS draw
        FROM chunks c JOIN doc_index i ON i.doc_id = c.doc_id, (SELECT count(*) AS n FROM docs) t) c),
started AS (SELECT p.*, x.doc_id AS partner_id,
    floor({u(h(SEED, 'p.doc_id', 'dupe', 'chunk_no', "'start'"))} * dt.n)::BIGINT AS b_first,
    d.ids[own.total[p.first + 1] + 1 : own.total[p.a_end + 1]] AS a,
    d.ids[own.total[p.a_end + 1] + 1 : own.total[p.last + 1]] AS next_b,
    dt.total AS p_total, dt.n AS p_n
  FROM partner p JOIN doc_index x ON x.doc_idx = p.partner_idx JOIN doc_totals dt ON dt.doc_id = x.doc_id
  JOIN docs d ON d.doc_id = p.doc_id JOIN doc_totals own ON own.doc_id = p.doc_id),
ended AS (SELECT *, least(greatest(len(list_filter(p_total, lambda t: t < p_total[b_first + 1] + greatest(target - len(a), 1))),
                                   b_first + 1), p_n) AS b_last FROM started),
pairs AS (SELECT e.doc_id, dupe, chunk_no, is_random, partner_id, b_first, b_last, a,
    CASE WHEN is_random THEN d.ids[p_total[b_first + 1] + 1 : p_total[b_last + 1]] ELSE next_b END AS b
  FROM ended e JOIN docs d ON d.doc_id = e.partner_id)"""


def front(side: str, rem: str) -> str:
    """Coins on the front: hex digits below 8 among the first ``rem`` digits of the chained hashes."""
    key = h("ck", q(side), "j")
    blocks = f"array_to_string(list_transform(range((({rem}) + 31) // 32), lambda j: {key}), '')"
    return f"(CASE WHEN {rem} > 0 THEN length(translate(left({blocks}, ({rem})::BIGINT), '89abcdef', '')) ELSE 0 END)"


def truncation(source: str, max_len: int, keep: str) -> str:
    """CTE body adding fa, ka, fb, kb to a relation with a, b and (for random cuts) ck."""
    return f"""SELECT *, {front('a', 'ra')} AS fa, la - ra AS ka, {front('b', 'rb')} AS fb, lb - rb AS kb FROM (
      SELECT *, (CASE WHEN la > lb THEN f1 ELSE 0 END) + (e - f1) // 2 AS ra,
             (CASE WHEN lb >= la THEN f1 ELSE 0 END) + (e - f1) - (e - f1) // 2 AS rb FROM (
        SELECT *, least(e, abs(la - lb)) AS f1 FROM (
          SELECT *, greatest(0, la + lb - {max_len}) AS e FROM (
            SELECT {keep}, len(a) AS la, len(b) AS lb FROM {source}))))"""


CUT = f"""{PAIRS},
keyed AS (SELECT *, concat_ws('|', {SEED}, doc_id, dupe, chunk_no, 'cut') AS ck FROM pairs),
cut AS ({truncation('keyed', MAX_TOKENS, '*')})"""

def coefficients(hash_sql: str) -> str:
    return "[" + ", ".join(f"('0x' || substr({hash_sql}, {8 * k + 1}, 8))::BIGINT % 2147483647" for k in range(4)) + "]"


def cubic(c: str, i: str) -> str:
    return f"(((({c}[1] * {i} + {c}[2]) % 2147483647 * {i} + {c}[3]) % 2147483647 * {i} + {c}[4]) % 2147483647)"


INSTANCES = f"""{CUT},
whole AS (SELECT doc_id, dupe, chunk_no, is_random, ka, kb,
    [2]::INT[] || a[fa + 1 : fa + ka] || [3]::INT[] || b[fb + 1 : fb + kb] || [3]::INT[] AS original FROM cut),
cand AS (SELECT doc_id, dupe, chunk_no, pos, tok, size, {cubic('hp', 'pos')} AS place, {cubic('ha', 'pos')} / 2147483647::DOUBLE AS act,
    floor({cubic('hw', 'pos')} / 2147483647::DOUBLE * v)::INT AS word
  FROM (SELECT doc_id, dupe, chunk_no, len(original) AS size, unnest(range(len(original))) AS pos, unnest(original) AS tok,
          {coefficients(h('mk', "'place'"))} AS hp, {coefficients(h('mk', "'act'"))} AS ha, {coefficients(h('mk', "'word'"))} AS hw, v
        FROM (SELECT *, concat_ws('|', {SEED}, doc_id, dupe, chunk_no, 'mask') AS mk FROM whole), (SELECT count(*) AS v FROM vocab))
  WHERE tok NOT IN (2, 3)),
masked AS (SELECT * FROM cand
  QUALIFY row_number() OVER (PARTITION BY doc_id, dupe, chunk_no ORDER BY place, pos)
          <= least({MAX_PRED}, greatest(1, round_even(size * 0.15::DOUBLE, 0)::INT))),
masks AS (SELECT doc_id, dupe, chunk_no, list(pos ORDER BY pos) AS positions, list(tok ORDER BY pos) AS labels,
    sum(CASE WHEN act < 0.8 THEN 4 WHEN act < 0.9 THEN tok ELSE word END - tok)::BIGINT AS delta,
    sum((CASE WHEN act < 0.8 THEN 4 WHEN act < 0.9 THEN tok ELSE word END - tok) * (pos + 1))::BIGINT AS weighted_delta
  FROM masked GROUP BY doc_id, dupe, chunk_no)"""


def with_ctes(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{select}"
