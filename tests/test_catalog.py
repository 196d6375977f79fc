"""Every registered query with a SQL counterpart, compared on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = rows_of(names, cur.fetchall())
    assert got == want and (want or name in ("heldout_overlap", "time_to_target"))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert rows
    if name == "utf8_ignore":
        assert all(r.same for r in rows)


def test_words_are_counted_once_for_table_and_vocabulary(spark, monkeypatch):
    from textforge.catalog import inputs, q_tokens

    made = []
    for module in (inputs, q_tokens):
        monkeypatch.setattr(module, "word_counts", lambda *a, count=module.word_counts: made.append(1) or count(*a))
    monkeypatch.setattr(inputs, "_VOCABS", {})
    assert q_tokens.wordpiece(spark, SF).count() and len(made) == 1


def test_only_shared_ids_are_joined_to_their_sources(spark, tmp_path):
    from textforge.catalog import q_io

    def checked(rows, name):
        sf = f"{tmp_path}/{name}"
        spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{sf}/documents.parquet")
        got = q_io.with_source(spark, sf)
        want = q_io.extracts(spark, sf).join(q_io.documents(spark, sf).select("doc_id", "source"), "doc_id")
        columns = ["doc_id", "text", "source"]
        assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
        return got._jdf.queryExecution().executedPlan().toString()

    rows = [(k, f"line {k}\nmore", f"s{k % 3}") for k in range(20)] + [(30, None, "s1"), (31, "x", None)]
    assert "Join" not in checked(rows, "unique")
    checked([*rows, (None, "no id", "s1"), (3, "line 3\nmore", "s0"), (3, "other", "s2"), (4, None, None)], "shared")
