"""Corpus queries against their SQL, on the given tables and on rows that need care."""

from __future__ import annotations

import collections

import duckdb
import pytest

from phenolith.llm import chat, near_dup, queries

SF = "/root/testdata/sf0.001"


def same_rows(df, con, sql):
    rel = con.sql(sql)
    assert sorted(rel.columns) == sorted(df.columns)
    got = collections.Counter(tuple(r[c] for c in rel.columns) for r in df.collect())
    assert got == collections.Counter(rel.fetchall())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    same_rows(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name])


def test_near_duplicates_of_odd_texts(spark):
    base = " ".join(f"w{i}" for i in range(80))
    near = [base.replace(f"w{i} ", f"x{i} ") for i in (3, 40, 70)]
    texts = [base, base.upper(), *near, base + " tail", None, "", " \t\n", "One", "one", "one two", "ONE two", "ü Ü ü",
             "ü ü ü", "a b c d e", "one two three", "one two three one two three"]
    docs = [(i, t) for i, t in enumerate(texts)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    same_rows(near_dup.near_duplicate_digest(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)), con,
              queries.ORACLES["op7_near_duplicates"])


def test_preference_pairs_of_odd_turns(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (2, 0, "user", "hi"), (2, 1, "assistant", "longer"), (2, 2, "assistant", None),
            (10, 0, "user", "hi"), (10, 1, "assistant", "longer"), (3, None, None, None), (3, 1, "assistant", "x"), (4, 0, None, None),
            (4, 0, None, None), (5, 0, "system", "no answer"), (None, 0, "user", "hi"), (6, 7, "assistant", "\U0001F600 ü")]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    same_rows(chat.preference_digest(turns), con, queries.ORACLES["op6_preference_pairs"])
