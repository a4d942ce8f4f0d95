"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from millrace.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return round(float(value), 6)
    return str(value)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, data, name):
    df = registry.queries()[name](spark, data)
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from read_parquet('{data}/{t}.parquet')")
    result = db.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    theirs = sorted(repr([plain(dict(zip(columns, row, strict=True))[c]) for c in order]) for row in result.fetchall())
    ours = sorted(repr([plain(row[c]) for c in order]) for row in df.collect())
    assert ours == theirs


def test_merged_thinking_matches_sql_on_odd_texts(spark, tmp_path):
    texts = [None, "", " ", "\n", "Leé.\nrest", "a \n b", " \u00a0ab\u3000 x", "\tab\r\n", "ab  \n", "<think>x</think>", "  <think>x", "\n<think>x", "\u2028ab\x1f", "日本 \n語"]
    rows = [(i, turn, "assistant", t) for i, t in enumerate(texts) for turn in (0, 1, 2, -1, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    theirs = sorted(map(repr, db.execute(registry.oracle_sql()["merged_thinking"]).fetchall()))
    assert sorted(repr(tuple(r)) for r in registry.queries()["merged_thinking"](spark, str(tmp_path)).collect()) == theirs


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
