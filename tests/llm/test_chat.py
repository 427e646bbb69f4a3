"""Chat snapshots: the query against its SQL, and edge cases."""

import duckdb

from catalink.llm.chat import OP10_SQL, format_chats, op10_chat_snapshots

SCHEMA = "conv_id long, turn long, role string, text string, n_turns int"


def duck(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(con.execute(OP10_SQL).fetchall(), key=str)


def ours(df):
    return sorted(((r.conv_id, r.n_turns, r.text) for r in df.collect()), key=str)


def test_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    assert ours(op10_chat_snapshots(spark, sf_dir)) == sorted(con.execute(OP10_SQL).fetchall(), key=str)


def snapshots():
    turns = [("user", "hi"), ("assistant", "hello"), ("user", "bye"), ("assistant", "see you")]
    rows = []
    for conv, n in ((1, 2), (2, 4), (3, 4), (4, 1), (5, 3)):  # 2 and 3 are equal, the others snapshots
        rows += [(conv, k, *turns[k]) for k in range(n)]
    rows += [(6, 0, "user", "hi"), (6, 1, "assistant", "other")]
    rows += [(7, 0, "user", None), (8, 0, "user", ""), (9, 0, None, "hi")]
    rows += [(10, 5, "user", "late"), (10, None, "system", "no turn"), (10, 5, "assistant", "tie")]
    rows += [(11, 0, "user", "hi"), (11, 0, "user", "hi"), (11, 1, "assistant", "hello")]  # a repeated row
    rows += [(None, 0, "user", "no id"), (None, 1, "user", "more")]
    return rows


def test_collapse_and_edge_cases(spark):
    rows = snapshots()
    df = spark.createDataFrame([(*r, 9) for r in rows], SCHEMA)
    got = ours(format_chats(df))
    assert got == duck(rows)
    ids = {r[0] for r in got}
    assert ids == {2, 6, 7, 8, 9, 10, None}
    text = {r[0]: r[2] for r in got}
    assert text[6] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nother<|im_end|>\n"


def test_turns_without_an_id_stand_alone(spark):
    rows = [(None, k, "user", "the same line") for k in range(50)] + [(None, 0, "user", "the same line")] * 50
    rows += [(None, 1, "user", "only here"), (None, None, None, None), (None, 3, "user", "hi"), (None, 2, "user", "opens")]
    rows += [(4, 0, "user", "hi"), (5, 0, "user", "opens"), (5, 1, "assistant", "more")]
    got = ours(format_chats(spark.createDataFrame([(*r, 9) for r in rows], SCHEMA)))
    assert got == duck(rows)
    wrap = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    opened = wrap("user", "opens") + wrap("assistant", "more")
    assert got == sorted(
        [(None, 1, wrap("user", "the same line")), (None, 1, wrap("user", "only here")), (None, 1, wrap("", ""))]
        + [(4, 1, wrap("user", "hi")), (5, 2, opened)],
        key=str,
    )


def test_long_conversation_and_its_prefixes(spark):
    rows = [(c, k, "user", f"turn {k}") for c, n in ((1, 300), (2, 299), (3, 1), (4, 300)) for k in range(n)]
    df = spark.createDataFrame([(*r, 9) for r in rows], SCHEMA)
    assert [(r.conv_id, r.n_turns) for r in format_chats(df).collect()] == [(1, 300)]


def test_empty_table(spark):
    assert format_chats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_plan_has_no_python(spark, sf_dir):
    plan = op10_chat_snapshots(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
