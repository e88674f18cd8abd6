import duckdb
from pyspark.sql import functions as F

from pulseboard.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "system", "be <b>brief</b>"),
    (1, 1, "user", r"a\lb \\ \g <turn:user>"),
    (1, 2, "assistant", "</turn>\\"),
    (2, 0, "user", None),
    (2, 1, "user", "again"),
    (3, 1, "assistant", "ü漢"),
    (3, 0, None, "?"),
    (None, 5, "user", ""),
    (None, None, "assistant", "x" * 100_000),
    (4, 0, "user", "tie"),
    (4, 0, "user", "tie"),
    (4, 0, "assistant", "tie"),
]


def read(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA + ", valid string" if len(rows[0]) == 5 else SCHEMA)
    pieces = chat.segments(frame)
    return pieces, chat.formatted(pieces).withColumn("turns", chat.parsed(F.col("formatted")))


def test_round_trip(spark):
    _, whole = read(spark, ROWS)
    found = {r.conv_id: r for r in whole.collect()}
    for conv in {r[0] for r in ROWS}:
        own = sorted((r for r in ROWS if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in found[conv].turns] == [(r[2] or "", r[3] or "") for r in own]
        assert found[conv].loss_text == "".join(r[3] for r in own if r[2] == "assistant")
        assert found[conv].formatted.count("<") == 2 * len(own)


def test_machine(spark):
    pieces, _ = read(spark, ROWS)
    found = {r.conv_id: (r.n_turns, r.valid, r.first_bad) for r in chat.status(pieces).collect()}
    assert found == {1: (3, True, None), 2: (2, False, 2), 3: (2, False, 1), None: (2, False, 1), 4: (3, False, 1)}


def test_another_template(spark):
    template = chat.Template(
        learned=("user",), follows={chat.START: ("user",), "user": ("user",)}, ends=("user",), before=("<|", "|>"), after="<end>"
    )
    frame = spark.createDataFrame([(1, 0, "user", "a|b"), (1, 1, "user", "c")], SCHEMA)
    pieces = chat.segments(frame, template)
    row = chat.formatted(pieces).select("*", chat.parsed(F.col("formatted"), template).alias("turns")).first()
    assert row.formatted == "<|user|>a|b<end><|user|>c<end>"
    assert row.loss_text == "a|bc"
    assert [t.text for t in row.turns] == ["a|b", "c"]
    assert chat.status(pieces, template).first().valid


def test_clashing_columns_and_no_python(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a", "v")], SCHEMA + ", segment string")
    pieces = chat.segments(frame)
    assert pieces.columns == ["conv_id", "place", "part", "segment", "loss", "valid"]
    assert "Python" not in chat.formatted(pieces)._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark):
    assert chat.formatted(chat.segments(spark.createDataFrame([], SCHEMA))).collect() == []


def test_query_has_the_tricky_conversation(spark):
    rows = {r.conv_id: r for r in queries.op6_chat(spark, "/root/testdata/sf0.001").collect()}
    assert rows[-7].n_turns == 2
    assert rows[-7].loss_chars == len(queries.TRICKY)


def test_query_equals_sql_on_broken_conversations(spark, tmp_path):
    """What the machine says, in the query and in its SQL."""
    turns = [
        (1, ["system", "user", "assistant"]),
        (2, ["user", "user", "assistant"]),
        (3, ["assistant", "user"]),
        (4, ["user", None, "assistant"]),
        (5, ["user", "assistant", "user"]),
        (6, ["user", "assistant", "system"]),
        (7, ["tool"]),
        (8, [None, "user", "assistant"]),
    ]
    rows = [(c, i, role, "a <b> \\ c" if i else None) for c, roles in turns for i, role in enumerate(roles)]
    rows += [(9, 0, "user", "x"), (9, 0, "user", "x"), (9, None, "assistant", "first")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op6_chat(spark, str(tmp_path))
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    expected = duck.sql(queries.oracle_sql()["op6_chat"])
    assert found.columns == expected.columns
    got = sorted(map(tuple, found.collect()))
    assert got == sorted(expected.fetchall())
    told = {r[0]: r[-2:] for r in got}
    assert told[1] == (True, 0) and told[2] == (False, 2) and told[5] == (False, 0) and told[7] == (False, 1)
    status = chat.status(chat.segments(table)).collect()
    assert {r.conv_id: (r.valid, r.first_bad or 0) for r in status} == {k: v for k, v in told.items() if k != -7}
