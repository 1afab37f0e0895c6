"""Small tables with nulls, empty and long texts, ties and repeated rows."""

import duckdb

LONG = "lorem ipsum dolor " * 20_000
ROWS = [
    (1, "A small text, with  two spaces.\n", "a"),
    (2, None, "b"),
    (3, "", None),
    (4, " \t\n", "a"),
    (5, LONG, "a"),
    (5, LONG, "a"),
    (None, "no id here at all today", None),
    (None, None, None),
    (7, "Ünïcode 漢字 and 😀 emoji <|endoftext|> it's 1234", "c"),
    (8, "Ünïcode 漢字 and 😀 emoji <|endoftext|> it's 1234", "c"),
]
SCHEMA = "doc_id long, text string, source string"


def documents(spark, rows=ROWS, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def as_tables(monkeypatch, queries, **frames):
    """Let registered queries read the given frames."""
    monkeypatch.setattr(queries, "table", lambda spark, folder, name: frames[name])


def sql_rows(sql, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    return con.execute(sql).fetchall()
