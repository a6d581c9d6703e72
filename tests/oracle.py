"""Compare a Spark result with DuckDB's: names, kinds of type, and rows as a bag."""

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def connect(sf_dir):
    database = duckdb.connect()
    for name in TABLES:
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return database


def compare(result, database, sql):
    expected = database.sql(sql)
    names = sorted(result.columns)
    assert names == sorted(expected.columns), (names, sorted(expected.columns))
    kinds = dict(zip(expected.columns, map(str, expected.types), strict=True))
    for name, kind in result.dtypes:
        assert KINDS.get(kind, kind.upper().replace(" ", "")) == kinds[name].replace(" ", ""), (name, kind, kinds[name])
    ours = Counter(tuple(row[name] for name in names) for row in result.collect())
    quoted = ", ".join(f'"{name}"' for name in names)
    theirs = Counter(database.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    assert ours == theirs, (
        sum(ours.values()),
        sum(theirs.values()),
        list((ours - theirs).items())[:3],
        list((theirs - ours).items())[:3],
    )
    return sum(ours.values())
