"""Compare registered queries with their SQL in DuckDB."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        sorted(columns),
        sorted((tuple(row[i] for i in order) for row in rows), key=repr),
    )


def spark_result(df):
    return sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def duck_result(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted_rows(columns, result.fetchall())
