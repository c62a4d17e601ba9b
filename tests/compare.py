"""Row comparison between Spark and DuckDB results."""

import glob
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def data(sf):
    return f"/root/testdata/{sf}"


def database(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        if glob.glob(os.path.join(sf_dir, f"{name}.parquet")):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)


def duck_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_key)
    return [names[i] for i in order], rows
