"""Small tables on disk, a query over them, and its SQL in DuckDB."""

import math
import os

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

SCHEMAS = {
    "documents": [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())],
    "benchmark": [("item_id", pa.int64()), ("text", pa.string())],
    "conversations": [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())],
    "labels": [("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())],
    "pages": [("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())],
    "embeddings": [("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())],
}


def docs(*texts, ids=None, lang=None):
    """Rows of ``documents``."""
    return [(i if ids is None else ids[k], t, None if lang is None else lang[k], "s", None if t is None else len(t)) for k, (i, t) in enumerate(enumerate(texts))]


def write(folder, **tables):
    """Parquet tables; columns given beyond a table's own are extra ones."""
    for name, rows in tables.items():
        schema = SCHEMAS[name]
        columns = {c: pa.array([r[i] if i < len(r) else None for r in rows], k) for i, (c, k) in enumerate(schema)}
        # extra columns, named like ones the operators add
        for extra in ("score", "row", "digest", "h", "token_count"):
            columns[extra] = pa.array(["x"] * len(rows), pa.string())
        pq.write_table(pa.table(columns), os.path.join(folder, f"{name}.parquet"))
    return folder


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def rows(df, *columns):
    return sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)


def sql_rows(folder, sql, *columns):
    con = duckdb.connect()
    for f in os.listdir(folder):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{folder}/{f}')")
    t = con.execute(sql).to_arrow_table()
    return sorted((tuple(_plain(r[c]) for c in columns) for r in t.to_pylist()), key=repr)


def same_as_sql(spark, folder, module, name):
    got = module.QUERIES[name](spark, folder)
    assert rows(got, *got.columns) == sql_rows(folder, module.ORACLE_SQL[name], *got.columns)
    return got
