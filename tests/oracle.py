"""Compare a Spark result with its SQL twin, as multisets of rows."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'").fetchall()
    return con


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    """Row counts, columns, and the number of rows found on one side only."""
    ours = spark_df.toArrow()
    con.register("ours", ours)
    theirs = con.execute(sql).to_arrow_table()
    con.register("theirs", theirs)
    columns = sorted(ours.column_names)
    report = {"rows": (ours.num_rows, theirs.num_rows), "columns": (columns, sorted(theirs.column_names))}
    if columns == report["columns"][1]:
        listed = ", ".join(f'"{c}"' for c in columns)
        report["differing"] = con.execute(
            f"SELECT (SELECT count(*) FROM (SELECT {listed} FROM ours EXCEPT ALL SELECT {listed} FROM theirs)) + "
            f"(SELECT count(*) FROM (SELECT {listed} FROM theirs EXCEPT ALL SELECT {listed} FROM ours))"
        ).fetchall()[0][0]
        report["types"] = {
            c: (str(ours.schema.field(c).type), str(theirs.schema.field(c).type))
            for c in columns if ours.schema.field(c).type != theirs.schema.field(c).type
        }
    con.unregister("ours")
    con.unregister("theirs")
    return report
