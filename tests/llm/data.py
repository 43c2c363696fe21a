"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import duckdb

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sample(n: int = 200) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) of the smallest documents table."""
    return duckdb.connect().execute(
        f"SELECT doc_id, text, lang, source, n_chars FROM '{SF}/documents.parquet' ORDER BY doc_id LIMIT {n}").fetchall()


def awkward(n: int = 60) -> list[tuple]:
    """Sample rows, and nulls in every column, empty and blank texts, repeated rows, a long text."""
    rows = sample(n)
    long = (" ".join(r[1] for r in rows[:20]) + "\n") * 12
    return rows + [
        (None, rows[0][1], "en", "src0", 5), (None, rows[1][1], None, None, None), (9001, None, "en", "src0", None),
        (9002, "", "en", "src1", 0), (9003, " \n\t ", "en", "src1", 4), (9004, "???", None, "src2", 3), rows[2], rows[2],
        (9005, long, "en", "src3", len(long)), (9006, "a", "en", "src3", 1), (9007, "emoji \U0001f600 x", "en", "src4", 9)]


def frame(spark, rows, schema: str = SCHEMA):
    return spark.createDataFrame(rows, schema)


def with_clash(df, *names: str):
    """The table with more columns, named like the results and helpers of the operators."""
    for name in names:
        df = df.selectExpr("*", f"'x' as `{name}`")
    return df
