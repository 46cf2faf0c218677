"""Rows for the operators' tests."""

import duckdb

SF = "/root/testdata/sf0.01"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def given(sf=SF, table="documents", columns="doc_id, text"):
    return duckdb.sql(f"SELECT {columns} FROM '{sf}/{table}.parquet'").fetchall()


def oracle_rows(sql, sf=SF):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    out = con.execute(sql)
    names = [d[0] for d in out.description]
    return sorted((dict(zip(names, r)) for r in out.fetchall()), key=lambda r: (r.get("item_id", 0), r.get("rank", 0), r["doc_id"]))


def by_id(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r.get("item_id", 0), r.get("rank", 0), r["doc_id"]))


#: Nulls, empty and blank texts, one giant word, repeated rows, ties.
EDGES = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "x" * 300_000), (5, "a b c d e f g h i j"),
         (6, "a b c d e f g h i j"), (6, "a b c d e f g h i j"), (None, "a b c d e f g h i j"), (None, None),
         (7, "line that is long enough\nline that is long enough\n\nb"), (8, "LINE that is long enough  \nc"),
         (9, "é ﬁ 漢字 <|endoftext|> </s> \x00   end")]
