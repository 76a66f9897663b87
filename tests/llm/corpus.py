"""What the tests of this folder share."""

import os

import duckdb

SF_DIR = "/root/testdata/sf0.01"
TABLES = ("documents", "pages", "embeddings")


def duck():
    con = duckdb.connect()
    for name in TABLES:
        path = f"{SF_DIR}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def documents(spark, texts, first=0):
    return spark.createDataFrame(list(enumerate(texts, first)), "doc_id long, text string")
