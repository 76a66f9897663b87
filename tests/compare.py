"""Row-set comparison of a Spark result with a DuckDB one."""

import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def duck_rows(con, sql):
    cursor = con.execute(sql)
    return [c[0] for c in cursor.description], cursor.fetchall()


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def canonical(columns, rows):
    """Rows with columns in name order, sorted; equal floats only, NaN equal to itself."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float) and math.isnan(value):
            return "NaN"
        return value

    shaped = [tuple(cell(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(shaped, key=lambda r: [(v is None, str(v)) for v in r])
