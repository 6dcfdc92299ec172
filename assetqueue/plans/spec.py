"""Output normalisation shared by the Spark queries and their DuckDB oracles.

Each registered query declares its output columns with a kind:
``i`` integer -> BIGINT, ``f`` float -> DOUBLE rounded to 6 digits (floor(x*1e6+0.5)/1e6 on both sides:
the engines' own round() differ on exact ties),
``s`` string, ``d`` date -> 'YYYY-MM-DD', ``t`` timestamp -> 'YYYY-MM-DD HH:MM:SS',
``b`` boolean. Both sides are projected through the same spec, so names,
types and rounding agree by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def parse(spec: str):
    out = []
    for item in spec.split():
        name, kind = item.rsplit(":", 1)
        out.append((name, kind))
    return out


def finalize(df: DataFrame, spec: str) -> DataFrame:
    cols = []
    for name, kind in parse(spec):
        c = F.col(name)
        if kind == "i":
            c = c.cast("bigint")
        elif kind == "f":
            # same IEEE operations as the SQL side, so ties round alike
            c = (F.floor(c.cast("double") * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6))
        elif kind == "s":
            c = c.cast("string")
        elif kind == "d":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind == "t":
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "b":
            c = c.cast("boolean")
        else:
            raise ValueError(kind)
        cols.append(c.alias(name))
    return df.select(*cols)


def wrap_sql(sql: str, spec: str) -> str:
    cols = []
    for name, kind in parse(spec):
        q = f'"{name}"'
        if kind == "i":
            e = f"CAST({q} AS BIGINT)"
        elif kind == "f":
            e = f"CAST(floor(CAST({q} AS DOUBLE) * 1e6 + 0.5e0) AS DOUBLE) / 1e6"
        elif kind == "s":
            e = f"CAST({q} AS VARCHAR)"
        elif kind == "d":
            e = f"strftime(CAST({q} AS DATE), '%Y-%m-%d')"
        elif kind == "t":
            e = f"strftime(CAST({q} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')"
        elif kind == "b":
            e = f"CAST({q} AS BOOLEAN)"
        else:
            raise ValueError(kind)
        cols.append(f"{e} AS {q}")
    return f"SELECT {', '.join(cols)} FROM (\n{sql}\n) AS q"
