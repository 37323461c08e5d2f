"""Output normalisation shared by a query and its DuckDB oracle: the same column names,
order and types on both sides; doubles rounded (and -0 folded to 0) so that summation order
does not change the hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Doubles are rounded twice (to N+3, then N places) on both sides: the first step absorbs
# last-bit differences from summation order, the second gives the compared precision.
# spec: list of (column, kind); kind in s (string), i (bigint), date, dN (double rounded to N places)


def round_like_oracle(c, places: int):
    """Half away from zero on the binary value (``floor(|x|·10^p + 0.5)``), the same formula the
    oracle's ROUND uses for doubles, so ties resolve identically; -0 becomes 0."""
    m = float(10 ** places)
    special = c.isNull() | F.isnan(c) | (c == float("inf")) | (c == float("-inf"))
    r = F.signum(c) * F.floor(F.abs(c) * m + F.lit(0.5)) / m
    # above 2^52 / m a double has no digit to round, and the 64-bit floor would clamp it
    return F.when(special | (F.abs(c) * m >= float(2 ** 52)), c).otherwise(r) + F.lit(0.0)


def finalize(df: DataFrame, spec) -> DataFrame:
    cols = []
    for name, kind in spec:
        c = F.col(name)
        if kind == "s":
            cols.append(c.cast("string").alias(name))
        elif kind == "i":
            cols.append(c.cast("bigint").alias(name))
        elif kind == "date":
            cols.append(F.date_format(c, "yyyy-MM-dd").alias(name))
        elif kind.startswith("d"):
            n = int(kind[1:])
            cols.append(round_like_oracle(round_like_oracle(c.cast("double"), n + 3), n).alias(name))
        else:
            raise ValueError(kind)
    return df.select(*cols)


def wrap_sql(inner: str, spec, ctes: str = "") -> str:
    cols = []
    for name, kind in spec:
        q = '"' + name.replace('"', '""') + '"'
        if kind == "s":
            cols.append(f"CAST({q} AS VARCHAR) AS {q}")
        elif kind == "i":
            cols.append(f"CAST({q} AS BIGINT) AS {q}")
        elif kind == "date":
            cols.append(f"strftime({q}, '%Y-%m-%d') AS {q}")
        else:
            n = int(kind[1:])
            cols.append(f"ROUND(ROUND(CAST({q} AS DOUBLE), {n + 3}), {n}) + 0.0 AS {q}")
    head = f"WITH {ctes} " if ctes else ""
    return f"{head}SELECT {', '.join(cols)} FROM ({inner}) AS q"
