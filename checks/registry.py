"""Registered queries and the SQL each one is compared with.

Both sides are brought to one form: floating point and decimal columns to six decimals,
dates and timestamps to text, whole numbers to 64 bits, arrays to comma-separated text.
"""
from pyspark.sql import DataFrame, functions as F, types as T

from opsloom.sources.adapters import ADAPTERS, Tables, adapter_sql

QUERIES = {}
ORACLES = {}


def plain(df: DataFrame) -> DataFrame:
    """Bring a result to the comparable form."""
    out = []
    for f in df.schema:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = c.cast("double")
            c = F.round(F.round(c, 10), 6) + F.lit(0.0)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c, ",")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register a function from the tables to a DataFrame."""
    def keep(fn):
        def run(spark, folder):
            return plain(fn(Tables(spark, folder)))
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def oracle(select: str, *ctes: str, f: str = "", d: str = "", t: str = "", i: str = "", a: str = "") -> str:
    """SQL text: common table expressions, then a select brought to the comparable form.

    A name among `ctes` stands for a domain table; other entries are written out as
    "name AS (...)". f, d, t, i and a name the float, date, timestamp, integer and
    array columns.
    """
    parts, seen = [], set()
    for c in ctes:
        text = f"{c} AS ({adapter_sql(c)})" if c in ADAPTERS else c
        if text not in seen:
            seen.add(text)
            parts.append(text)
    replace = (
        [f"CAST(round(CAST({c} AS DECIMAL(28,10)), 6) AS DOUBLE) AS {c}" for c in f.split()]
        + [f"CAST(CAST({c} AS DATE) AS VARCHAR) AS {c}" for c in d.split()]
        + [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in t.split()]
        + [f"CAST({c} AS BIGINT) AS {c}" for c in i.split()]
        + [f"array_to_string({c}, ',') AS {c}" for c in a.split()]
    )
    with_ = f"WITH {', '.join(parts)} " if parts else ""
    star = f"* REPLACE ({', '.join(replace)})" if replace else "*"
    return f"{with_}SELECT {star} FROM ({select}) AS _result"


def rnd(x: str, digits: int) -> str:
    """Half-up rounding after dropping float noise, in SQL."""
    return f"CAST(round(CAST({x} AS DECIMAL(28,{digits + 6})), {digits}) AS DOUBLE)"


def div(x: str, y: str) -> str:
    return f"(CAST({x} AS DOUBLE) / NULLIF(CAST({y} AS DOUBLE), 0))"
