"""Query registry: name -> (Spark builder, DuckDB oracle SQL).

Every query reads the given tables (or what Spark derives from them) whole.
Output conventions shared by both sides: doubles rounded to 6 places,
integers as BIGINT, timestamps as timestamp without time zone.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.plans import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def finalize(df: DataFrame) -> DataFrame:
    """Round doubles to 6 places, widen integers to bigint (both sides agree)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, 6)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def out_sql(spec: str, source: str, where: str = "", order: str = "") -> str:
    """SELECT list from a compact spec "name:type, ..." (d=double, l=bigint, other=as is)."""
    items = []
    for part in spec.split(","):
        name, _, typ = part.strip().partition(":")
        if typ == "d":
            items.append(f"round(CAST({name} AS DOUBLE), 6) AS {name}")
        elif typ == "l":
            items.append(f"CAST({name} AS BIGINT) AS {name}")
        else:
            items.append(name)
    s = f"SELECT {', '.join(items)} FROM {source}"
    if where:
        s += f" WHERE {where}"
    if order:
        s += f" ORDER BY {order}"
    return s


def register(name: str, sql_text: str | None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: finalize(fn(spark, sf_dir))
        if sql_text is not None:
            ORACLE[name] = sql_text
        return fn
    return deco


from tidewatch.plans import queries_core  # noqa: E402,F401  (registers)
from tidewatch.plans import queries_spec  # noqa: E402,F401  (registers)
from tidewatch.plans import queries_io  # noqa: E402,F401  (registers)
from tidewatch.plans import queries_more  # noqa: E402,F401  (registers)
from tidewatch.plans import queries_feeds  # noqa: E402,F401  (registers)
from tidewatch.plans import queries_extra  # noqa: E402,F401  (registers)
from tidewatch.plans import queries_replay  # noqa: E402,F401  (registers)
