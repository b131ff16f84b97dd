"""Registry of the driver-facing queries (name -> Spark callable, DuckDB twin).

The query definitions live in ``imagelake.plans.checks_*``; each registers a
callable ``(spark, sf_dir) -> DataFrame`` and, when the operator is SQL-checkable,
its DuckDB text.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

MODULES = [
    "imagelake.plans.checks_core",
    "imagelake.plans.checks_eval",
    "imagelake.plans.checks_tensors",
    "imagelake.plans.checks_io",
]


# Timestamps leave the registered queries as fixed-format text (microseconds,
# UTC) in both engines, so the comparison does not depend on how each client
# library represents time values. The operators themselves return TIMESTAMP.
SPARK_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DUCK_TS_FORMAT = "%Y-%m-%d %H:%M:%S.%f"


def register(name: str, sql: str | None = None, ts_cols: tuple[str, ...] = ()):
    def deco(fn):
        if ts_cols:
            def run(spark, sf_dir, _fn=fn):
                from pyspark.sql import functions as F
                df = _fn(spark, sf_dir)
                for c in ts_cols:
                    df = df.withColumn(c, F.date_format(F.col(c), SPARK_TS_FORMAT))
                return df
            run.__name__, run.__doc__ = fn.__name__, fn.__doc__
            QUERIES[name] = run
        else:
            QUERIES[name] = fn
        if sql is not None:
            if ts_cols:
                repl = ", ".join(f"strftime({c}, '{DUCK_TS_FORMAT}') AS {c}" for c in ts_cols)
                sql_out = f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS registered_q"
            else:
                sql_out = sql
            ORACLE[name] = sql_out
        return fn
    return deco


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(m)
