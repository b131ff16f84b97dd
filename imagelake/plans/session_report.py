"""Flagship: scored uploads -> typed outcomes -> validated -> priced -> per-session summary.

events -> pred_log -> encoded outcome (C7 input) -> decode_outcome (C7) ->
confidence_guard (C6) -> price_lookup (F1) -> session_summary (G4).
One job graph: a scan with pruned columns, broadcast joins to the two
15-row dimensions, and one partial aggregate shuffled on session_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..dims import CLASS_NAMES, class_dim, price_dim
from ..operators.enrich import price_lookup
from ..operators.sessions import session_summary
from ..operators.validate import confidence_guard, decode_outcome


def priced_results(spark: SparkSession, sf_dir: str, catalog: str = "app") -> DataFrame:
    """Valid, priced predictions (errors removed, confidence in [0,1])."""
    log = fx.with_outcome(fx.pred_log(spark, sf_dir), class_dim(spark))
    typed = decode_outcome(log.drop("confidence"), "outcome")
    valid = confidence_guard(typed.where(F.col("error").isNull()))
    return price_lookup(valid, price_dim(spark), catalog=catalog)


def session_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_summary(priced_results(spark, sf_dir), CLASS_NAMES)
