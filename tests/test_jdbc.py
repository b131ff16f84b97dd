"""Prediction log through JDBC (B3, A7) on an in-memory Derby database: no server,
no port. A replayed batch inserts nothing twice."""

from __future__ import annotations

from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from imagelake import fixtures as fx
from imagelake.sinks.predictions import predictions_sink
from imagelake.sources.fetch import predictions_scan

JDBC = {"url": "jdbc:derby:memory:imagelake_test;create=true",
        "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_jdbc_sink_is_idempotent_and_scannable(spark):
    log = fx.pred_log(spark, SF_SMALL).limit(40).select(
        "session_id", "filename", F.lit("u").alias("image_url"), F.lit("kiwi").alias("fruit"),
        "confidence", "received_at", "processed_at",
        F.when(F.col("is_error"), F.lit("bad image")).alias("error"))
    sink = predictions_sink(jdbc=JDBC, table="PREDICTIONS", errors_table="PREDICTION_ERRORS")
    sink(log, 0)
    sink(log, 0)
    n_ok = log.where("error IS NULL").count()
    out = predictions_scan(spark, jdbc={**JDBC, "dbtable": "PREDICTIONS"})
    assert out.count() == n_ok
    assert out.select("id").distinct().count() == n_ok
    sid = log.where("error IS NULL").first().session_id
    one = predictions_scan(spark, jdbc={**JDBC, "dbtable": "PREDICTIONS"}, session_id=sid)
    assert one.count() == log.where(f"error IS NULL AND session_id = '{sid}'").count()
    errs = predictions_scan(spark, jdbc={**JDBC, "dbtable": "PREDICTION_ERRORS"})
    assert errs.count() == log.where("error IS NOT NULL").count()
