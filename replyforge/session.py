"""Session settings this library is meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A second copy of a task would call the model, fetcher or verifier a second time.
    "spark.speculation": "false",
    # Chunks of a work ledger run side by side; none waits for all tasks of the one before.
    "spark.scheduler.mode": "FAIR",
    # Rows with long texts fill Arrow batches quickly. Large batches in flight have been seen to bring down the JVM
    # when the Python side of a task fails; small ones let the failure arrive as an error.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings to a session builder; what the caller sets afterwards wins."""
    return builder.config(map=RECOMMENDED)
