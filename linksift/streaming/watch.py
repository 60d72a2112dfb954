"""Streams: watch a folder of URL lines, learn from feedback, raise alerts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linksift.operators.online import OnlineState, online_update, state_from_table, state_table
from linksift.operators.parse import with_url_features
from linksift.operators.scoring import Scorer, scan
from linksift.sinks.writers import append_feedback, write_alerts
from linksift.sources.tables import clean_lines


def new_urls(spark: SparkSession, in_dir: str, remember: str = "24 hours", max_files: int = 1000) -> DataFrame:
    """Stream of trimmed URL lines, each once within the time that is remembered.

    The watermark bounds the set of remembered URLs. The stateful step is keyed by URL,
    so all copies of a URL in a batch go to one task.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(in_dir)
    seen = clean_lines(lines.select("value")).withColumn("seen_at", F.current_timestamp())
    return seen.withWatermark("seen_at", remember).dropDuplicatesWithinWatermark(["url"])


def watch(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    scorer: Scorer = Scorer(),
    rules: DataFrame | None = None,
    watchlist: DataFrame | None = None,
    remember: str = "24 hours",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score new lines as they arrive and append the results as parquet."""
    scored = scan(new_urls(spark, in_dir, remember), scorer, rules, watchlist, source="watch")
    return (
        scored.writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "1500 milliseconds"}))
        .start()
    )


def watch_alerts(
    scored: DataFrame, alert_dir: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append the high-risk rows of a scored stream, one folder per batch.

    A batch that is run again overwrites its own folder, so no alert doubles.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_alerts(batch, f"{alert_dir}/batch={batch_id}", mode="overwrite")

    return (
        scored.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def learn_batch(
    spark: SparkSession,
    batch: DataFrame,
    batch_id: int,
    state: OnlineState,
    log_dir: str | None = None,
    rate: float | None = None,
    class_weight: tuple[float, float] = (1.0, 1.0),
) -> OnlineState:
    """Fold one batch of feedback (url, true_label, source) into the state; unreadable URLs are left out.

    The batch is parsed once. Its log folder is its own and is overwritten when the
    batch is run again, so each event is logged once.
    """
    usable = with_url_features(batch, "url", flags=False).filter(F.col("error").isNull()).persist()
    try:
        moved = online_update(state, usable.withColumn("label", F.col("true_label")), rate, class_weight, batch_id)
        if log_dir is not None and moved is not state:
            append_feedback(usable, f"{log_dir}/batch={batch_id}", mode="overwrite")
    finally:
        usable.unpersist()
    return moved


def learn(
    spark: SparkSession,
    feedback: DataFrame,
    state_dir: str,
    initial: OnlineState,
    checkpoint: str,
    log_dir: str | None = None,
    on_state: Callable[[OnlineState], None] | None = None,
    trigger: dict | None = None,
    rate: float | None = None,
    class_weight: tuple[float, float] = (1.0, 1.0),
) -> StreamingQuery:
    """Keep an online model up to date from a feedback stream.

    The state after batch b is written to ``state_dir/after=b``; a batch that is
    run again starts from the state before it, so it counts once. Batch numbers
    belong to the checkpoint: under a new one they start at 0 again, so the mark of
    the last batch that ``initial`` carries from an older stream does not hold here.
    """
    initial = replace(initial, last_batch=-1)

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = initial
        if batch_id > 0:
            before = state_from_table(session.read.parquet(f"{state_dir}/after={batch_id - 1}"), initial.features)
        after = learn_batch(session, batch, batch_id, before, log_dir, rate, class_weight)
        state_table(session, after).write.mode("overwrite").parquet(f"{state_dir}/after={batch_id}")
        if on_state is not None:
            on_state(after)

    return (
        feedback.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
