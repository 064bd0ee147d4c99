"""Streaming detectors: state per satellite, carried from batch to batch.

A batch adds its rows' sums to the rollup and reads the state of its own satellites: how many
minutes went before, the last of them that look-back windows need, baseline, running sums, last
reset, the events found, and the sums of the newest minute, which is still open. The batch's minutes
go through the batch detectors, which go on from that state, so work follows the batch. Rows of one
satellite are still split into blocks, whatever its share of a batch.

The open minute takes part provisionally: an event at it is shown, but only stays when a later
minute closes it. A row that comes later than its satellite's open minute changes what was already
scored; then, and only for that satellite, the whole rollup is read and scored anew.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perigee import schema as S
from perigee.operators.detectors import HISTORY_SCHEMA, DetectorSettings, detector_signals, first_events, next_history
from perigee.operators.marts import SUMS_COLUMNS, from_sums, merged_sums
from perigee.streaming.ingest import with_trigger
from perigee.streaming.keyed import KeyedTable
from perigee.streaming.marts import SUMS_SCHEMA, add_sums, read_sums

#: Rollup columns that detectors read.
MEASURES = ["battery_soc_mean", "bus_temperature_k_mean", "net_heat_w_mean"]
_SUMS = ["minute_bucket", "slot", *[c for c in SUMS_COLUMNS if c in ("n_rows", "amount") or c.startswith(tuple(f"{m}_" for m in MEASURES))]]
_KINDS = dict(f.strip().split(" ") for f in SUMS_SCHEMA.split(","))
_EVENT = [c for c in S.EVENT_SCHEMA.fieldNames() if c != "sat_id"]
_EVENTS = "array<struct<" + ",".join(f"{c}:{S.EVENT_SCHEMA[c].dataType.simpleString()}" for c in _EVENT) + ">>"
_HISTORY = ["sat_id", "n", "tail", "baseline", "total", "lowest", "last_reset"]
#: History at the end of the closed minutes, events found in them, the open minute with its sums, and the events shown.
STATE_SCHEMA = (
    HISTORY_SCHEMA + f", found {_EVENTS}, open_minute timestamp, open array<struct<" + ",".join(f"{c}:{_KINDS[c]}" for c in _SUMS) + f">>, shown {_EVENTS}"
)


def state_table(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(spark, f"{root}/state", "sat_id", STATE_SCHEMA)


def _first_of_each(events: DataFrame) -> DataFrame:
    """sat_id and, as one list, the earliest event of each detector (at most as many as there are detectors)."""
    first = events.groupBy("sat_id", "detector_name").agg(F.min_by(F.struct(*_EVENT), "sim_time_iso").alias("event"))
    return first.groupBy("sat_id").agg(F.array_sort(F.collect_list("event")).alias("events"))


def new_signals(new: DataFrame, state: DataFrame, settings: DetectorSettings) -> DataFrame:
    """Signals of further minutes, with the satellite's newest minute, which is open. new: see :func:`updated_state`."""
    open_minute = new.groupBy("sat_id").agg(F.max("minute_bucket").alias("open_minute"))
    history = state.select(*_HISTORY).where(F.col("n").isNotNull())
    return detector_signals(from_sums(new, MEASURES), settings, history=history).join(open_minute, "sat_id")


def updated_state(new: DataFrame, signals: DataFrame, state: DataFrame, settings: DetectorSettings) -> DataFrame:
    """The state after further minutes. new: merged sums, none of a minute before the open one of ``state``, which is included."""
    history = state.select(*_HISTORY).where(F.col("n").isNotNull())
    closed = signals.where(F.col("minute_bucket") < F.col("open_minute"))
    found = state.select("sat_id", F.explode("found").alias("event")).select("sat_id", "event.*")
    before = found.unionByName(first_events(closed, settings))
    shown = found.unionByName(first_events(signals, settings))
    open_minute = new.groupBy("sat_id").agg(F.max("minute_bucket").alias("open_minute"))
    still_open = new.join(open_minute, "sat_id").where(F.col("minute_bucket") == F.col("open_minute"))
    still_open = still_open.groupBy("sat_id", "open_minute").agg(F.collect_list(F.struct(*_SUMS)).alias("open"))  # a minute's few rows
    none = F.expr(f"cast(array() as {_EVENTS})")
    return (
        still_open.join(next_history(closed, history, settings), "sat_id", "left")
        .join(_first_of_each(before).withColumnRenamed("events", "found"), "sat_id", "left")
        .join(_first_of_each(shown).withColumnRenamed("events", "shown"), "sat_id", "left")
        .withColumns({"found": F.coalesce("found", none), "shown": F.coalesce("shown", none)})
    )


def start_detectors(
    raw: DataFrame,
    root: str,
    checkpoint: str,
    settings: DetectorSettings | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Keep the sums detectors need (``root``/sums) and, per satellite, state and events (``root``/state) of a raw-view stream."""
    settings = settings or DetectorSettings()

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        add_sums(batch, batch_id, f"{root}/sums", MEASURES)
        added = read_sums(spark, f"{root}/sums", batch_id)
        table, kept = state_table(spark, root), []

        def keep(df: DataFrame) -> DataFrame:  # used several times below
            kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
            return kept[-1]

        try:
            touched = keep(added.groupBy("sat_id").agg(F.min("minute_bucket").alias("earliest")))
            state = keep(table.read(touched, before=batch_id))
            late = keep(touched.join(state, "sat_id").where(F.col("earliest") < F.col("open_minute")).select("sat_id"))
            new, on_time = added.select("sat_id", *_SUMS), state
            if not late.isEmpty():
                on_time = state.join(late, "sat_id", "left_anti")
                whole = read_sums(spark, f"{root}/sums", upto=batch_id).join(late, "sat_id", "left_semi")
                new = new.join(late, "sat_id", "left_anti").unionByName(whole.select("sat_id", *_SUMS))
            new = keep(merged_sums(new.unionByName(on_time.select("sat_id", F.inline("open")))))
            signals = keep(new_signals(new, on_time, settings))
            table.replace(updated_state(new, signals, on_time, settings), touched, batch_id)
        finally:
            for df in kept:
                df.unpersist()

    writer = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(update)
    return with_trigger(writer, every).start()


def read_stream_events(spark: SparkSession, root: str) -> DataFrame:
    """The events so far, those at open minutes included."""
    shown = state_table(spark, root).read().select("sat_id", F.explode("shown").alias("event"))
    return shown.select("sat_id", "event.*").select(*S.EVENT_SCHEMA.fieldNames())
