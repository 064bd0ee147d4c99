import json
from datetime import timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from perigee import schema as S
from perigee.sources import wire
from helpers import T0, record, telemetry


def messages(spark, values):
    rows = [(b"BIRD-1", v if isinstance(v, bytes) else v.encode()) for v in values]
    return spark.createDataFrame(rows, "key binary, value binary")


def body(**over):
    return json.dumps({**record(), **over}, separators=(",", ":"))


def test_bad_messages_are_counted_not_fatal(spark):
    good = [body(), body(sim_time_iso=(T0 + timedelta(hours=1)).isoformat())]
    m = messages(spark, [good[0], "not valid json {", json.dumps({"sat_id": "BIRD-1"}), good[1]])
    assert wire.decoded(m).count() == 2
    assert wire.rejected(m).count() == 2


@pytest.mark.parametrize(
    "value,reason",
    [
        ("not valid json {", "bad_json"),
        ("[1, 2]", "bad_json"),
        ("", "bad_json"),
        (b"\xff\xfe{}", "bad_json"),
        ("{}", "missing"),
        (json.dumps({k: v for k, v in record().items() if k != "net_heat_w"}), "missing"),
        (body(attitude_deg=1.0), "extra"),
        (body(net_heat_w="warm"), "bad_type"),
        (body(net_heat_w=None), "bad_type"),
        (body(eclipsed=3.5), "bad_type"),
        (body(sim_time_iso="yesterday"), "bad_time"),
    ],
)
def test_reject_reasons(spark, value, reason):
    (row,) = wire.rejected(messages(spark, [value])).collect()
    assert row["reject_reason"] == reason
    assert row["key"] == b"BIRD-1"


def test_encode_decode_round_trip(spark):
    recs = [record("A"), record("B", eclipsed=True, longitude_deg=-0.1234567890123)]
    encoded = wire.encoded(telemetry(spark, recs))
    keys = sorted(bytes(r["key"]) for r in encoded.collect())
    assert keys == [b"A", b"B"]
    assert json.loads(bytes(encoded.where(F.col("key") == b"B").first()["value"])) == recs[1]
    back = sorted((r.asDict() for r in wire.decoded(encoded).collect()), key=lambda r: r["sat_id"])
    assert back == recs


def test_counters(spark):
    seen = Observation("ingest")
    wire.counted(wire.parsed(messages(spark, [body(), body(), "x"])), seen).collect()
    assert seen.get == {"messages_seen": 3, "messages_received": 2, "decode_errors": 1}


def test_json_is_parsed_once_per_message(spark):
    from helpers import plan_of

    m = messages(spark, [body()])
    for df in (wire.decoded(m), wire.rejected(m)):
        assert plan_of(df).count("from_json") == 1


def test_flatten_ticks(spark):
    rec = record(eclipsed=True)
    geo = {v: [rec[f"{v}_{a}"] for a in "xyz"]
           for v in ("position_eci_km", "velocity_eci_km_s", "sun_vector_eci")}
    geo |= {k: rec[k] for k in ("eclipsed", "latitude_deg", "longitude_deg", "altitude_km")}
    tick = {
        "sat_id": rec["sat_id"], "sim_time": rec["sim_time_iso"], "geo": geo,
        "eps": {k: rec[k] for k in S.TELEMETRY_COLUMNS[15:20]},
        "thermal": {k: rec[k] for k in S.TELEMETRY_COLUMNS[20:]},
    }
    eps = ", ".join(f"{k}: double" for k in tick["eps"])
    thermal = ", ".join(f"{k}: double" for k in tick["thermal"])
    schema = (
        "sat_id string, sim_time timestamp, geo struct<position_eci_km: array<double>, "
        "velocity_eci_km_s: array<double>, sun_vector_eci: array<double>, eclipsed: boolean, "
        "latitude_deg: double, longitude_deg: double, altitude_km: double>, "
        f"eps struct<{eps}>, thermal struct<{thermal}>"
    )
    df = spark.createDataFrame([json.dumps(tick)], "string").select(
        F.from_json("value", schema).alias("t")
    )
    (got,) = wire.flatten_ticks(df.select("t.*")).collect()
    assert got.asDict() == rec
