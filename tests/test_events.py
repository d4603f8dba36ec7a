"""JSON bodies with drifting fields, as a batch and as a job over a watched folder."""

import json
from datetime import datetime, timedelta

from riskloom.__main__ import main
from riskloom.schema import KEYED_TRANSACTION_SCHEMA
from riskloom.sources.events import read_events, split_events
from riskloom.streaming import scoring, sinks, windows

USABLE = [
    {"event_id": 1, "user_id": 7, "Time": 3.5, "Amount": 10, "Class": 0, "V1": -1.25},
    {"event_id": "2", "Time": "4", "Amount": "10.50", "Class": None, "region": {"new": ["field"]}},
    {"Amount": 1e3, "Time": 0, "event_id": 3, "Class": 1.0},
]
UNUSABLE = {
    "{\"event_id\": 4, \"Time\": 1": "no JSON object",
    "plain text": "no JSON object",
    "[1, 2]": "no JSON object",
    "null": "no JSON object",
    json.dumps({"event_id": 5, "Time": 1}): "Amount: missing",
    json.dumps({"event_id": None, "Time": 1, "Amount": 2}): "event_id: missing",
    json.dumps({"event_id": 6.5, "Time": "noon", "Amount": 2}): "event_id: no bigint; Time: no double",
    json.dumps({"event_id": 7, "Time": 1, "Amount": 2, "Class": 99999999999}): "Class: no int",
    json.dumps({"event_id": 8, "Time": 1, "Amount": 2, "V1": {"a": 1}}): "V1: no double",
}
EXPECTED = {(1, 7, 3.5, 10.0, 0, -1.25), (2, None, 4.0, 10.5, None, None), (3, None, 0.0, 1000.0, 1, None)}


def rows(df):
    return {(r.event_id, r.user_id, r.Time, r.Amount, r.Class, r.V1) for r in df.collect()}


def test_batch_parts_usable_bodies_from_others(spark):
    bodies = [json.dumps(u) for u in USABLE] + list(UNUSABLE) + [None, ""]
    table = spark.createDataFrame([(b, "x") for b in bodies], "body string, _event string")
    events = read_events(table, KEYED_TRANSACTION_SCHEMA, required=["event_id", "Time", "Amount"])
    accepted, rejects = split_events(events)
    assert accepted.schema.names == KEYED_TRANSACTION_SCHEMA.names
    assert rows(accepted) == EXPECTED and accepted.count() == 3
    assert {r._body: r._reason for r in rejects.collect()} == UNUSABLE | {None: "no JSON object", "": "no JSON object"}
    assert events.filter("event_id = -1").count() == 0 and read_events(table.limit(0), KEYED_TRANSACTION_SCHEMA).count() == 0


def test_bytes_and_optional_fields(spark):
    table = spark.createDataFrame([(bytearray(b"{}"),), (bytearray(b"{\"V1\": 2}"),)], "body binary")
    accepted, rejects = split_events(read_events(table, KEYED_TRANSACTION_SCHEMA))
    assert {r.V1 for r in accepted.collect()} == {None, 2.0} and rejects.count() == 0


def test_job_goes_on_where_it_stopped(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    arguments = ["events", "--input", str(folder), "--output", out, "--checkpoint", str(tmp_path / "c")]
    (folder / "first").write_text("\n".join([json.dumps(u) for u in USABLE[:2]] + list(UNUSABLE)[:4]) + "\n\n")
    main(arguments)
    assert spark.read.parquet(f"{out}/accepted/batch=*").count() == 2
    (folder / "second").write_text("\n".join([json.dumps(USABLE[2])] + list(UNUSABLE)[4:]))
    main(arguments)
    accepted = spark.read.parquet(f"{out}/accepted/batch=*")
    assert rows(accepted) == EXPECTED and accepted.count() == 3
    assert {r._body: r._reason for r in spark.read.parquet(f"{out}/rejects/batch=*").collect()} == UNUSABLE
    assert scoring.apply_rules(accepted).count() == 3


def test_minutes_add_up_whenever_rows_come(spark, tmp_path):
    """Rows far behind the others count too, and rows without a time in no minute."""
    start = datetime(2024, 1, 1)
    batches = [[(0, 0, 1), (59, 1, 3), (3600, 1, 2)], [(30, 1, 5), (None, 1, 0)], [(7200, 0, 0), (61, 0, 4)]]
    schema = "event_time timestamp, prediction int, processing_time timestamp"
    for number, batch in enumerate(batches):
        rows = [(at and start + timedelta(seconds=s), p, start + timedelta(seconds=(s or 0) + wait)) for s, p, wait in batch for at in [s is not None]]
        spark.createDataFrame([(e or None, p, a) for e, p, a in rows], schema).coalesce(1).write.json(f"{tmp_path}/in{number}")
        stream = spark.readStream.schema(schema).json(f"{tmp_path}/in*")
        sinks.run_to_end(sinks.windows_to_table(stream, f"{tmp_path}/out", f"{tmp_path}/c"))
    got = {(r.window_start - start).seconds: (r.transactions, r.alerts, round(r.avg_latency, 3), r.max_latency) for r in sinks.read_windows(spark, f"{tmp_path}/out").collect()}
    assert got == {0: (3, 2, 3.0, 5.0), 60: (1, 0, 4.0, 4.0), 3600: (1, 1, 2.0, 2.0), 7200: (1, 0, 0.0, 0.0)}
    plain = windows.merged_windows(windows.partial_windows(spark.createDataFrame([], schema).drop("processing_time")))
    assert plain.columns == ["window_start", "transactions", "alerts"] and plain.count() == 0
