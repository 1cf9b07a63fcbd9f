import json
import random
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wayfold.sources import feed, files, schemas
from wayfold.plans.current import CurrentTable
from wayfold.streaming import dedup, windows


def feed_message():
    stop = lambda **k: (2, feed.encode([(1, k.get("seq")), (2, k.get("arrival")), (3, k.get("departure")), (4, k.get("stop")), (5, k.get("relation"))]))
    trip = feed.encode([(1, "T"), (3, "20261102"), (5, "R-1"), (6, 1)])
    updates = [stop(seq=1, stop="A", arrival=feed.encode([(1, 0), (2, 1_790_000_000)]), relation=0), stop(seq=2, stop="B", relation=1), stop(stop="C", departure=feed.encode([(1, -30)]))]
    entities = [feed.encode([(1, "e1"), (3, feed.encode([(1, trip), *updates]))]), feed.encode([(1, "e2"), (4, b"")]), feed.encode([(1, "e3"), (5, b"")]), feed.encode([(1, "e4"), (2, 1)])]
    return feed.encode([(1, feed.encode([(1, "2.0"), (3, 1_790_000_000)])), *[(2, e) for e in entities]])


def test_feed_keeps_zero_apart_from_absent(spark, tmp_path):
    rows = list(feed.stop_rows(feed_message()))
    assert rows[0] == ("e1", "T", "R-1", 1, "20261102", "A", 1, "SCHEDULED", 0, 1_790_000_000, None, None)
    assert rows[1][5:] == ("B", 2, "SKIPPED", None, None, None, None)
    assert rows[2][5:] == ("C", None, "SCHEDULED", None, None, -30, None)
    assert feed.entity_counts(feed_message()) == {"entity_count": 4, "trip_update_count": 1, "vehicle_position_count": 1, "alert_count": 1, "deleted_entity_count": 1}
    (tmp_path / "a.pb").write_bytes(feed_message())
    (tmp_path / "b.pb").write_bytes(b"\x0a\xff\x01broken")
    assert feed.read_feed(spark, str(tmp_path), strict=False).count() == 3
    with pytest.raises(Exception, match="cut off"):
        feed.read_feed(spark, str(tmp_path)).count()


def test_manifest(spark, tmp_path):
    lines = [{"attempt_number": 2, "request_started_at": "2026-11-02T10:00:00+02:00", "status": "saved"}, {"run_summary": {"a": 1}}, {"attempt_number": 1, "recorded_at": "2026-11-02T07:00:00Z", "status": "failed"}]
    (tmp_path / "m.jsonl").write_text("\n\n".join(map(json.dumps, lines)))
    rows = files.attempts(files.read_jsonl(spark, str(tmp_path / "m.jsonl"), schemas.ATTEMPTS)).orderBy("attempt_number").collect()
    assert [(r.attempt_number, r.request_started_at.hour) for r in rows] == [(1, 7), (2, 8)]
    with pytest.raises(Exception, match="no time zone"):
        spark.createDataFrame([("2026-11-02T10:00:00",)], "x string").select(files.zoned_time(F.col("x"))).collect()
    (tmp_path / "bad.jsonl").write_text("{broken")
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "bad.jsonl"), schemas.ATTEMPTS).collect()


def test_csv_and_zip(spark, tmp_path):
    text = '﻿stop_id,stop_name\n 1 ,"A, B"\n,x\n1,NULL\n2,\n'
    (tmp_path / "stops.csv").write_text(text.lstrip("﻿"))
    rows = files.read_csv(spark, str(tmp_path / "stops.csv"), "stop_id string, stop_name string").collect()
    assert [r.stop_name for r in rows] == ["A, B", "x", None, None] and rows[1].stop_id is None
    with zipfile.ZipFile(tmp_path / "g.zip", "w") as z:
        z.writestr("stops.txt", text)
    assert sorted(r[0] for r in files.zip_ids(spark, str(tmp_path / "g.zip"), "stops.txt", "stop_id").collect()) == ["1", "2"]


def test_a_long_member_of_a_zip_is_read_in_blocks(spark, tmp_path, monkeypatch):
    line = "".join(f'"{k % 1000:04}  ","a ""quoted""\nname, {k}"\r\n' for k in range(20_000))
    with zipfile.ZipFile(tmp_path / "g.zip", "w", zipfile.ZIP_DEFLATED) as z, z.open("stops.txt", "w") as out:
        out.write(b"\xef\xbb\xbfstop_id,stop_name\n")
        for _ in range(40):
            out.write(line.encode())
    # a block is all that is unpacked at a time
    held, opened = [], zipfile.ZipExtFile.read
    content = (tmp_path / "g.zip").read_bytes()
    monkeypatch.setattr(zipfile.ZipExtFile, "read", lambda self, n=-1: (held.append(n), opened(self, n))[1])
    frame = type("Frame", (), {"mapInArrow": lambda self, run, schema: type("Out", (), {"distinct": lambda s: list(run(iter([pa.RecordBatch.from_arrays([pa.array([content])], ["content"])])))})(), "select": lambda self, c: self})
    reader = type("Reader", (), {"format": lambda self, f: self, "load": lambda self, p: frame()})
    blocks = files.zip_ids(type("Session", (), {"read": reader()})(), "x", "stops.txt", "stop_id")
    assert len(blocks) > 1 and max(held) <= files.ZIP_BLOCK and {v for b in blocks for v in b.column(0).to_pylist()} == {f"{k:04}" for k in range(1000)}
    monkeypatch.undo()
    assert files.zip_ids(spark, str(tmp_path / "g.zip"), "stops.txt", "stop_id").count() == 1000


def test_parquet_sink_and_strict_source(spark, tmp_path):
    rows = spark.range(100).withColumn("x", F.col("id").cast("string")).coalesce(1)
    path = str(tmp_path / "out")
    assert files.write_parquet(rows, path, 30) == 100
    assert len([p for p in (tmp_path / "out").iterdir() if p.name.endswith(".zstd.parquet")]) == 4
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        files.write_parquet(rows, path)
    assert files.read_parquet(spark, path, "ID long, x string").count() == 100
    with pytest.raises(ValueError, match="x"):
        files.read_parquet(spark, path, "id long, x int")


def test_file_checksums(spark, tmp_path):
    import hashlib

    (tmp_path / "f").mkdir()
    (tmp_path / "f/a.bin").write_bytes(b"1")
    (tmp_path / "f/b.bin").write_bytes(b"2")
    listed = spark.createDataFrame([("a.bin", hashlib.sha256(b"1").hexdigest()), ("b.bin", "0"), ("c.bin", "0")], "name string, checksum_sha256 string")
    assert {r.name: r.state for r in files.verified_files(spark, str(tmp_path / "f"), listed).collect()} == {"a.bin": "ok", "b.bin": "corrupt", "c.bin": "missing"}


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    schema = "id long, ts timestamp"
    rows = lambda lo, hi: spark.range(lo, hi).selectExpr("id", "timestamp'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id) AS ts").coalesce(1)
    rows(0, 50).write.parquet(str(tmp_path / "in"))
    into = f"file://{tmp_path}/out"
    assert dedup.ingest(spark, str(tmp_path / "in"), schema, "id", "ts", into=into).count() == 50
    rows(30, 80).write.mode("append").parquet(str(tmp_path / "in"))
    assert dedup.ingest(spark, str(tmp_path / "in"), schema, "id", "ts", into=into).count() == 80


def test_three_row_sets(spark, tmp_path):
    event = feed.encode([(1, 60), (2, 1_790_000_060), (3, 5)])
    trip = feed.encode([(1, "T"), (2, "08:00:00"), (3, "20261102"), (4, 3), (5, "R-1")])
    cancelled = feed.encode([(1, trip), (3, feed.encode([(1, "V")])), (4, 1_790_000_000), (5, -7)])
    stop = feed.encode([(1, feed.encode([(1, "U")])), (2, feed.encode([(2, event), (4, "A")]))])
    entities = [feed.encode([(1, "e1"), (3, cancelled)]), feed.encode([(1, "e2"), (2, 1), (3, stop)])]
    (tmp_path / "s1.pb").write_bytes(feed.encode([(1, feed.encode([(1, "2.0"), (3, 1_790_000_000)])), *[(2, e) for e in entities]]))
    read = lambda kind: feed.read_feed(spark, str(tmp_path), rows=kind).orderBy("snapshot_id").collect()
    first, second = sorted(read("trip"), key=lambda r: r.entity_id)
    assert first[3:14] == ("e1", "T", "R-1", None, "20261102", "08:00:00", "CANCELED", "V", 1_790_000_000, -7, 0) and first.snapshot_id == "s1"
    assert second.entity_id == "e2" and second.stop_time_update_count == 1 and second.trip_schedule_relationship is None
    (row,) = read("stop")
    assert (row.entity_id, row.trip_id, row.arrival_uncertainty_seconds, row.departure_uncertainty_seconds) == ("e2", "U", 5, None)
    assert row.arrival_timestamp.timestamp() == 1_790_000_060 and row.stop_schedule_relationship is None
    (row,) = read("feed")
    assert row[3:11] == (1_790_000_000, "2.0", 2, 2, 1, 0, 0, 1)


def test_field_profile(spark):
    trip = feed.encode([(1, "T"), (2, "09:00:00"), (3, "20261102"), (4, 3), (5, "R-9"), (6, 0)])
    whole = feed.encode([(1, 30), (2, 1_793_600_000), (3, 4)])
    a = feed.encode([(1, trip), (3, feed.encode([(1, "bus 7")])), (4, 1_793_600_001), (5, 12), (2, feed.encode([(1, 1), (4, "A"), (2, whole), (3, whole), (5, 0)]))])
    b = feed.encode([(1, feed.encode([(1, "U")])), (2, feed.encode([(4, "B"), (2, feed.encode([(2, 1_793_600_002)])), (5, 1)])), (2, feed.encode([(1, 3), (4, "C"), (3, b"")]))])
    entities = [feed.encode([(1, "x"), (3, a)]), feed.encode([(1, "y"), (3, b)]), feed.encode([(1, "z"), (4, b"")]), feed.encode([(1, "w"), (2, 1)])]
    good = feed.encode([(1, feed.encode([(1, "2.0")])), *[(2, e) for e in entities]])
    rows = spark.createDataFrame([(good,), (good,), (b"\x0a\xff\x01broken",), (None,), (b"",)], "content binary")
    counts = {(r.kind, r.name): r.n for r in feed.profile(rows).collect()}
    assert {k[1]: n for k, n in counts.items() if k[0] == "total"} == {"entity_count": 8, "trip_update_count": 4, "vehicle_position_count": 2, "deleted_entity_count": 2, "stop_time_update_count": 6, "snapshots_profiled": 3, "snapshots_failed": 2}
    assert {k[1]: n for k, n in counts.items() if k[0] == "relationship"} == {"trip.CANCELED": 2, "stop_time_update.SCHEDULED": 2, "stop_time_update.SKIPPED": 2}
    got = {r.field: (r.present, r.denominator, r.percentage) for r in feed.field_availability(rows).collect()}
    assert set(got) == set(feed.PROFILED)
    assert got["trip.trip_id"] == (4, 4, 100.0) and got["trip.direction_id"] == (2, 4, 50.0) and got["trip_update.vehicle_id"] == (2, 4, 50.0)
    assert got["stop_time_update.stop_sequence"] == (4, 6, 66.6667) and got["stop_time_update.departure"] == (4, 6, 66.6667)
    assert got["departure.delay"] == (2, 6, 33.3333) and got["arrival.time"] == (4, 6, 66.6667)
    assert all(r.percentage == 0.0 and r.denominator == 0 for r in feed.field_availability(rows.limit(0)).collect())


def test_checksums_come_before_decoding(spark, tmp_path):
    import hashlib

    (tmp_path / "a.pb").write_bytes(feed_message())
    listed = lambda sha: spark.createDataFrame([("a.pb", sha)], "name string, checksum_sha256 string")
    assert feed.read_feed(spark, str(tmp_path), inventory=listed(hashlib.sha256(feed_message()).hexdigest())).count() == 3
    for wrong in (listed("0"), listed("0").limit(0)):
        with pytest.raises(Exception, match="checksum differs"):
            feed.read_feed(spark, str(tmp_path), inventory=wrong).count()


def test_files_and_uploads(spark, tmp_path):
    import hashlib

    (tmp_path / "in/sub").mkdir(parents=True)
    for name in ("a.pb", "a.json", "sub/b.pb"):
        files.write_new(spark, f"file://{tmp_path}/in/{name}", name.encode())
    with pytest.raises(FileExistsError):
        files.write_new(spark, f"file://{tmp_path}/in/a.pb", b"again")
    assert (tmp_path / "in/a.pb").read_bytes() == b"a.pb" and not list(tmp_path.rglob("*.part"))
    path, target = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    assert sorted(r.name for r in files.list_files(spark, path, "*.pb").collect()) == ["a.pb", "b.pb"]
    listed = spark.createDataFrame([(n, hashlib.sha256(x).hexdigest()) for n, x in (("a.pb", b"a.pb"), ("b.pb", b"sub/b.pb"))], "name string, checksum_sha256 string")
    assert {r.name: (r.state, r.has_sidecar) for r in files.verified_files(spark, path, listed, ".json").collect()} == {"a.pb": ("ok", True), "b.pb": ("ok", False)}
    actions = lambda **k: {r.name: r.action for r in files.upload(spark, path, target, **k).collect()}
    assert set(actions(dry_run=True).values()) == {"upload"} and not list((tmp_path / "out").iterdir())
    assert set(actions().values()) == {"upload"} and (tmp_path / "out/b.pb").read_bytes() == b"sub/b.pb"
    assert set(actions().values()) == {"skip"}
    (tmp_path / "out/.b.pb.crc").unlink()
    (tmp_path / "out/b.pb").write_bytes(b"other")
    with pytest.raises(ValueError, match="b.pb"):
        actions()
    assert files.require_space(spark, path, 1) > 1
    with pytest.raises(OSError):
        files.require_space(spark, path, 1 << 62)


def test_resume_and_json_sinks(spark, tmp_path):
    lines = [(1, "x", "e1"), (2, None, "e2"), (3, "x", None), (4, "y", None)]
    known, etag = files.resume_state(spark.createDataFrame(lines, "attempt_number int, checksum_sha256 string, etag string"))
    assert sorted(r[0] for r in known.collect()) == ["x", "y"] and etag == "e2"
    rows = spark.range(3)
    files.write_json(rows, f"{tmp_path}/j")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        files.write_json(rows, f"{tmp_path}/j")
    files.write_json(rows, f"{tmp_path}/j", append=True)
    assert files.read_jsonl(spark, f"{tmp_path}/j", "id long").count() == 6


def test_row_sets_rotate_by_kind(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(files.ROTATE, "trip", 4)
    rows = spark.range(10).coalesce(1)
    assert files.write_row_sets({"feed": rows, "trip": rows}, f"{tmp_path}/o") == {"feed": 10, "trip": 10}
    assert len(list((tmp_path / "o/trip").glob("*.zstd.parquet"))) == 3 and len(list((tmp_path / "o/feed").glob("*.zstd.parquet"))) == 1


def test_a_stream_with_a_cadence_goes_on(spark, tmp_path):
    schema = "user_id long, ts timestamp, id long"
    make = lambda ids: spark.createDataFrame([(i,) for i in ids], "id long").selectExpr("id % 3 AS user_id", "timestamp_seconds(id * 600) AS ts", "id").coalesce(1)
    make(range(20)).write.parquet(str(tmp_path / "in"))
    table = CurrentTable(spark, f"file://{tmp_path}/latest", schema, ["user_id"], ["ts", "id"], F.col("user_id"))
    source = dedup.source(spark, str(tmp_path / "in"), schema, "ts")
    query = windows.start_latest(source, "ts", table, f"file://{tmp_path}/state", every="1 second")
    try:
        query.processAllAvailable()
        assert {r.user_id: r.id for r in table.rows().collect()} == {0: 18, 1: 19, 2: 17}
        make(range(20, 30)).write.mode("append").parquet(str(tmp_path / "in"))
        query.processAllAvailable()
        assert query.isActive and {r.user_id: r.id for r in table.rows().collect()} == {0: 27, 1: 28, 2: 29}
    finally:
        query.stop()
    # and a later run goes on with the same table and state
    make(range(30, 32)).write.mode("append").parquet(str(tmp_path / "in"))
    windows.keep_latest(source, "ts", table, f"file://{tmp_path}/state", every="1 second")
    assert {r.user_id: r.id for r in table.rows().collect()} == {0: 30, 1: 31, 2: 29}


def test_tables_of_a_folder(spark, tmp_path):
    for name, schema in schemas.REALTIME.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    for name, schema in schemas.STATIC.items():
        names = [x.split()[0] for x in schema.split(", ")]
        (tmp_path / f"{name}.txt").write_text(",".join(names) + "\n" + ",".join("7" for _ in names) + "\n")
    tables = files.read_tables(spark, str(tmp_path))
    assert set(tables) == {"feed_snapshots", "trip_updates", "stop_time_updates", "gtfs_stops", "gtfs_routes"}
    assert tables["gtfs_routes"].first().route_type == 7 and tables["stop_time_updates"].count() == 0
    spark.createDataFrame([], "snapshot_id int").write.mode("overwrite").parquet(str(tmp_path / "trip_updates"))
    with pytest.raises(ValueError, match="snapshot_id"):
        files.read_tables(spark, str(tmp_path))


def test_message_equals_fields_on_any_bytes():
    rng = random.Random(7)
    whole = feed_message()
    for _ in range(4_000):
        data = bytes(rng.choice((rng.randrange(256), rng.randrange(48), 0x80, 0x0A)) for _ in range(rng.randrange(24)))
        if rng.random() < 0.3:
            at = rng.randrange(len(whole))
            data = whole[:at] + data[:2] + whole[at + rng.randrange(3) :]
        want: dict = {}
        try:
            for k, v in feed.fields(data):
                want.setdefault(k, []).append(v)
        except ValueError as e:
            with pytest.raises(ValueError, match=str(e)):
                feed.message(data)
        else:
            assert feed.message(data) == want


def test_messages_decoded_whole_equal_their_row_sets(spark):
    rows = spark.createDataFrame([(1, bytearray(feed_message())), (2, None), (3, bytearray(feed.encode([(1, feed.encode([(1, "2.0")]))])))], "i int, content binary")
    whole = feed.decode_whole(rows, keep=("i",))
    for kind in feed.ROW_SETS:
        names = [x.split()[0] for x in feed.ROW_SETS[kind].split(", ")]
        one = whole.select("i", F.col(kind) if kind == "feed" else F.explode(kind).alias(kind)).select("i", *[f"{kind}.{n}" for n in names])
        want = feed.decode(rows, keep=("i",), rows=kind).select("i", *names)
        assert one.columns == want.columns and sorted(map(str, one.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(Exception, match="cut off"):
        feed.decode_whole(spark.createDataFrame([(bytearray(b"\x0a\x05"),)], "content binary")).collect()
