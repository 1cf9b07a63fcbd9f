"""Loads, refreshed tables, long sequences and streams whose state ends."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wayfold.operators.grain import latest_per_key
from wayfold.operators.sequence import gaps, with_previous
from wayfold.plans.current import CurrentTable, refresh
from wayfold.sources.ledger import Ledger, load, loaded
from wayfold.streaming import dedup, windows

KEYED = "k string, day string, at int, tie string, v int"


def put(spark, folder, rows, schema=KEYED, name="a"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"file://{folder}/{name}")


def same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


# the ledger


def test_a_second_load_adds_nothing(spark, tmp_path):
    folder, into = f"file://{tmp_path}/in", f"file://{tmp_path}/t"
    put(spark, tmp_path / "in", [("a", "1", 1, "x", 1)], name="one")
    assert load(spark, folder, KEYED, into).count() == 1
    assert load(spark, folder, KEYED, into).count() == 0
    put(spark, tmp_path / "in", [("b", "1", 1, "x", 2), ("c", "1", 1, "x", 3)], name="two")
    got = load(spark, folder, KEYED, into)
    assert sorted(r.k for r in got.collect()) == ["b", "c"]
    assert sorted(r.k for r in loaded(spark, KEYED, into).collect()) == ["a", "b", "c"]
    known = Ledger(spark, f"{into}/ledger").files().collect()
    assert sorted(r.batch for r in known) == [1, 2] and {r.name.split("/")[0] for r in known} == {"one", "two"}


def test_a_broken_file_leaves_no_rows(spark, tmp_path):
    folder, into = f"file://{tmp_path}/in", f"file://{tmp_path}/t"
    put(spark, tmp_path / "in", [("a", "1", 1, "x", 1)])
    whole = next((tmp_path / "in").rglob("*.parquet")).read_bytes()
    # a sound footer over a broken page
    broken = tmp_path / "in" / "broken.parquet"
    broken.write_bytes(whole[:4] + bytes(60) + whole[64:])
    with pytest.raises(Exception):
        load(spark, folder, KEYED, into).count()
    assert loaded(spark, KEYED, into).count() == 0 and Ledger(spark, f"{into}/ledger").batches() == []
    broken.unlink()
    assert load(spark, folder, KEYED, into).count() == 1 and loaded(spark, KEYED, into).count() == 1


def test_other_content_is_refused_and_other_times_are_not(spark, tmp_path):
    folder, into = f"file://{tmp_path}/in", f"file://{tmp_path}/t"
    put(spark, tmp_path / "in", [("a", "1", 1, "x", 1)])
    load(spark, folder, KEYED, into)
    file = next((tmp_path / "in").rglob("*.parquet"))
    file.touch()
    assert load(spark, folder, KEYED, into).count() == 0
    put(spark, tmp_path / "other", [("a", "1", 1, "x", 2)])
    file.with_name(f".{file.name}.crc").unlink()
    file.write_bytes(next((tmp_path / "other").rglob("*.parquet")).read_bytes())
    with pytest.raises(ValueError, match="other content"):
        load(spark, folder, KEYED, into)
    with pytest.raises(ValueError, match="of another type"):
        load(spark, f"file://{tmp_path}/other", KEYED.replace("v int", "v long"), into)


def test_a_load_that_stopped_before_the_ledger_is_done_again(spark, tmp_path, monkeypatch):
    folder, into = f"file://{tmp_path}/in", f"file://{tmp_path}/t"
    put(spark, tmp_path / "in", [("a", "1", 1, "x", 1)])
    with monkeypatch.context() as m:
        m.setattr(Ledger, "commit", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            load(spark, folder, KEYED, into)
    assert loaded(spark, KEYED, into).count() == 0
    assert load(spark, folder, KEYED, into).count() == 1 and loaded(spark, KEYED, into).count() == 1


# the current table


def table(spark, path):
    return CurrentTable(spark, f"file://{path}/current", KEYED, ["k", "day"], ["at", "tie", "v"], F.col("day"), null_wins=("tie",))


def newest(rows):
    return latest_per_key(rows, ["k", "day"], [F.desc_nulls_last("at"), F.desc_nulls_first("tie"), F.desc_nulls_last("v")])


def test_five_increments_in_any_order_equal_a_full_remake(spark, tmp_path):
    random.seed(5)
    rows = [(random.choice(["a", "b", "c", None]), random.choice(["1", "2", "3", None]), random.choice([1, 2, 3, None]), random.choice(["x", "y", None]), v) for v in range(120)]
    own = table(spark, tmp_path)
    for part in random.sample(range(5), 5):
        put(spark, tmp_path / "in", rows[part::5], name=f"p{part}")
        assert refresh(own, f"file://{tmp_path}/in", f"file://{tmp_path}/load", KEYED) == 1
    assert refresh(own, f"file://{tmp_path}/in", f"file://{tmp_path}/load", KEYED) == 0
    assert same(own.rows(), newest(spark.createDataFrame(rows, KEYED)))
    # a late row changes nothing, a newer one only its partition
    files = {f: open(f, "rb").read() for f in map(str, (tmp_path / "current" / "rows").rglob("*.parquet"))}
    assert own.merge(spark.createDataFrame([("a", "1", 0, "x", 7)], KEYED)) == 1
    assert same(own.rows(), newest(spark.createDataFrame(rows, KEYED)))
    own.merge(spark.createDataFrame([("a", "1", 9, "x", 7)], KEYED))
    now = set(map(str, (tmp_path / "current" / "rows").rglob("*.parquet")))
    assert {f for f in files if f not in now} == {f for f in files if "__part=1/" in f}
    assert own.merge(spark.createDataFrame([], KEYED)) == 0


def test_only_new_files_are_read(spark, tmp_path, monkeypatch):
    own, read = table(spark, tmp_path), []
    for n in range(3):
        put(spark, tmp_path / "in", [("a", str(n), n, "x", n)], name=f"p{n}")
        with monkeypatch.context() as m:
            m.setattr(CurrentTable, "merge", lambda self, rows, f=CurrentTable.merge: (read.append({r[0] for r in rows.select("v").collect()}), f(self, rows))[1])
            refresh(own, f"file://{tmp_path}/in", f"file://{tmp_path}/load", KEYED)
    assert read == [{0}, {1}, {2}] and own.rows().count() == 3


def test_a_merge_that_stopped_is_finished(spark, tmp_path, monkeypatch):
    own, rows = table(spark, tmp_path), [("a", "1", 1, "x", 1), ("b", "2", 1, "x", 2), ("c", "3", 1, "x", 3)]
    own.merge(spark.createDataFrame(rows, KEYED))
    newer = [("a", "1", 2, "x", 4), ("b", "2", 2, "x", 5)]
    from wayfold.plans import current

    calls = []

    def once(spark, path, to):
        calls.append(to)
        if len(calls) > 2:  # the merged folder, then one partition
            raise OSError("gone")
        return renamed(spark, path, to)

    renamed = current.rename
    with monkeypatch.context() as m:
        m.setattr(current, "rename", once)
        with pytest.raises(OSError):
            own.merge(spark.createDataFrame(newer, KEYED))
    assert same(table(spark, tmp_path).rows(), newest(spark.createDataFrame(rows + newer, KEYED)))


# long sequences


@pytest.mark.parametrize("ranges", [1, 16, 211])
def test_neighbours_equal_lag(spark, ranges):
    rows = spark.range(3000).select(F.col("id"), (F.col("id") * 7919 % 3001).alias("o"), F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("g"), F.when(F.col("id") % 11 > 0, F.col("id")).alias("v"))
    for by in ([], ["g"]):
        along = Window.partitionBy(*by).orderBy("o")
        want = rows.withColumn("previous_v", F.lag("v").over(along))
        assert same(with_previous(rows, ["o"], ["v"], by, ranges), want)


def test_gaps_of_few_and_no_rows(spark):
    rows = spark.createDataFrame([(None, dt.datetime(2026, 1, 1)), ("a", dt.datetime(2026, 1, 2)), ("a", None), ("a", dt.datetime(2026, 1, 1))], "g string, ts timestamp")
    assert [(r.g, r.gap_seconds) for r in gaps(rows, ["ts"], "ts", 60, ["g"]).collect()] == [("a", 86_400)]
    assert gaps(rows.limit(0), ["ts"], "ts", 60).count() == 0


# streams

EVENTS = "event_id long, user_id long, event_type string, ts timestamp"
START = dt.datetime(2026, 1, 1)


def at(hours):
    return START + dt.timedelta(hours=hours)


def test_hours_close_state_stays_small_and_late_rows_are_counted(spark, tmp_path):
    folder, into = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    states = []
    for day in range(6):
        rows = [(day * 1000 + k, k % 3, "x", at(24 * day + k % 24)) for k in range(48)]
        late = [(day * 1000 + 500 + k, 9, "x", at(24 * (day - 3) + k)) for k in range(5)] if day >= 3 else []
        put(spark, tmp_path / "in", rows + late, EVENTS, name=f"d{day}")
        source = dedup.source(spark, f"{folder}/*", spark.createDataFrame([], EVENTS).schema, "ts")
        states.append(windows.count_hours(source, "ts", into, late="12 hours").state_rows[-1])
    closed = {r.hour: r.n for r in windows.closed_hours(spark, into).collect()}
    opened = {r.hour: r.n for r in windows.open_hours(spark, into).collect()}
    assert max(states) <= 13 and len(opened) == states[-1] and not set(closed) & set(opened)
    assert closed | opened == {at(h): 2 for h in range(144)}
    assert tuple(windows.late_rows(spark, into).first()) == (6 * 48 + 15, 6 * 48, 15)


def test_the_latest_row_of_keys_over_restarts_and_their_state_ends(spark, tmp_path):
    schema = spark.createDataFrame([], EVENTS).schema
    own = CurrentTable(spark, f"file://{tmp_path}/t", "user_id long, event_type string, ts timestamp, event_id long", ["user_id"], ["ts", "event_id"], F.pmod("user_id", F.lit(4)))
    states, rows = [], []
    for day in range(5):
        # user 100 + day is seen on one day only, user 1 each day
        part = [(day * 10 + k, u, "abc"[k % 3], at(24 * day + k)) for k, u in enumerate([1, 100 + day, 1, 100 + day])]
        rows += part
        put(spark, tmp_path / "in", part, EVENTS, name=f"d{day}")
        source = dedup.source(spark, f"file://{tmp_path}/in/*", schema, "ts")
        states.append(windows.keep_latest(source, "ts", own, f"file://{tmp_path}/state", late="1 hour").state_rows[-1])
    want = latest_per_key(spark.createDataFrame(rows, EVENTS), ["user_id"], [F.desc("ts"), F.desc("event_id")])
    names = ["user_id", "event_type", "ts", "event_id"]
    assert same(own.rows().select(*names), want.select(*names)) and own.rows().count() == 6
    assert states == [2] * 5
