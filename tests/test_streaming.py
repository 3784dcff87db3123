import datetime as dt

import pytest

from quayside import schemas
from quayside.operators.stitch import voyage_legs
from quayside.streaming.voyages import match_stream, stitch_epoch, stream_legs, stream_stitch
from tests.test_stitch import START, frame, random_pings, values


def in_batches(rows, count):
    timed = sorted((r for r in rows if r[-1] is not None), key=lambda r: r[-1])
    cuts = [timed[len(timed) * i // count][-1] for i in range(count)] + [None]
    return [[r for r in timed if a <= r[-1] and (b is None or r[-1] < b)] for a, b in zip(cuts, cuts[1:])]


def stream_over(spark, tmp_path, batches):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    for batch in batches:
        frame(spark, batch).coalesce(1).write.mode("append").parquet(landing)
        staged = spark.readStream.schema(schemas.STAGED).option("maxFilesPerTrigger", 1).parquet(landing)
        stream_stitch(staged, out, str(tmp_path / "checkpoint")).awaitTermination()
    return out


def test_stream_equals_batch_in_order(spark, tmp_path):
    rows = random_pings(31, vessels=30)
    out = stream_over(spark, tmp_path, in_batches(rows, 3))
    assert values(stream_legs(spark, out), schemas.LEGS.names) == values(voyage_legs(frame(spark, rows)), schemas.LEGS.names)


def test_stream_equals_batch_with_late_pings(spark, tmp_path):
    rows = [r for r in random_pings(32, vessels=30) if r[-1] is not None]
    late = [r for r in rows if r[0] is not None and r[0] % 4 == 0 and r[-1] < START + dt.timedelta(minutes=200)]
    batches = in_batches([r for r in rows if r not in late], 2)
    out = stream_over(spark, tmp_path, [batches[0], late, batches[1]])
    assert values(stream_legs(spark, out), schemas.LEGS.names) == values(voyage_legs(frame(spark, rows)), schemas.LEGS.names)


def test_an_epoch_run_again_changes_nothing(spark, tmp_path):
    rows = random_pings(33, vessels=20)
    first, second = in_batches(rows, 2)
    out = str(tmp_path / "out")
    for epoch, batch in [(0, first), (0, first), (1, second), (1, second)]:
        stitch_epoch(frame(spark, batch), epoch, out)
    assert values(stream_legs(spark, out), schemas.LEGS.names) == values(voyage_legs(frame(spark, rows)), schemas.LEGS.names)


def test_a_lost_state_is_an_error(spark, tmp_path):
    first, second = in_batches(random_pings(34, vessels=10), 2)
    out = str(tmp_path / "out")
    stitch_epoch(frame(spark, first), 0, out)
    with pytest.raises(RuntimeError, match="no state"):
        stitch_epoch(frame(spark, second), 2, out)


def test_old_states_go(spark, tmp_path):
    out = tmp_path / "out"
    for epoch, batch in enumerate(in_batches(random_pings(35, vessels=10), 4)):
        stitch_epoch(frame(spark, batch), epoch, str(out))
    assert sorted(p.name for p in (out / "state").iterdir()) == ["epoch=2", "epoch=3"] and not (out / "linked").exists()


def test_old_pings_are_merged_and_late_ones_find_them(spark, tmp_path, monkeypatch):
    from quayside.streaming import voyages as module

    monkeypatch.setattr(module, "MERGED", 2)
    rows = [r for r in random_pings(36, vessels=10, null_ports=0) if r[-1] is not None]
    late = [r for r in rows if r[0] is not None and r[0] % 4 == 0 and r[-1] < START + dt.timedelta(minutes=100)]
    out = tmp_path / "out"
    batches = in_batches([r for r in rows if r not in late], 4)
    for epoch, batch in enumerate([*batches[:3], late, batches[3]]):
        stitch_epoch(frame(spark, batch), epoch, str(out))
    assert values(stream_legs(spark, str(out)), schemas.LEGS.names) == values(voyage_legs(frame(spark, rows)), schemas.LEGS.names)
    # Five epochs: four merged twice and the last; what was merged goes an epoch later.
    assert [(b.first, b.last) for b in module.history_blocks(spark, str(out), 4)] == [(0, 3), (4, 4)]
    assert {"0-3", "4-4"} <= {p.name for p in (out / "pings").iterdir()} and "0-0" not in {p.name for p in (out / "pings").iterdir()}


def test_a_late_ping_reads_the_blocks_of_its_vessel_only(spark, tmp_path):
    """Every vessel calls at a port an hour; the blocks that don't matter can't be read any more."""
    rows = [(mmsi, "9", "V", "ABC"[h % 3], 1.0, 2.0, START + dt.timedelta(hours=h, minutes=m)) for h in range(8) for m in (0, 40) for mmsi in (1, 2)]
    late = [r for r in rows if r[0] == 1 and r[-1] == START + dt.timedelta(hours=6, minutes=40)]
    batches = in_batches([r for r in rows if r not in late], 4)
    out = tmp_path / "out"
    for epoch, batch in enumerate(batches):
        stitch_epoch(frame(spark, batch), epoch, str(out))
    for file in [*(out / "pings" / "0-0").iterdir(), *(out / "pings" / "1-1").iterdir()]:
        file.write_bytes(b"gone")
    stitch_epoch(frame(spark, late), 4, str(out))
    assert values(stream_legs(spark, str(out)), schemas.LEGS.names) == values(voyage_legs(frame(spark, rows)), schemas.LEGS.names)


def test_matching_keeps_no_state(spark, tmp_path):
    pings = "mmsi bigint, imo string, vessel_name string, latitude double, longitude double, dep_time timestamp_ntz"
    ports = spark.createDataFrame([("A", 0.0, 0.0)], "locode string, lat double, lon double")
    rows = [(1, "IMO9", "V", 0.001, 0.0, START), (2, "9", "W", 1.0, 0.0, START)]
    spark.createDataFrame(rows, pings).write.parquet(str(tmp_path / "in"))
    staged = match_stream(spark.readStream.schema(pings).parquet(str(tmp_path / "in")), ports)
    assert staged.isStreaming and staged.columns == schemas.STAGED.names
    query = staged.writeStream.format("memory").queryName("matched").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [(r.mmsi, r.imo, r.port_locode) for r in spark.table("matched").collect()] == [(1, "9", "A")]
    assert not query.lastProgress["stateOperators"]


def test_nothing_streamed_yet(spark, tmp_path):
    assert stream_legs(spark, str(tmp_path / "none")).count() == 0
