"""Landed logs by partition and offset."""

import datetime as dt

from meterlake.sources import offset_log, sinks

TIME = dt.datetime(2024, 1, 1)


def land(spark, path, rows, segment_rows=10):
    frame = spark.createDataFrame([("t", p, o, TIME, 0, f"{p}:{o}") for p, o in rows], offset_log.SCHEMA)
    offset_log.land_log(frame, path, segment_rows)


def run(spark, tmp_path, name="out", **options):
    stream = offset_log.offset_log_stream(spark, str(tmp_path / "log"), segment_rows=10, **options)
    sinks.capture_bronze(stream, str(tmp_path / name), str(tmp_path / f"{name}-check")).awaitTermination()
    return sorted((r["partition"], r["offset"], r["value"]) for r in spark.read.parquet(str(tmp_path / name)).collect())


def want(*rows):
    return [(p, o, f"{p}:{o}") for p, o in rows]


def test_pieces_are_cut_at_segments():
    assert offset_log.pieces({"0": 7}, {"0": 25, "1": 3, "2": 0}, 10) == [(0, 0, 7, 10), (0, 1, 10, 20), (0, 2, 20, 25), (1, 0, 0, 3)]
    assert offset_log.pieces({"0": 5}, {"0": 5}, 10) == []


def test_a_restart_resumes_at_the_recorded_offset(spark, tmp_path):
    path = str(tmp_path / "log")
    land(spark, path, [(0, o) for o in range(25)] + [(1, o) for o in range(4)])
    assert run(spark, tmp_path, starting={"0": 3}, ending={"0": 13}) == want(*[(0, o) for o in range(3, 13)], *[(1, o) for o in range(4)])
    land(spark, path, [(0, o) for o in range(25, 41)] + [(2, o) for o in range(2)])  # goes on in the last segment; a new partition
    assert run(spark, tmp_path, starting={"0": 3}) == want(*[(0, o) for o in range(3, 41)], *[(1, o) for o in range(4)], *[(2, o) for o in range(2)])
    assert len(run(spark, tmp_path, starting={"0": 3})) == 44  # nothing new


def test_latest_starts_behind_what_is_there(spark, tmp_path):
    path = str(tmp_path / "log")
    land(spark, path, [(0, o) for o in range(12)])
    assert run(spark, tmp_path, "late", starting="latest") == []
    land(spark, path, [(0, 12), (0, 13)])
    assert run(spark, tmp_path, "late", starting="latest") == want((0, 12), (0, 13))
    assert run(spark, tmp_path, "all") == want(*[(0, o) for o in range(14)])


def test_each_segment_is_a_task(spark, tmp_path):
    path = str(tmp_path / "log")
    land(spark, path, [(0, o) for o in range(35)])
    reader = offset_log.OffsetLogReader({"path": path, "segmentRows": "10"})
    assert [tuple(p.value) for p in reader.partitions(reader.initialOffset(), reader.latestOffset())] == [(0, 0, 0, 10), (0, 1, 10, 20), (0, 2, 20, 30), (0, 3, 30, 35)]


def test_many_small_segments_share_tasks(spark, tmp_path):
    """tasks do not grow with small segments, and the same offsets are read."""
    reader = offset_log.OffsetLogReader({"path": str(tmp_path), "segmentRows": "10"})
    tasks = [offset_log.Piece(*p.value) for p in reader.partitions({"0": 3}, {"0": 10_003, "1": 5_000})]
    assert len(tasks) <= 2 * offset_log._MANY
    covered = [(t.partition, o) for t in tasks for o in range(t.start, t.end)]
    assert covered == [(0, o) for o in range(3, 10_003)] + [(1, o) for o in range(5_000)]
    found = offset_log.pieces({}, {"0": 40 * offset_log.SEGMENT_ROWS * offset_log._MANY}, offset_log.SEGMENT_ROWS // 4)
    assert max(t.end - t.start for t in offset_log.shared(found, offset_log.SEGMENT_ROWS // 4)) == offset_log.SEGMENT_ROWS
    path = str(tmp_path / "log")
    land(spark, path, [(0, o) for o in range(25)] + [(1, o) for o in range(35)])
    one = offset_log.OffsetLogReader({"path": path, "segmentRows": "10"}).read(offset_log.InputPartition((1, 0, 4, 33)))
    assert [o for batch in one for o in batch.column(batch.schema.names.index("offset")).to_pylist()] == list(range(4, 33))
