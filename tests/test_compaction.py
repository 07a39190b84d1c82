import os

from conftest import rows
from mercantile.session import scratch_path
from mercantile.streaming import compaction

SCHEMA = "k bigint, total bigint"


def _changes(spark, batch):
    """Key 0 and the NULL key change in every batch, the others in turn."""
    return spark.createDataFrame([(0, batch), (None, -batch), (1 + batch % 7, 1000 + batch)], SCHEMA).coalesce(1)


def _want(batches):
    out = {}
    for b in range(batches):
        out |= {0: b, None: -b, 1 + b % 7: 1000 + b}
    return sorted(out.items(), key=lambda x: (x[0] is not None, x[0]))


def test_a_hundred_batches_leave_few_folders_and_right_totals(spark):
    path = scratch_path(spark, "compact")
    write = compaction.compacting_sink(path, ["k"])
    most = 0
    for b in range(100):
        write(_changes(spark, b), b)
        most = max(most, len(compaction.live_runs(compaction.complete_runs(spark, path))))
        if b in (0, 3, 15, 62, 99):
            assert rows(compaction.current_totals(spark, path, ["k"])) == _want(b + 1)
    assert most <= 3 * 4
    assert len(os.listdir(path.removeprefix("file:"))) <= 3 * 4 + 3 * compaction.FAN


def test_a_reader_that_planned_before_a_merge_reads_on(spark):
    path = scratch_path(spark, "compact")
    write = compaction.compacting_sink(path, ["k"], fan=2, keep=2)
    write(_changes(spark, 0), 0)
    early = compaction.current_totals(spark, path, ["k"])
    write(_changes(spark, 1), 1)  # merged into run 0-1
    assert compaction.live_runs(compaction.complete_runs(spark, path)) == [compaction.Run(1, 0, 1)]
    assert rows(early) == _want(1)
    assert rows(compaction.current_totals(spark, path, ["k"])) == _want(2)


def test_replays_and_crashes(spark):
    path = scratch_path(spark, "compact")
    write = compaction.compacting_sink(path, ["k"], fan=2, keep=100)
    for b in (0, 0, 1, 1, 0, 2):
        write(_changes(spark, b), b)
    assert rows(compaction.current_totals(spark, path, ["k"])) == _want(3)
    # A crash inside the write of batch 3, then inside the merge that follows it.
    _changes(spark, 99).write.parquet(f"{path}/run-0-3-3")
    os.remove(f"{path.removeprefix('file:')}/run-0-3-3/_SUCCESS")
    assert rows(compaction.current_totals(spark, path, ["k"])) == _want(3)
    write(_changes(spark, 3), 3)
    os.remove(f"{path.removeprefix('file:')}/run-2-0-3/_SUCCESS")
    assert rows(compaction.current_totals(spark, path, ["k"])) == _want(4)
    write(_changes(spark, 4), 4)
    assert compaction.Run(2, 0, 3) in compaction.complete_runs(spark, path)
    assert rows(compaction.current_totals(spark, path, ["k"])) == _want(5)
