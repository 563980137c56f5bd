"""Runs with durable marks, and the change-log state in buckets."""

import datetime as dt

import pytest

from ledgerline.operators.quality import ExpectationFailed, filled_columns, not_empty, unique_keys
from ledgerline.streaming import changelog
from ledgerline.streaming.runs import Landing, MetadataState, Output, run_incremental

DAY = dt.datetime(2030, 1, 1)


def at(hour):
    return DAY + dt.timedelta(hours=hour)


def land(spark, folder, rows, schema="k long, v string", mode="append"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode(mode).parquet(folder)


@pytest.fixture
def job(spark, tmp_path):
    landing, output = Landing(f"{tmp_path}/in"), Output(f"{tmp_path}/out")
    built = []

    def run(**options):
        def build(frames, snapshot):
            built.append((snapshot, frames["in"].count()))
            return frames["in"]

        return run_incremental(spark, output, {"in": landing}, build, **options)

    return run, landing, output, built


def test_a_run_that_fails_its_expectations_is_not_seen(spark, job):
    run, landing, output, built = job
    land(spark, landing.path, [(1, "a"), (1, "b"), (2, None)])
    mark = run(now=at(0), expectations=[not_empty(), unique_keys(["k"]), filled_columns(["v"], fails=False)])
    assert mark.warnings == output.last(spark).warnings == ("unique: k", "filled: v")
    land(spark, landing.path, [(3, None)])
    for expectations in ([filled_columns(["k", "v"])], [unique_keys(["k"], fails=True), filled_columns(["v"])]):
        with pytest.raises(ExpectationFailed, match="filled: "):
            run(now=at(1), expectations=expectations)
        assert output.last(spark) == mark and output.read(spark).count() == 3
    assert run(now=at(2)).run == 2 and output.read(spark).count() == 4 and not output.last(spark).warnings


def test_an_empty_output_is_stopped(spark, tmp_path):
    output = Output(f"{tmp_path}/out")
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    first = output.commit(df, None, None, "snapshot", expectations=[not_empty()])
    for empty in (df.filter("k > 1"), df.limit(0), spark.createDataFrame([], df.schema)):
        with pytest.raises(ExpectationFailed, match="not empty"):
            output.commit(empty, None, first, "snapshot", expectations=[not_empty()])
    assert output.read(spark).count() == 1


def test_a_run_reads_what_was_added(spark, job):
    run, landing, output, built = job
    assert run(now=at(0)) is None and output.read(spark) is None and output.read(spark, "previous") is None
    land(spark, landing.path, [(1, "a"), (2, "b")])
    first = run(now=at(1))
    assert (first.run, first.kind, first.columns) == (1, "snapshot", ("k", "v"))
    assert run(now=at(2)) is None
    land(spark, landing.path, [(3, "c")])
    second = run(now=at(3))
    assert (second.run, second.first_run, second.kind) == (2, 1, "added") and built == [(True, 2), (False, 1)]
    assert output.read(spark).count() == 3
    assert [tuple(r) for r in output.read(spark, "added").collect()] == [(3, "c")]
    assert output.read(spark, "previous").count() == 2


def test_a_failed_run_leaves_no_trace(spark, job):
    run, landing, output, _ = job
    land(spark, landing.path, [(1, "a")])
    run(now=at(0))
    land(spark, landing.path, [(2, "b")])
    # rows and file list of a run that died before its mark
    spark.createDataFrame([(9, "x")], "k long, v string").write.parquet(output.data(2))
    spark.createDataFrame([("in", "x", at(0), 1)], "input string, path string, modified timestamp, length long").write.parquet(
        f"{output.root}/files/000000002"
    )
    assert output.read(spark).count() == 1
    assert run(now=at(1)).run == 2
    assert sorted(tuple(r) for r in output.read(spark).collect()) == [(1, "a"), (2, "b")]


def test_replaced_input_new_columns_and_metadata_rebuild(spark, job):
    run, landing, output, built = job
    land(spark, landing.path, [(1, "a")])
    run(now=at(0))
    land(spark, landing.path, [(5, "e"), (6, "f")], mode="overwrite")  # the first file is gone
    assert run(now=at(1)).kind == "snapshot" and output.read(spark).count() == 2
    land(spark, landing.path, [(7, "g", 1)], "k long, v string, w int")
    mark = run(now=at(2))
    assert mark.kind == "snapshot" and mark.columns == ("k", "v", "w") and built[-2:] == [(False, 1), (True, 3)]
    land(spark, landing.path, [(8, "h", 1)], "k long, v string, w int")
    assert run(metadata=MetadataState(at(3), False), now=at(4)).kind == "added"
    assert run(metadata=MetadataState(at(5), True, "v2"), now=at(6)).version == "v2"
    assert run(metadata=MetadataState(at(5), True, "v2"), now=at(7)) is None
    assert run(incremental=False, now=at(8)).kind == "snapshot" and output.read(spark).count() == 4
    with pytest.raises(ValueError):
        output.read(spark, "next")


# --- change-log state ------------------------------------------------------------------------

LOG = "k string, t int, v string"


def log(spark, rows):
    return spark.createDataFrame(rows, LOG)


def files(root):
    return {str(p.relative_to(root)) for p in root.rglob("*.parquet")}


def test_only_touched_buckets_are_written(spark, tmp_path):
    root = tmp_path / "state"
    changelog.fold_batch(log(spark, [(f"k{i}", 1, "a") for i in range(200)]), 0, str(root), "k", ["t"])
    first = files(root / "data")
    changelog.fold_batch(log(spark, [("k7", 2, "b"), ("k7", 1, "old"), (None, 1, "n")]), 1, str(root), "k", ["t"])
    assert first <= files(root / "data")
    written = changelog.manifests(spark, str(root))[1]
    assert 1 <= sum(w == 1 for w in written.values()) <= 2 and sum(w == 0 for w in written.values()) > 50
    # run again after a failure: same state, from the state before it
    changelog.fold_batch(log(spark, [("k7", 2, "b"), ("k7", 1, "old"), (None, 1, "n")]), 1, str(root), "k", ["t"])
    state = {r["k"]: r["v"] for r in changelog.read_state(spark, str(root)).collect()}
    assert len(state) == 201 and state["k7"] == "b" and state[None] == "n" and state["k8"] == "a"
    assert changelog.read_state(spark, str(root), before=1).count() == 200
    # two batches on, what nobody names any more is gone
    changelog.fold_batch(log(spark, [("k7", 3, "c")]), 2, str(root), "k", ["t"])
    changelog.fold_batch(log(spark, [("k7", 4, "d")]), 3, str(root), "k", ["t"])
    assert sorted(changelog.manifests(spark, str(root))) == [2, 3]
    bucket = next(b for b, w in changelog.manifests(spark, str(root))[3].items() if w == 3)
    assert not (root / "data" / "000000000" / f"state_bucket={bucket}").exists()
    state = {r["k"]: r["v"] for r in changelog.read_state(spark, str(root)).collect()}
    assert len(state) == 201 and state["k7"] == "d"
    changelog.fold_batch(log(spark, []), 4, str(root), "k", ["t"])
    assert sorted(changelog.manifests(spark, str(root))) == [2, 3]
