import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.sources import readers, writers
from ledgerline.streaming import changelog
from ledgerline.streaming.windows import closed_windows, late_rows, tumbling_totals

SCHEMA = "k string, t int, n int, mode string, v string"
LOG = [
    ("a", 1, 1, "U", "a1"), ("a", 3, 2, "U", "a3"), ("a", 2, 3, "U", "a2"),
    ("b", 1, 4, "U", "b1"), ("b", 5, 5, "D", "b5"), ("b", 4, 6, "U", "b4"),
    ("c", 1, 7, None, "c1"), ("d", 1, 8, "D", "d1"), ("d", 2, 9, "U", "d2"),
]


def fold(spark, batches, **options):
    state = None
    for batch in batches:
        frame = spark.createDataFrame(batch, SCHEMA)
        state = changelog.fold_changes(frame, state, "k", ["t", "n"], **options)
    return changelog.current_rows(state, "mode")


def test_outcome_does_not_depend_on_batches(spark, rows):
    whole = rows(fold(spark, [LOG]), "v")
    assert whole == [("a3",), ("d2",)]
    parts = [LOG[:3], LOG[3:6], LOG[6:]]
    for order in itertools.permutations(parts):
        assert rows(fold(spark, order), "v") == whole
    assert rows(fold(spark, [[x] for x in LOG[3:6]]), "v") == []


def test_without_late_safety_the_last_batch_wins(spark, rows):
    assert rows(fold(spark, [LOG[3:5], LOG[5:6]], late_safe=False), "v") == [("b4",)]


def test_stream_equals_batch_and_replays(spark, rows, tmp_path):
    source, state, offsets = (str(tmp_path / n) for n in ("in", "state", "offsets"))
    frame = spark.createDataFrame(LOG, SCHEMA)
    for i in (2, 0, 1):
        frame.filter(F.col("n") % 3 == i).coalesce(1).write.mode("append").parquet(source)
        stream = readers.read_stream(spark, source, frame.schema, files_per_batch=1)
        changelog.run_changelog(stream, state, offsets, "k", ["t", "n"]).awaitTermination()
    assert rows(changelog.current_rows(changelog.read_state(spark, state), "mode"), "v") == [("a3",), ("d2",)]
    done = sorted(changelog.manifests(spark, state))
    assert len(done) == 2  # the newest two of three
    assert changelog.read_state(spark, state, before=done[0]) is None
    # a run without new files changes nothing
    stream = readers.read_stream(spark, source, frame.schema)
    changelog.run_changelog(stream, state, offsets, "k", ["t", "n"]).awaitTermination()
    assert sorted(changelog.manifests(spark, state)) == done


def test_unfinished_batch_is_ignored(spark, tmp_path):
    root = tmp_path / "state"
    (root / "data" / "000000009" / "state_bucket=1").mkdir(parents=True)
    assert changelog.read_state(spark, str(root)) is None
    assert changelog.read_state(spark, str(tmp_path / "none")) is None


def test_rebuild_decision():
    day = dt.datetime(2024, 1, 1)
    assert changelog.metadata_is_newer(day, None)
    assert changelog.metadata_is_newer(day, day - dt.timedelta(1))
    assert not changelog.metadata_is_newer(day, day)
    columns = ["a", "b"]
    assert changelog.must_rebuild(False, False, False, columns, columns)
    assert changelog.must_rebuild(True, True, True, columns, columns)
    assert not changelog.must_rebuild(True, True, False, columns, columns)
    assert not changelog.must_rebuild(True, False, True, columns, ["b", "a"])
    assert changelog.must_rebuild(True, False, False, columns, ["a"])
    assert changelog.must_rebuild(True, False, False, columns, None)


def test_reenrich(spark, rows):
    added = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "id int, k string")
    previous = spark.createDataFrame([(4, "x"), (5, "y")], "id int, k string")
    lookup = spark.createDataFrame([("x", "X"), ("y", "Y")], "lk string, name string")
    got = changelog.reenrich(added, previous, lookup, lookup.filter("lk = 'y'"), [("k", "lk")])
    assert rows(got) == [(1, "x", "X"), (2, None, None), (3, "z", None), (5, "y", "Y")]


def test_tumbling_windows_of_a_stream_drop_late_rows(spark, tmp_path):
    source, offsets, out = (str(tmp_path / n) for n in ("in", "offsets", "out"))
    base = dt.datetime(2024, 1, 1, 10)
    batches = [[(base, 1.0), (base + dt.timedelta(minutes=59), 2.0)], [(base + dt.timedelta(hours=5), 4.0)], [(base, 8.0)], [(base + dt.timedelta(hours=9), 1.0)]]
    for batch in batches:
        frame = spark.createDataFrame(batch, "ts timestamp, v double")
        frame.coalesce(1).write.mode("append").parquet(source)
        stream = readers.read_stream(spark, source, frame.schema)
        totals = tumbling_totals(stream, "ts", "v", width="1 hour", lateness="1 hour")
        query = (
            totals.writeStream.outputMode("append").format("parquet").option("path", out)
            .option("checkpointLocation", offsets).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    got = {r["window_start"].hour: (r["event_count"], r["total_value"]) for r in spark.read.parquet(out).collect()}
    assert got[10] == (2, 3.0) and got[15] == (1, 4.0)


def test_late_rows_are_kept_apart_and_none_is_lost(spark, rows, tmp_path):
    source, folder = f"{tmp_path}/in", f"{tmp_path}/out"
    schema = spark.createDataFrame([], "ts timestamp, v double").schema
    base = dt.datetime(2024, 1, 1, 10)
    hour = dt.timedelta(hours=1)

    def call(batch, close=False):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        windows = closed_windows(spark, source, schema, folder, "ts", "v", width="1 hour", lateness="1 hour", close=close)
        return {r["window_start"].hour: (r["event_count"], r["total_value"]) for r in windows.collect()}

    assert call([]) == {}
    assert call([(base, 1.0), (base + 59 * hour / 60, 2.0), (None, 9.0)]) == {}
    assert call([(base + 5 * hour, 4.0), (base + hour / 2, 16.0)]) == {10: (3, 19.0)}  # not late: nothing had closed it
    assert call([(base, 8.0), (base + 4 * hour, 1.0)]) == {10: (3, 19.0)}
    assert rows(late_rows(spark, folder)) == [(base, 8.0)]
    assert call([], close=True) == {10: (3, 19.0), 14: (1, 1.0), 15: (1, 4.0)}
    assert call([(base + 5 * hour, 32.0)], close=True) == {10: (3, 19.0), 14: (1, 1.0), 15: (1, 4.0)}
    assert rows(late_rows(spark, folder), "v") == [(32.0,), (8.0,)]


def test_tab_separated_files(spark, rows, tmp_path):
    (tmp_path / "Products.txt").write_bytes(b"ApplNo\tDrugName\tTECode\n001\tab\xffc\tX\n002\tshort\n003\tlong\ty\textra\n")
    (tmp_path / "TE.txt").write_bytes(b"ApplNo\tMarketingStatusID\n1\t2\n")
    tables = readers.read_tab_folder(spark, str(tmp_path), ["Products.txt", "TE.txt"])
    assert set(tables) == {"fda_drug_products", "fda_drug_te"}
    assert tables["fda_drug_te"].columns == ["appl_no", "marketing_status_id"]
    assert rows(tables["fda_drug_products"]) == [("001", "abc", "X"), ("002", "short", None), ("003", "long", "y")]


def test_sinks(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    assert writers.write_batch(df, path, replace=True)
    assert writers.write_batch(df.filter("k = 2"), path)
    assert not writers.write_batch(df.limit(0), path)
    assert rows(spark.read.parquet(path), "k") == [(1,), (2,), (2,)]
    writers.full_refresh(df, path, partition_by=("p",))
    assert readers.read_table(spark, path).count() == 2
    writers.write_outputs(df, {f"{path}1": lambda d: d.filter("k = 1"), f"{path}2": lambda d: d.select("k")})
    assert readers.read_table(spark, f"{path}1").count() == 1 and readers.read_table(spark, f"{path}2").columns == ["k"]
    assert readers.read_changes(spark, path, f"{path}1", snapshot=False).count() == 1
    assert readers.read_changes(spark, path, f"{path}1", snapshot=True).count() == 2
    assert not df.storageLevel.useMemory


def test_tables_by_name_and_lookup(spark):
    readers.lookup_table(spark, [("a", 1)], "k string, v int").createOrReplaceTempView("small_lookup")
    assert readers.read_table(spark, "small_lookup").count() == 1


def test_checkpoint_folder_comes_from_the_session():
    class Context:
        def __init__(self, master):
            self.master, self.folder = master, None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, master, configured):
            self.sparkContext = Context(master)
            self.conf = {"spark.checkpoint.dir": configured} if configured else {}

    shared = Session("spark://host", "hdfs://shared/x")
    session.ensure_checkpoint_dir(shared)
    assert shared.sparkContext.folder == "hdfs://shared/x"
    local = Session("local[2]", None)
    session.ensure_checkpoint_dir(local)
    assert local.sparkContext.folder
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session("spark://host", None))


def test_settled_table_keeps_rows_and_schema(spark, rows):
    df = spark.sql("select 1 as `a_|_b`, cast(1.5 as decimal(28,4)) as d, array(named_struct('x', 1)) as s, cast(null as date) as e")
    kept = session.settled(df)
    assert kept.dtypes == df.dtypes and rows(kept) == rows(df)
