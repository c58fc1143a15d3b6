"""The committed file sink and reading by key."""

import os

import pytest
from pyspark.sql import functions as F

from shelfaudit.plans import photos as ph
from shelfaudit.sources import named_files as nf


def files(folder):
    return {n: open(os.path.join(folder, n), "rb").read() for n in os.listdir(folder) if not n.startswith("_")}


def rows(spark, n=40, parts=5):
    return spark.range(n).repartition(parts).select(
        F.format_string("f%d.bin", "id").alias("name"), F.when(F.col("id") > 0, F.repeat(F.lit("x"), F.col("id").cast("int"))).cast("binary").alias("data"))


def test_files_are_written_and_committed(spark, tmp_path):
    target = str(tmp_path / "out")
    df = rows(spark).unionByName(spark.createDataFrame([(None, b"lost"), ("a/b/last", b"z")], "name string, data binary"))
    nf.write_files(df, "name", "data", target)
    want = {f"f{k}.bin": b"x" * k for k in range(40)} | {"last": b"z"}
    assert files(target) == want
    assert open(f"{target}/_SUCCESS").read().split() == ["41", str(sum(map(len, want.values())))]
    assert not os.path.exists(f"{target}/_pending")
    nf.write_files(spark.createDataFrame([("more", b"1")], "name string, data binary"), "name", "data", target)
    assert files(target) == want | {"more": b"1"}


def test_failed_job_leaves_no_file(spark, tmp_path):
    """A task that fails after others have finished: every file of the job is taken back, others stay."""
    target = str(tmp_path / "out")
    nf.write_files(spark.createDataFrame([("kept", b"1")], "name string, data binary"), "name", "data", target)
    bad = rows(spark).withColumn("data", F.when(F.col("name") == "f7.bin", F.raise_error(F.lit("no bytes")).cast("binary")).otherwise(F.col("data")))
    with pytest.raises(Exception, match="no bytes"):
        nf.write_files(bad, "name", "data", target)
    assert files(target) == {"kept": b"1"} and not os.path.exists(f"{target}/_pending")


def batch(*given):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([g[0] for g in given], pa.string()), pa.array([g[1] for g in given], pa.binary())], ["name", "data"])


def test_killed_and_duplicate_attempts_leave_exactly_the_files_named(tmp_path):
    """One attempt dies half-way through a file, a speculative one ends twice: after the commit, the named files and nothing else."""
    target = str(tmp_path)
    writer = nf.FileWriter(target)
    one = [batch(("a", b"1"), ("b", b"22"))]

    def killed():
        yield batch(("a", b"1"))
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        writer.write(killed())
    half = os.path.join(target, "_pending", writer.job, "dead")
    os.makedirs(half)
    open(os.path.join(half, "0.part"), "wb").write(b"ha")
    first, again = writer.write(one), writer.write(one)
    other = writer.write([batch(("c", b"333"))])
    assert first == again
    writer.commit([first, None, other])
    assert files(target) == {"a": b"1", "b": b"22", "c": b"333"} and sorted(os.listdir(target)) == ["_SUCCESS", "a", "b", "c"]
    assert open(f"{target}/_SUCCESS").read() == "3 6\n"


def test_abort_takes_back_what_any_attempt_wrote(tmp_path):
    target = str(tmp_path)
    done = nf.FileWriter(target)
    done.commit([done.write([batch(("old", b"0"))])])
    writer, beside = nf.FileWriter(target), nf.FileWriter(target)
    beside.write([batch(("beside", b"1"))])
    writer.write([batch(("a", b"1"))])
    writer.abort([None])
    assert files(target) == {"old": b"0", "beside": b"1"}
    assert os.listdir(os.path.join(target, "_pending")) == [beside.job]


def test_unselected_files_are_not_read(spark, tmp_path, monkeypatch):
    """Only three files of each document are opened: the others aren't even there."""
    store, target = str(tmp_path / "store"), str(tmp_path / "out")
    att = spark.createDataFrame([(d, f) for d in (1, 2) for f in range(10 * d, 10 * d + 8)], "docid long, fileid long")
    docs = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "doc_id long, agent long")
    os.makedirs(store)
    for f in (10, 11, 12, 20, 21, 22):
        open(f"{store}/{f}", "wb").write(os.urandom(3 * f))
    monkeypatch.setattr(nf, "CHUNK", 16)
    selected = ph.photo_names(ph.photo_selection(ph.photo_candidates(docs, att, [("doc_id", "docid")]), "doc_id", "fileid"), "fileid", "agent", "doc_id", ".jpg")
    found = selected.where("fileid IS NOT NULL").withColumn("path", nf.stored_at(store, F.col("fileid").cast("string")))
    nf.write_files(found, "file_name", "path", target)
    assert files(target) == {f"{f}_{a}{d}.jpg": open(f"{store}/{f}", "rb").read() for d, a, fs in ((1, 5, (10, 11, 12)), (2, 6, (20, 21, 22))) for f in fs}
    with pytest.raises(Exception, match="13"):
        nf.write_files(found.withColumn("path", nf.stored_at(store, F.lit("13"))), "file_name", "path", str(tmp_path / "none"))
    assert files(str(tmp_path / "none")) == {}


def test_columns_and_places_are_checked(spark, tmp_path):
    with pytest.raises(Exception, match="a name and bytes or a path"):
        nf.write_files(spark.range(1).withColumn("name", F.lit("a")), "name", "id", str(tmp_path))

    class Cluster:
        class sparkSession:
            class conf:
                @staticmethod
                def get(key, default=None):
                    return "local-cluster[2,1,1024]"

    for uri in ("/tmp/x", "file:///tmp/x"):
        with pytest.raises(ValueError, match="all executors"):
            nf.shared(Cluster, uri)
    assert nf.shared(Cluster, "hdfs://h/x") == "hdfs://h/x"


def test_a_cluster_writes_below_its_shared_folder(tmp_path):
    """The checkpoint folder is on all machines, whatever form its path has; its neighbours are not."""
    class Cluster:
        class sparkSession:
            class conf:
                @staticmethod
                def get(key, default=None):
                    return {"spark.master": "local-cluster[2,1,1024]", "spark.checkpoint.dir": f"file://{tmp_path}/shared"}.get(key, default)

    for uri in (f"file://{tmp_path}/shared/a", f"file:{tmp_path}/shared/a/b", f"{tmp_path}/shared/a"):
        assert nf.shared(Cluster, uri) == uri
    for uri in (f"file://{tmp_path}/shared-not/a", f"file://{tmp_path}/shared/../a", str(tmp_path)):
        with pytest.raises(ValueError, match="all executors"):
            nf.shared(Cluster, uri)


def test_tasks_that_outlive_an_abort_leave_no_file(tmp_path):
    """The job is aborted while one attempt writes and another hasn't begun."""
    target = str(tmp_path)
    writer = nf.FileWriter(target)

    def aborted_halfway():
        yield batch(("a", b"1"))
        writer.abort([None])
        yield batch(("b", b"22"))

    with pytest.raises(OSError):
        writer.write(aborted_halfway())
    with pytest.raises(OSError):
        writer.write([batch(("c", b"333"))])
    assert files(target) == {} and not os.path.exists(f"{target}/_pending")


def test_notes_are_by_batch_and_an_abort_follows_them(tmp_path):
    """One note a batch, whatever stands in the names; a batch that fails half-way is taken back too."""
    target, odd = str(tmp_path), 'a "b"\nc'
    writer, seen = nf.FileWriter(target), []

    def given():
        yield batch(*[(f"{odd}{k}", b"1") for k in range(50)])
        seen.extend(n for _, _, found in os.walk(os.path.join(target, "_pending")) for n in found)
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        writer.write(given())
    assert seen == ["0.names"] and len(files(target)) == 50
    writer.abort([None])
    assert files(target) == {} and not os.path.exists(f"{target}/_pending")
