import os
import tempfile


from shelfaudit.plans.photos import photo_names
from shelfaudit.sources.attachments import export_files


def test_export_writes_one_file_per_named_row(spark):
    df = spark.createDataFrame([(5, 1, 77, b"abc"), (None, 1, 78, b"zz"), (6, 2, 79, None)],
                               "fileid int, masterfid int, orid int, filedata binary")
    named = photo_names(df, "fileid", "masterfid", "orid", ".jpg")
    assert sorted(str(r.file_name) for r in named.collect()) == ["5_177.jpg", "6_279.jpg", "None"]
    target = tempfile.mkdtemp(prefix="export-")
    res = export_files(named, "file_name", "filedata", "file://" + target).collect()
    assert sorted((r.file_name, r.n_bytes) for r in res) == [("5_177.jpg", 3), ("6_279.jpg", 0)]
    assert sorted(os.listdir(target)) == ["5_177.jpg", "6_279.jpg"]
    with open(os.path.join(target, "5_177.jpg"), "rb") as fh:
        assert fh.read() == b"abc"


def test_export_photos_guard_and_selection(spark):
    from shelfaudit.plans.photos import export_photos

    docs = spark.createDataFrame([(1, 77, 230), (1, 78, 230)], "masterfid int, orid int, ortype int")
    att = spark.createDataFrame(
        [(1, 77, f, bytes([f])) for f in (5, 6, 7, 8)] + [(1, 78, 9, b"x")],
        "masterfid int, docid int, fileid int, filedata binary")
    target = tempfile.mkdtemp(prefix="photos-")
    res = export_photos(docs, att, [("masterfid", "masterfid"), ("orid", "docid")], "orid", "fileid",
                        "masterfid", "orid", "filedata", target)
    assert sorted(r.file_name for r in res.collect()) == ["5_177.jpg", "6_177.jpg", "7_177.jpg", "9_178.jpg"]
    assert sorted(os.listdir(target)) == ["5_177.jpg", "6_177.jpg", "7_177.jpg", "9_178.jpg"]
    empty = docs.where("orid < 0")
    assert export_photos(empty, att, [("masterfid", "masterfid"), ("orid", "docid")], "orid", "fileid",
                         "masterfid", "orid", "filedata", target) is None


def test_target_without_scheme_only_in_a_local_session(spark, monkeypatch):
    import pytest

    from shelfaudit.sources import attachments

    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077"

    class Frame:
        class sparkSession:
            conf = Conf()

    with pytest.raises(ValueError):
        attachments._check_target(Frame, "/some/folder")
    attachments._check_target(Frame, "hdfs:///some/folder")


def test_a_retry_writes_the_same_files(spark):
    """A second run over the same target (a lost executor's task, redone) replaces each file."""
    df = spark.createDataFrame([("a.jpg", b"one"), ("b.jpg", b"two")], "n string, d binary")
    target = tempfile.mkdtemp(prefix="retry-")
    for _ in range(2):
        assert export_files(df, "n", "d", target).count() == 2
    assert sorted(os.listdir(target)) == ["a.jpg", "b.jpg"]
    with open(os.path.join(target, "b.jpg"), "rb") as fh:
        assert fh.read() == b"two"


def test_staged_tables_are_removed(spark):
    from shelfaudit.session import stage, staged_root, staged_tables

    outside = stage(spark.range(3), "kept")
    with staged_tables(spark):
        assert stage(spark.range(5), "gone").count() == 5
    names = os.listdir(staged_root(spark).removeprefix("file:"))
    assert not any(n.startswith("gone-") for n in names) and outside.count() == 3


def test_no_local_checkpoint_folder_on_a_cluster(monkeypatch):
    import pytest

    from shelfaudit import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

        @property
        def sparkContext(self):
            raise RuntimeError("none")

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())
