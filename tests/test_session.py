import pytest

from fleetmeter import session


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}/id"


class Session:
    def __init__(self, master, setting=None, folder=None):
        self.sparkContext, self.setting = Context(master, folder), setting
        self.conf = self

    def get(self, name, default):
        return self.setting or default


def test_the_setting_of_the_session_is_used():
    assert session.shared_folder(Session("yarn", "hdfs://x/shared/", "hdfs://y")) == "hdfs://x/shared"


def test_a_folder_given_to_the_context_is_used():
    assert session.shared_folder(Session("yarn", None, "hdfs://y")) == "hdfs://y"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session("spark://host:7077"))


def test_a_local_session_keeps_one_temporary_folder():
    local = Session("local[8]")
    assert session.shared_folder(local) == session.shared_folder(local)


def test_work_folders_are_never_the_same(spark):
    first, second = (session.work_folder(spark, "x") for _ in range(2))
    assert first != second and first.startswith(session.shared_folder(spark))


def test_work_folders_can_be_removed(spark):
    import os

    folder = session.work_folder(spark, "x")
    spark.range(3).write.parquet(folder)
    session.work_folder(spark, "never-written")
    session.remove_work_folders(spark)
    assert not os.path.exists(folder.removeprefix("file:"))
