from types import SimpleNamespace

import pytest

from turnmill.checkpoints import store, use_checkpoint_dir


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(context, **settings):
    conf = SimpleNamespace(get=lambda key, default: settings.get(key.replace(".", "_"), default))
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_sessions_folder_is_used():
    context = Context("spark://somewhere")
    use_checkpoint_dir(session(context, spark_checkpoint_dir="shared"))
    assert context.folder == "shared"
    use_checkpoint_dir(session(context, spark_checkpoint_dir="other"))
    assert context.folder == "shared"


def test_a_cluster_needs_the_setting():
    with pytest.raises(RuntimeError):
        use_checkpoint_dir(session(Context("spark://somewhere")))
    context = Context("local[2]")
    use_checkpoint_dir(session(context))
    assert context.folder


def test_stored_tables_come_back_whole(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, text string")
    stored = store(df)
    assert sorted(map(tuple, stored.collect())) == [(1, "a"), (2, None)]
    assert stored.schema == df.schema
    assert store(df.where("id > 5")).count() == 0
