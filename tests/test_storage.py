"""The shared folder."""

from types import SimpleNamespace

import pytest

from allelon import storage


def session(**conf):
    own = {k.replace("_", "."): v for k, v in conf.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: own.get(key, default)))


def test_a_cluster_needs_a_shared_folder():
    assert storage.shared_dir(session(spark_checkpoint_dir="s3://x/y/", spark_master="yarn")) == "s3://x/y"
    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1024]", "k8s://h"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            storage.shared_dir(session(spark_master=master))
    assert storage.shared_dir(session(spark_master="local[4]", spark_app_id="a")) == storage.shared_dir(session(spark_master="local[4]", spark_app_id="a"))


def test_stored_tables_can_be_discarded(spark):
    df = storage.store(spark.range(5), "numbers")
    files = [f.removeprefix("file:").replace("///", "/") for f in df.inputFiles()]
    assert df.count() == 5 and files
    storage.discard(df)
    import os

    assert not any(os.path.exists(f) for f in files)
