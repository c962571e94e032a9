from types import SimpleNamespace

import pytest

from stockrecon.session import SETTINGS, shared_folder, tune


def fake(master, folder=None):
    conf = {} if folder is None else {"spark.checkpoint.dir": folder}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default), set=conf.__setitem__),
        sparkContext=SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=conf.get)),
    )


def test_cluster_must_name_a_shared_folder():
    with pytest.raises(ValueError):
        shared_folder(fake("spark://host:7077"))


def test_named_folder_is_used():
    assert shared_folder(fake("spark://host:7077", "hdfs://data/scratch/")) == "hdfs://data/scratch"


def test_local_session_gets_one_folder_and_keeps_it():
    session = fake("local[2]")
    assert shared_folder(session) == shared_folder(session)


def test_tune_sets_every_setting(spark):
    tune(spark)
    assert {key: spark.conf.get(key) for key in SETTINGS} == SETTINGS
