import os
from types import SimpleNamespace

import pytest

from tapeloom import session


def test_written_files_are_released(spark):
    with session.released(spark):
        df = session.materialize(spark.range(10), "released")
        path = df.inputFiles()[0].removeprefix("file:")
        assert df.count() == 10 and os.path.exists(path)
    assert not os.path.exists(path)


def test_no_machine_local_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda key, default: None)
    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1000]", "k8s://x"):
        with pytest.raises(RuntimeError):
            session.scratch(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)))
