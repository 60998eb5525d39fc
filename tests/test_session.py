import os

import pytest

from peakloom import session


class Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: {"spark.master": "spark://host:7077"}.get(key, default))

    class sparkContext:
        getCheckpointDir = staticmethod(lambda: None)


def test_clusters_need_a_shared_folder():
    with pytest.raises(ValueError):
        session.shared_folder(Cluster)


def test_staged_tables_are_cleared(spark):
    df = session.staged(spark.range(5))
    assert df.count() == 5
    folder = session._staging(spark)
    assert os.path.isdir(folder.removeprefix("file:"))
    assert session.clear_staged(spark) and not os.path.isdir(folder.removeprefix("file:"))
