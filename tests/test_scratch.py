"""Where intermediate tables go."""

import pytest

from linepulse.scratch import fresh_path, shared_dir


class Conf(dict):
    """A session with these settings and nothing else."""

    @property
    def conf(self):
        return self


def test_the_named_folder_is_used():
    session = Conf({"spark.checkpoint.dir": "hdfs:///shared", "spark.master": "yarn"})
    assert shared_dir(session) == "hdfs:///shared"
    assert fresh_path(session, "x").startswith("hdfs:///shared/linepulse/x-")


def test_only_a_local_session_may_go_without():
    assert shared_dir(Conf({"spark.master": "local[2]"}))
    with pytest.raises(ValueError):
        shared_dir(Conf({"spark.master": "yarn"}))


@pytest.mark.parametrize("master", [None, "", "local-cluster[2,1,1024]", "localhost:7077"])
def test_a_master_that_is_not_known_to_be_local_is_refused(master):
    with pytest.raises(ValueError):
        shared_dir(Conf({"spark.master": master} if master is not None else {}))
