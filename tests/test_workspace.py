"""Where scratch folders go."""

import pytest

from hirefunnel.workspace import configure, scratch


class Session:
    """The settings of a session, which a running one does not let go of."""

    def __init__(self, **settings):
        self.values = {f"spark.{k}": v for k, v in settings.items()}
        self.conf = self

    def get(self, key, default):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


def test_the_named_folder_goes_below_the_shared_one():
    session = configure(Session(master="spark://host:1"), "hdfs://host/scratch/")
    made = [scratch(session, "rows") for _ in range(2)]
    assert all(m.startswith("hdfs://host/scratch/rows-") for m in made)
    assert made[0] != made[1]
    session.set("spark.checkpoint.dir", "hdfs://host/shared")
    assert scratch(session, "rows").startswith("hdfs://host/shared/rows-")


def test_one_folder_of_its_own_for_a_single_process():
    first, second = (scratch(Session(master="local[4]"), "rows") for _ in range(2))
    assert first != second
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "yarn", ""])
def test_no_machine_local_folder_where_executors_are_apart(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch(Session(master=master), "rows")
