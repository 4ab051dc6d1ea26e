import pytest

from tierflow.session import configure, shared_dir


def test_own_choices_stand(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32m")
    other.conf.set("spark.sql.session.timeZone", "America/Bogota")
    configure(other)
    assert other.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32m"
    assert other.conf.get("spark.sql.session.timeZone") == "UTC"
    assert other.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


class Session:
    """As much of a session as a scratch folder depends on."""

    def __init__(self, master, **conf):
        self.conf = conf
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_folders():
    cluster = Session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    one, two = shared_dir(cluster, "x"), shared_dir(cluster, "x")
    assert one.startswith("hdfs:///shared/tierflow/x-") and one != two


def test_scratch_folder_without_the_setting():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session("yarn"), "x")
    assert "/tierflow/x-" in shared_dir(Session("local[8]"), "x")


def test_partition_values_are_written_side_by_side(spark):
    other = configure(spark.newSession())
    assert int(other.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 31


class Conf(dict):
    """As much of a session's settings as configuring it depends on."""

    set = dict.__setitem__

    @property
    def getAll(self):
        return dict(self)


def test_shuffles_of_a_cluster_are_cut_small():
    session = Session("yarn")
    session.conf, session.sparkContext.defaultParallelism = Conf({"spark.sql.shuffle.partitions": "36"}), 12
    configure(session)
    assert int(session.conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 192
    assert session.conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "32m"
