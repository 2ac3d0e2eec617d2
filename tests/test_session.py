import pytest

from ledgermill import session


class Conf:
    def __init__(self, folder):
        self.folder = folder

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" else default


class Session:
    def __init__(self, folder, application="app-1", master="local[2]"):
        self.conf = Conf(folder)
        self.sparkContext = type("Context", (), {"applicationId": application, "master": master})


def test_the_cluster_names_the_folder():
    assert session.shared_folder(Session("hdfs:///shared")) == "hdfs:///shared"


def test_a_session_without_the_setting_keeps_one_folder():
    first = session.shared_folder(Session(None))
    assert first == session.shared_folder(Session(None)) != session.shared_folder(Session(None, "app-2"))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_without_the_setting_is_refused(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session(None, master=master))


def test_written_tables_read_back_unchanged(spark):
    df = spark.sql("select 1 as a, cast(null as decimal(5,2)) as b, array('x') as c")
    again = session.written(df, "t")
    assert again.schema.simpleString() == df.schema.simpleString() and again.collect() == df.collect()
    assert session.written(df.where("a > 1"), "t").count() == 0


def test_layers_are_written_once_and_rebuilt_when_cleared(spark, monkeypatch):
    from ledgermill.contract import layers

    monkeypatch.setattr(layers, "_written", {})
    small = layers.Layers(spark, "/root/testdata/sf0.001")
    rows = small["bronze_customers"].count()
    ((key, (path, schema)),) = layers._written.items()
    assert layers.Layers(spark, "/root/testdata/sf0.001")["bronze_customers"].count() == rows
    assert layers._written[key][0] == path
    layers._written[key] = (path + "-gone", schema)
    assert small["bronze_customers"].count() == rows and layers._written[key][0] != path
