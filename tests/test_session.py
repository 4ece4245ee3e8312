import pytest

from tallywind.session import ObjectStore, new_folder, shared_root


def test_object_store_settings(monkeypatch):
    monkeypatch.setenv("STORE_KEY", "k")
    monkeypatch.setenv("STORE_SECRET", "s")
    store = ObjectStore("http://store:9000", "STORE_KEY", "STORE_SECRET", ssl=False)
    assert store.settings() == {
        "spark.hadoop.fs.s3a.endpoint": "http://store:9000",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": "false",
        "spark.hadoop.fs.s3a.access.key": "k",
        "spark.hadoop.fs.s3a.secret.key": "s",
    }
    with pytest.raises(KeyError):
        ObjectStore("http://store:9000", "STORE_MISSING").settings()
    assert "spark.hadoop.fs.s3a.access.key" not in ObjectStore("http://store:9000").settings()


def test_folders_lie_below_the_shared_root(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    assert first != second and first.startswith(root)


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


class _Remote:
    """A session of a cluster without a shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "spark://host:7077"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        shared_root(_Remote)
