from types import SimpleNamespace

import pytest

from prefkit.session import MIB, configure, input_bytes_of, is_local, scratch_path, shared_dir, sized_conf


def test_sized_conf():
    c = sized_conf(100 * 1024**4, cores=4000)  # 100 TB on 1000 executors x 4 cores
    assert int(c["spark.sql.shuffle.partitions"]) == 200_000  # capped; ~500 MiB each
    assert int(sized_conf(10 * 1024**4, cores=4000)["spark.sql.shuffle.partitions"]) == 40960
    assert c["spark.sql.adaptive.enabled"] == "true"
    small = sized_conf(10 * MIB, cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_configure_and_shared_dir(spark):
    configure(spark)
    d = shared_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir") == d
    assert scratch_path(spark, "x").startswith(d.rstrip("/") + "/prefkit-x-")
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    configure(spark, input_bytes=2048 * MIB, cores=2)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    spark.conf.set("spark.sql.shuffle.partitions", prev)


def test_a_cluster_must_name_its_shared_folder():
    def session(master):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None)
        conf = SimpleNamespace(get=lambda k, d=None: d, set=lambda k, v: None)
        return SimpleNamespace(sparkContext=sc, conf=conf)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))
    assert is_local("local[4]") and not is_local("local-cluster[3,2,1024]")
    assert shared_dir(session("local"))


def test_input_bytes(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x" * 10)
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "b.csv").write_text("x" * 7)
    assert input_bytes_of(spark, str(tmp_path / "a.csv"), str(tmp_path / "d")) == 17
