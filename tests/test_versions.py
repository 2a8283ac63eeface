"""Tables overwritten in whole versions."""

import pytest

from cityzones.sources import versions as v


def ids(df):
    return sorted(r.id for r in df.collect())


def test_readers_keep_the_version_they_began_on(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    v.overwrite_table(spark.range(3), root)
    old = v.read_table(spark, root)
    v.overwrite_table(old.where("id > 0"), root)  # reads the table that it replaces
    assert ids(old) == [0, 1, 2] and ids(v.read_table(spark, root)) == [1, 2]


def test_a_writer_that_dies_leaves_the_old_table(spark, tmp_dir, monkeypatch):
    root = f"{tmp_dir}/t"
    first = v.overwrite_table(spark.range(2), root)

    def dies(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:  # after the data, before the pointer
        m.setattr(v, "publish", dies)
        with pytest.raises(RuntimeError):
            v.overwrite_table(spark.range(9), root)
    assert v.current_version(spark, root) == first and ids(v.read_table(spark, root)) == [0, 1]
    with pytest.raises(Exception):  # in the middle of the data
        v.overwrite_table(spark.range(4).selectExpr("raise_error('x') as id"), root)
    assert ids(v.read_table(spark, root)) == [0, 1]
    v.overwrite_table(spark.range(5), root, keep=1)
    assert ids(v.read_table(spark, root)) == [0, 1, 2, 3, 4] and len(v.list_versions(spark, root)) == 1


def test_versions_expire_by_count_and_roll_back(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    names = [v.overwrite_table(spark.range(i + 1), root, keep=3) for i in range(5)]
    assert v.list_versions(spark, root) == names[2:]
    v.publish(spark, root, names[3])
    assert ids(v.read_table(spark, root)) == [0, 1, 2, 3]
    assert ids(v.read_table(spark, root, names[4])) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        v.publish(spark, root, names[0])
    assert v.expire(spark, root, 1) == names[2:3]  # newer than the one in use stays


def test_partitions_and_a_table_never_written(spark, tmp_dir):
    with pytest.raises(ValueError):
        v.read_table(spark, f"{tmp_dir}/none")
    root = f"{tmp_dir}/t"
    v.overwrite_table(spark.range(10).selectExpr("id", "id % 2 as p"), root, partition_by=["p"])
    assert ids(v.read_table(spark, root).where("p = 1")) == [1, 3, 5, 7, 9]
