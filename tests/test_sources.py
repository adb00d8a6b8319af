import os
from collections import Counter

import pytest

from tallyroll import runtime
from tallyroll.schema import IRIS, RECEIPTS, RECEIPTS_TEST
from tallyroll.sources import (
    inline_rows, random_columns, read_csv_header, read_csv_named, read_delimited_numbers, receipts, receipts_test,
    write_csv_header, write_csv_plain,
)

SF = "/root/testdata/sf0.001"
HEADER = ",".join(RECEIPTS.names) + "\n"


def test_csv_nulls(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(HEADER + "1,2,null,null,null,null,20160601\n1,2,3,30:5,,20160501,\n")
    rows = read_csv_header(spark, str(path), RECEIPTS).collect()
    assert [tuple(r) for r in rows] == [
        (1, 2, None, None, None, None, "20160601"), (1, 2, 3, "30:5", None, "20160501", None)
    ]


def test_csv_round_trip(spark):
    rows = receipts_test(spark, SF)
    for write, read in ((write_csv_header, read_csv_header), (write_csv_plain, read_csv_named)):
        path = runtime.new_path(spark, "test-csv")
        write(rows, path)
        back = read(spark, path, RECEIPTS_TEST)
        assert Counter(map(tuple, back.collect())) == Counter(map(tuple, rows.collect()))


def test_flower_file_forms(spark, tmp_path):
    path = tmp_path / "flowers.data"
    path.write_text("5.1,3.5,1.4,0.2,kind-a\n7.0,3.2,4.7,1.4,kind-b\n\n")
    named = read_csv_named(spark, str(path), IRIS).collect()
    assert [r["kind"] for r in named] == ["kind-a", "kind-b"]
    pairs = read_delimited_numbers(spark, str(path), {"x": 2, "y": 3}).collect()
    assert [tuple(r) for r in pairs] == [(1.4, 0.2), (4.7, 1.4)]


def test_adapter_shape(spark):
    rows = receipts(spark, SF)
    assert rows.count() == 6000 and rows.distinct().count() == 5990
    assert [f.name for f in rows.schema] == [f.name for f in RECEIPTS]
    assert [(f.name, f.dataType) for f in receipts_test(spark, SF).schema] == [(f.name, f.dataType) for f in RECEIPTS_TEST]


def test_small_tables(spark):
    assert inline_rows(spark, [(1, "a")], "n int, t string").collect() == [(1, "a")]
    df = random_columns(spark.range(500), ["id"], ["z"], ("pick", ["a", "b", "c"]), seed=1)
    assert {r["pick"] for r in df.collect()} == {"a", "b", "c"}
    assert abs(df.agg({"z": "avg"}).first()[0]) < 0.2


class Session:
    """Stands for a session with the given settings."""

    def __init__(self, master, setting=None, on_context=None):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: setting or default)})
        self.sparkContext = type("Context", (), {
            "master": master, "applicationId": "app-1", "getCheckpointDir": staticmethod(lambda: on_context)})


def test_shared_folder_comes_from_the_session():
    assert runtime.new_path(Session("yarn", "hdfs://a/b/"), "x").startswith("hdfs://a/b/tallyroll/app-1/x-")
    assert runtime.shared_folder(Session("yarn", None, "hdfs://c")) == "hdfs://c"


def test_the_setting_is_needed():
    for master in ("yarn", "local[4]"):
        with pytest.raises(RuntimeError):
            runtime.shared_folder(Session(master))


def test_staged_tables_can_be_cleared(spark, monkeypatch):
    monkeypatch.setattr(runtime, "_own_folder", lambda s: f"{runtime.shared_folder(s)}/tallyroll/test-clear")
    kept = runtime.stage(spark.range(5), "five")
    files = [f.removeprefix("file:") for f in kept.inputFiles()]
    assert files and all(os.path.exists(f) for f in files)
    runtime.clear_staged(spark)
    assert not any(os.path.exists(f) for f in files)


def test_draws_do_not_depend_on_partitions(spark):
    one = random_columns(spark.range(200), ["id"], ["z"], ("pick", ["a", "b"]), seed=2)
    two = random_columns(spark.range(200).repartition(7), ["id"], ["z"], ("pick", ["a", "b"]), seed=2)
    assert one.orderBy("id").collect() == two.orderBy("id").collect()
    assert len({r["z"] for r in one.collect()}) == 200
