"""The state table in levels against the changelog's restore."""

import os

import pytest
from pyspark.sql import functions as F

from tallyflow.operators import changelog
from tallyflow.operators.state_table import StateTable

KIND = "product string, partition int, last_offset long, count long, mean double, m2 double, min double, max double, last_updated timestamp"


def _entries(spark, low, high):
    i = F.col("id")
    key = i * 7 % 40
    return spark.range(low, high).select(F.concat(F.lit("p"), key).alias("product"), (key % 3).cast("int").alias("partition"), i.alias("last_offset"), (i + 1).alias("count"), i.cast("double").alias("mean"), F.lit(0.5).alias("m2"), F.lit(1.0).alias("min"), F.lit(9.0).alias("max"), F.timestamp_millis(1000 - i).alias("last_updated"))


def _rows(df):
    return sorted(tuple(r[c] for c in ("product", "partition", "last_offset", "count", "mean")) for r in df.collect())


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    table = StateTable(spark, str(tmp_path_factory.mktemp("t")), fanout=3)
    for n in range(12):
        assert table.append(_entries(spark, n * 25, n * 25 + 25), "w", n)
    return table


def test_levels_equal_the_changelog(spark, filled):
    levels = [len(level) for level in filled.manifest()["levels"]]
    assert levels == [0, 1, 1]  # twelve runs: nine in one, three in one
    log = changelog.encode(_entries(spark, 0, 300), "last_offset", "partition").withColumns({"topic": F.lit("s"), "offset": F.col("last_offset"), "timestamp": F.timestamp_millis(F.lit(0))})
    want = _rows(changelog.restore(log))
    assert _rows(filled.read()) == want and len(want) == 40
    assert _rows(filled.read([0, 2])) == _rows(changelog.restore(log, [0, 2]))
    assert not filled.append(_entries(spark, 0, 5), "w", 11)  # a repeated batch
    for _ in range(3):
        filled.compact(everything=True)
        assert _rows(filled.read()) == want
    assert sum(len(level) for level in filled.manifest()["levels"]) == 1


def test_older_rows_do_not_win_and_odd_rows_are_skipped(spark, tmp_path):
    table = StateTable(spark, str(tmp_path), fanout=100)
    with pytest.raises(ValueError, match="nothing"):
        table.read()
    table.append(_entries(spark, 100, 140))
    table.append(_entries(spark, 0, 40))  # late: lower offsets
    odd = spark.createDataFrame([(None, 1, 500, 1, 1.0, 1.0, 1.0, 1.0, None), ("p1", None, 500, 1, 1.0, 1.0, 1.0, 1.0, None), ("p1", 1, None, 1, 1.0, 1.0, 1.0, 1.0, None)], KIND)
    table.append(odd)
    table.append(odd.where("false"))
    assert _rows(table.read()) == _rows(_entries(spark, 100, 140))
    table.compact(everything=True)
    assert _rows(table.read()) == _rows(_entries(spark, 100, 140))


def test_drop_and_restore_touch_their_partitions_alone(spark, tmp_path):
    table = StateTable(spark, str(tmp_path))
    table.append(_entries(spark, 0, 200))
    files = {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(tmp_path / "runs") for f in fs}
    kept = _rows(table.read([0, 2]))
    read = table.read([1])
    assert read.inputFiles() and all("/__p=1/" in f for f in read.inputFiles())
    assert table.drop([1]) == len(_rows(_entries(spark, 0, 40).where("partition = 1")))
    assert table.read([1]).count() == 0 and _rows(table.read()) == kept
    table.restore([1], _entries(spark, 40, 80))
    assert _rows(table.read([1])) == _rows(_entries(spark, 40, 80).where("partition = 1")) and _rows(table.read([0, 2])) == kept
    assert all(os.stat(f).st_mtime_ns == t for f, t in files.items())
    assert table.sweep() == 1 and _rows(table.read([0, 2])) == kept  # the folder that was dropped


def test_a_write_that_stops_before_the_manifest_is_not_seen(spark, tmp_path):
    table = StateTable(spark, str(tmp_path))
    table.append(_entries(spark, 0, 40), "w", 0)
    table._write(_entries(spark, 40, 80))  # the run is there, the manifest was never changed
    assert _rows(table.read()) == _rows(_entries(spark, 0, 40))
    assert table.append(_entries(spark, 40, 80), "w", 1) and _rows(table.read()) == _rows(_entries(spark, 40, 80))
    stale = table.manifest()["levels"][0]
    table.drop([0])
    assert stale != table.manifest()["levels"][0] and table.compact(everything=True) == 1 and table.read([0]).count() == 0
