"""File arrivals, folders by time, stored statistics, numbering of bursts, hot keys of a merge."""

import gzip
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mailtally.operators import latest, profile, statistics, upsert
from mailtally.plans import queries_sinks
from mailtally.plans.catalog import QUERIES
from mailtally.session import RunFolder
from mailtally.sources import catalog, messages


def test_arrivals_of_texts(spark, tmp_path):
    schema = spark.createDataFrame([], "a int, b string").schema
    good, cut = '{"a": 1, "b": "x"}\n', '{"a": 1, "b"'
    files = {
        "good.json": good * 3, "empty.json": "", "cut.json": good + cut, "lines.json": "\n\n",
        "type.json": good + '{"a": "no number", "b": "x"}\n', "blank.json": "{}\n" + good,
    }
    for name, text in files.items():
        folder = tmp_path / "day=1" if name == "good.json" else tmp_path
        folder.mkdir(exist_ok=True)
        (folder / name).write_text(text)
    (tmp_path / "noise.json.gz").write_bytes(b"no gzip at all")
    (tmp_path / "fine.json.gz").write_bytes(gzip.compress(good.encode()))
    (tmp_path / "_hidden.json").write_text(good)
    got = {
        r.input_file_name.rsplit("/", 1)[1]: (r.rows, r.blank_rows, r.broken_rows, r.bronze_status, r.reason)
        for r in catalog.file_arrivals(spark, str(tmp_path), schema).collect()
    }
    assert got == {
        "good.json": (3, 0, 0, "LOADED", None),
        "fine.json.gz": (1, 0, 0, "LOADED", None),
        "blank.json": (2, 1, 0, "LOADED", None),
        "empty.json": (0, 0, 0, "FAILED", "empty file"),
        "lines.json": (0, 0, 0, "FAILED", "no readable record"),
        "noise.json.gz": (0, 0, 0, "FAILED", "no readable record"),
        "cut.json": (1, 0, 1, "FAILED", "1 broken records"),
        "type.json": (1, 0, 1, "FAILED", "1 broken records"),
    }


def test_arrivals_of_column_files(spark, tmp_path):
    path = tmp_path / "p"
    spark.range(40).repartition(2).write.parquet(str(path))
    first, second = sorted(path.glob("part-*.parquet"))
    raw = first.read_bytes()
    for f in path.glob(".*.crc"):
        f.unlink()
    first.write_bytes(raw[: len(raw) // 2])
    rows = catalog.file_arrivals(spark, str(path), spark.range(1).schema, "parquet").collect()
    got = {r.input_file_name.rsplit("/", 1)[1]: (r.bronze_status, r.reason) for r in rows}
    assert got == {first.name: ("FAILED", "no readable record"), second.name: ("LOADED", None)}


@pytest.mark.parametrize("unit", ["day", "week", "month", "year"])
def test_a_time_bound_prunes_folders(spark, tmp_path, plan, unit):
    path = str(tmp_path / "by")
    df = spark.sql(
        "SELECT id, timestamp '2023-12-20 05:00:00' + make_dt_interval(id) AS received_ts FROM range(60)"
        " UNION ALL SELECT 99, null"
    )
    stored = messages.add_time_part(df, unit=unit)
    stored.write.partitionBy("received_part").parquet(path)
    back = spark.read.schema(stored.schema).parquet(path)
    for bound in ("2024-01-15 05:00:00", "2024-01-01 00:00:00"):
        got = messages.since(back, bound, part="received_part", unit=unit)
        assert {r.id for r in got.collect()} == {r.id for r in messages.since(df, bound).collect()}
        text = plan(got)
        assert "received_part" in text.split("PartitionFilters: [")[1].split("]")[0]
    days = messages.days_back(back, 20, "2024-02-10 05:00:00", part="received_part", unit=unit)
    assert days.count() == messages.days_back(df, 20, "2024-02-10 05:00:00").count()
    # the folders before are not opened: what lies there may be no Parquet at all
    for old in (tmp_path / "by").glob("received_part=2023-1*/part-*"):
        (old.parent / f".{old.name}.crc").unlink(missing_ok=True)
        old.write_bytes(b"broken")
    if unit in ("day", "month"):
        late = messages.since(back, "2024-02-03 00:00:00", part="received_part", unit=unit)
        assert late.count() == messages.since(df, "2024-02-03 00:00:00").count()


def test_statistics_of_a_new_partition_only(spark, tmp_path):
    path, stats = tmp_path / "table", str(tmp_path / "stats")
    df = spark.sql(
        "SELECT IF(id % 9 = 0, null, id) AS v, CAST(id % 40 AS STRING) AS s, map('k', id) AS m,"
        " IF(id < 1000, null, CAST(id DIV 1000 AS INT)) AS part FROM range(5000)"
    )
    df.write.partitionBy("part").parquet(str(path))
    table = spark.read.schema(df.schema).parquet(str(path))
    statistics.refresh_statistics(table.where("part IS NULL OR part < 4"), ["part"], stats)
    for old in path.glob("part=[_123]*/part-*"):
        (old.parent / f".{old.name}.crc").unlink(missing_ok=True)
        old.write_bytes(b"broken")
    for _ in range(2):  # the second time there is nothing to do
        found = statistics.refresh_statistics(table, ["part"], stats)
    assert found.count() == 5 * 3
    got = {r.column: r for r in statistics.profile_from(found).collect()}
    want = {r.column: r for r in profile.profile(df).collect()}
    for c in ("v", "s", "m"):
        assert (got[c].total_rows, got[c].null_count) == (want[c].total_rows, want[c].null_count)
        assert abs(got[c].distinct_count - want[c].distinct_count) <= 0.03 * want[c].distinct_count + 1
    assert (got["v"].min_value, got["v"].max_value, got["s"].min_value) == (1, 4999, None)
    assert abs(got["v"].median_value - 2500) < 100 and got["s"].median_value is None
    fresh = spark.range(10).selectExpr("id AS v", "'x' AS s", "map('k', id) AS m", "4 AS part")
    found = statistics.refresh_statistics(fresh, ["part"], stats, again=[(4,)])
    assert {r.total_rows for r in found.where("part = 4").collect()} == {10}
    assert found.count() == 5 * 3


def test_a_burst_is_spread_and_numbered_like_one_window(spark):
    df = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.lit("2026-01-01 00:00:00").cast("timestamp").alias("received_ts"),
        F.concat(F.lit("m-"), F.col("id").cast("string")).alias("id"),
    )
    want = df.selectExpr("*", "row_number() OVER (PARTITION BY k ORDER BY received_ts, id) AS version")
    as_set = lambda d: Counter((r.k, r.id, r.version) for r in d.collect())
    assert as_set(latest.version_resends(df, ["k"], bursts=True)) == as_set(want)
    ranged = latest.in_ranges(df, [F.col("k"), F.col("received_ts"), F.col("id")], 16)
    groups = [r["count"] for r in ranged.groupBy("k", latest.RANGE).count().collect()]
    assert max(groups) < 2 * 40_000 / 16


def test_positions_survive_a_shuffle(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"))
    with RunFolder(spark, "positions") as run:
        placed = latest.with_position(df, [F.col("v").desc()], run=run).repartition(7, "v")
        assert {(r.v, r.position) for r in placed.collect()} == {(v, 5000 - v) for v in range(5000)}
    assert latest.with_position(df.limit(0), [F.col("v")]).collect() == []


ROWS = "k string, n int, received_ts int"


@pytest.mark.parametrize("guard", [None, "received_ts"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_both_merges_agree(spark, guard, null_safe):
    target = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 1), ("b", 3, 5), (None, 4, 5), (None, 5, 5), ("d", 6, None)], ROWS
    )
    source = spark.createDataFrame(
        [("a", 10, 3), ("a", 11, 2), ("c", 12, 1), (None, 13, 9), (None, 14, 9), ("d", 15, 1)], ROWS
    ).withColumn("extra", F.lit("x"))
    plain, split = (
        upsert.merge_frames(target, source, ["k"], guard, null_safe, hot_keys=hot) for hot in (False, True)
    )
    assert plain.columns == split.columns
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, split.collect()))


def test_a_hot_key_of_the_target_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    target = spark.range(0, 60_000, 1, 8).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS v", "uuid() AS w")
    source = spark.range(500).selectExpr("id AS k", "-id AS v")
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plans = []
        for hot in (False, True):
            merged = upsert.merge_frames(target, source, "k", guard=None, hot_keys=hot)
            assert merged.where("v <= 0").count() > 20_000
            merged.collect()
            plans.append(merged._jdf.queryExecution().executedPlan().toString())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plans[1] and "skew=true" not in plans[0]


def test_queries_of_landing_folders_do_not_use_python(spark, sf, plan):
    for name in ("w_resend_burst", "j_match_hot", "l_lineage_order"):
        assert "Python" not in plan(QUERIES[name](spark, sf))


def test_messages_of_the_dedup_stream_land_compressed(spark, sf, monkeypatch, tmp_path):
    monkeypatch.setattr(queries_sinks, "scratch_path", lambda _, name: str(tmp_path / name))
    found = queries_sinks.m_stream_dedup(spark, sf)
    landed = [f for f in (tmp_path / "twice").iterdir() if f.name.startswith("part-")]
    assert landed and all(f.name.endswith(".json.gz") for f in landed)
    orders = spark.read.parquet(f"{sf}/orders.parquet").count()
    assert spark.read.json(str(tmp_path / "twice")).count() == 2 * orders
    assert found.count() == found.distinct().count() == orders
