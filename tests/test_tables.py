"""Upserts, sinks, windows, reconciliation, profiles: edge cases and plan shapes."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mailtally.operators import latest, observe, profile, recon, sinks, upsert, versions
from mailtally.plans import fixtures as fx
from mailtally.plans.catalog import QUERIES
from mailtally.plans.intake import scheduled_intake
from mailtally.plans.queries_messages import kv, kv_rules
from mailtally.plans.registry import fresh_table
from mailtally.session import RunFolder, shared_dir
from mailtally.sources.messages import standardize, stream_messages
from mailtally.streaming import intake as stream

ROW = "customer_code string, payment_due_label string, payment_amount double, received_ts timestamp, email_unique_id string"
KEYS = ["customer_code", "payment_due_label"]


def rec(spark, *rows):
    df = spark.createDataFrame([(c, l, a, t, i) for c, l, a, t, i in rows], ROW.replace("timestamp", "string"))
    return df.withColumn("received_ts", F.to_timestamp("received_ts"))


def amounts(df):
    return Counter((r.customer_code, r.payment_due_label, r.payment_amount) for r in df.collect())


T1, T2, T3 = "2026-01-01 00:00:00", "2026-01-02 00:00:00", "2026-01-03 00:00:00"


def test_merge_updates_inserts_and_guards(spark):
    target = rec(spark, ("a", "x", 1.0, T2, "1"), ("b", "x", 2.0, T2, "2"))
    source = rec(spark, ("a", "x", 9.0, T3, "3"), ("b", "x", 8.0, T1, "4"), ("c", "x", 7.0, T1, "5"))
    assert amounts(upsert.merge_frames(target, source, KEYS)) == Counter(
        [("a", "x", 9.0), ("b", "x", 2.0), ("c", "x", 7.0)]
    )
    assert amounts(upsert.merge_frames(target, source, KEYS, guard=None)) == Counter(
        [("a", "x", 9.0), ("b", "x", 8.0), ("c", "x", 7.0)]
    )
    assert amounts(upsert.merge_frames(target, source, "customer_code")) == Counter(
        [("a", "x", 9.0), ("b", "x", 2.0), ("c", "x", 7.0)]
    )


def test_merge_source_duplicates_and_null_keys(spark):
    target = rec(spark, (None, "x", 1.0, T1, "1"))
    source = rec(
        spark, ("a", "x", 1.0, T1, "2"), ("a", "x", 2.0, T2, "3"), ("a", "x", 3.0, T2, "4"),
        (None, "x", 5.0, T2, "5"), (None, "x", 5.0, T2, "5"),
    )
    assert amounts(upsert.merge_frames(target, source, KEYS)) == Counter(
        [(None, "x", 1.0), ("a", "x", 3.0), (None, "x", 5.0), (None, "x", 5.0)]
    )
    assert amounts(upsert.merge_frames(target, source, KEYS, null_safe=True)) == Counter(
        [("a", "x", 3.0), (None, "x", 5.0)]
    )


def test_merge_with_other_columns(spark):
    target = rec(spark, ("a", "x", 1.0, T1, "1")).withColumn("note", F.lit("kept"))
    source = rec(spark, ("a", "x", 2.0, T2, "2"), ("b", "x", 3.0, T2, "3")).withColumn("extra", F.lit("new"))
    got = {r.customer_code: (r.payment_amount, r.note, r.extra)
           for r in upsert.merge_frames(target, source, KEYS).collect()}
    assert got == {"a": (2.0, "kept", "new"), "b": (3.0, None, "new")}


def test_upsert_table_is_idempotent(spark):
    table = fresh_table("t")
    batch = rec(spark, ("a", "x", 1.0, T1, "1"), ("b", "x", 2.0, T1, "2"))
    assert upsert.upsert(batch.filter("false"), table, KEYS) == 0
    assert not spark.catalog.tableExists(table)
    for _ in range(2):
        assert upsert.upsert(batch, table, KEYS, as_of=T1) == 2
    assert amounts(spark.table(table)) == Counter([("a", "x", 1.0), ("b", "x", 2.0)])
    assert str(spark.table(table).first().last_update_s) == "2026-01-01 09:00:00"
    spark.sql(f"DROP TABLE {table}")


def test_append_counts_and_evolves(spark):
    table = fresh_table("t")
    batch = rec(spark, ("a", "x", 1.0, T1, "1"))
    assert sinks.append(batch, table, as_of=T1) == 1
    assert sinks.append(batch.filter("false"), table) == 0
    with pytest.raises(ValueError):
        sinks.append(batch.withColumn("extra", F.lit(1)), table, as_of=T1)
    assert sinks.append(batch.withColumn("extra", F.lit(1)), table, as_of=T1, evolve=True) == 1
    assert Counter(r.extra for r in spark.table(table).collect()) == Counter([None, 1])
    spark.sql(f"DROP TABLE {table}")


def test_scheduled_intake_twice_changes_nothing(spark, sf):
    table, log = fresh_table("t"), fresh_table("log")
    mails = kv(spark, sf)
    first = scheduled_intake(spark, mails, kv_rules(), table, log, as_of=T1, label_mode="normalized")
    before = amounts(spark.table(table))
    assert first > 0
    assert scheduled_intake(spark, mails, kv_rules(), table, log, as_of=T1, label_mode="normalized") == 0
    assert amounts(spark.table(table)) == before
    statuses = {r.status for r in spark.table(log).select("status").distinct().collect()}
    assert statuses == {"SUCCESS", "NO_TABLE_FOUND"}


def test_an_intake_writes_its_records_once(spark, sf, tmp_path, monkeypatch):
    """They are in the file of the extracts; the upsert reads them there."""
    kept = []
    keep = RunFolder.keep
    monkeypatch.setattr(RunFolder, "keep", lambda run, df, name: (kept.append(name), keep(run, df, name))[1])
    mails = kv(spark, sf)
    batch = [fresh_table(x) for x in ("t", "log", "state")]
    assert scheduled_intake(spark, mails, kv_rules(), *batch, as_of=T1, label_mode="normalized") > 0
    once = ["extracts", *[f"source-{i}" for i in range(len(upsert.key_groups(kv_rules())))], "state"]
    assert kept == once
    kept.clear()
    names, path = [fresh_table(x) for x in ("s", "log", "state")], str(tmp_path / "in")
    fx.payloads(mails).repartition(2).write.json(path)
    flat = standardize(stream_messages(spark, path))
    offsets = str(tmp_path / "offsets")
    stream.drain(stream.intake_stream(flat, kv_rules(), *names, offsets, as_of=T1, label_mode="normalized"))
    assert kept == once


def test_stream_equals_batch(spark, sf):
    standard = Counter(QUERIES["s_message_scan"](spark, sf).collect())
    assert Counter(QUERIES["m_stream_intake"](spark, sf).collect()) == standard


def test_merge_text_for_row_level_tables(spark):
    text = upsert.merge_statement("lake.fin.saved", "batch", KEYS, "received_ts")
    assert "MERGE INTO lake.fin.saved AS target" in text
    assert "target.customer_code = source.customer_code AND target.payment_due_label = source.payment_due_label" in text
    parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    assert parsed.startswith("'MergeIntoTable")


# --- windows ------------------------------------------------------------------------------------


def test_numbering_of_a_hot_key_equals_one_window(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("k"),
        (F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(secs=(F.col("id") * 37 % 90000).cast("decimal(18,6)"))).alias("received_ts"),
        F.col("id").cast("string").alias("id"),
    )
    numbered = latest.version_resends(df, ["k"])
    expected = df.selectExpr("*", "row_number() OVER (PARTITION BY k ORDER BY received_ts, id) AS version")
    as_set = lambda d: Counter((r.id, r.version) for r in d.collect())
    assert as_set(numbered) == as_set(expected)


def test_numbering_parses_and_shuffles_once(spark, sf):
    df = QUERIES["w_resend"](spark, sf)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_large_n_gives_the_same_rows(spark):
    df = spark.range(6000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    top = latest.first_n_per_key(df, ["k"], [F.col("v").desc()], 1500)
    got = Counter(r.k for r in top.filter("v >= 3000").collect())
    assert got == Counter({0: 1500, 1: 1500}) and top.count() == 3000


def test_rows_with_maps(spark):
    df = spark.sql(
        "SELECT id % 2 AS id, map('b', id, 'a', 1) AS m, named_struct('x', map(1, id)) AS s, "
        "timestamp '2024-01-01' AS received_ts FROM range(6)"
    )
    assert latest.newest_copy(df, "id").count() == 2
    counts = {r.column: r.distinct_count for r in profile.profile(df).collect()}
    assert counts == {"id": 2, "m": 6, "s": 6, "received_ts": 1}


def test_versions_stay_in_the_folder_of_the_table(spark, tmp_path):
    table, home = fresh_table("t"), str(tmp_path / "home")
    before = set(stage_folders(spark))
    for i in range(4):
        upsert.upsert(rec(spark, ("a", "x", float(i), T1, str(i))), table, KEYS, path=home, as_of=T1)
        assert sinks.table_location(spark, table).removeprefix("file:").startswith(home)
    assert [r.payment_amount for r in spark.table(table).collect()] == [3.0]
    assert len([p for p in (tmp_path / "home").iterdir() if p.name.startswith("_version-")]) == 2
    assert set(stage_folders(spark)) == before  # no stage folder is left
    spark.sql(f"DROP TABLE {table}")


def stage_folders(spark):
    folder = Path(shared_dir(spark)) / "mailtally"
    return [p.name for p in folder.iterdir()] if folder.exists() else []


def test_partitions_of_a_table(spark):
    """A row moves to another partition; the one that it leaves empty goes, others stay."""
    table = fresh_table("t")
    first = rec(spark, ("a", "x", 1.0, T1, "1"), ("b", "x", 2.0, T1, "2"), ("c", "x", 3.0, T1, "3"))
    upsert.upsert(first.withColumn("p", F.col("customer_code")), table, KEYS, as_of=T1, partition_by=["p"])
    files = {r.p: r.f for r in spark.table(table).select("p", F.input_file_name().alias("f")).collect()}
    moved = rec(spark, ("a", "x", 9.0, T1, "4")).withColumn("p", F.lit("b"))
    assert upsert.upsert(moved, table, KEYS, as_of=T1) == 1
    rows = {(r.customer_code, r.payment_amount, r.p) for r in spark.table(table).collect()}
    assert rows == {("a", 9.0, "b"), ("b", 2.0, "b"), ("c", 3.0, "c")}
    now = {r.p: r.f for r in spark.table(table).select("p", F.input_file_name().alias("f")).collect()}
    assert now["c"] == files["c"]  # not rewritten
    parts = {r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    assert parts == {"p=b", "p=c"}
    spark.sql(f"DROP TABLE {table}")


def keyed(spark, n, p="int(id % 4)"):
    """Rows with ``n`` keys, as frame for an upsert."""
    return spark.range(n).selectExpr(
        "cast(id AS string) AS customer_code", "'x' AS payment_due_label", "1.0D AS payment_amount",
        f"timestamp '{T1}' AS received_ts", "cast(id AS string) AS email_unique_id", f"{p} AS p",
    )


def files_of(df):
    return {r.f for r in df.select(F.input_file_name().alias("f")).distinct().collect()}


def test_rows_without_a_partition_survive(spark):
    """The batch lacks the partition column, so its new rows join those that have none."""
    table = fresh_table("t")
    first = rec(spark, *[(c, "x", 1.0, T1, c) for c in "abcd"])
    first = first.withColumn("p", F.when(F.col("customer_code") == "a", F.lit("1")))
    first = first.withColumn("q", F.when(F.col("customer_code") == "b", F.lit("")).otherwise("2"))
    upsert.upsert(first, table, KEYS, as_of=T1, partition_by=["p", "q"])
    assert upsert.upsert(rec(spark, ("e", "x", 5.0, T2, "5"), ("a", "x", 6.0, T2, "6")), table, KEYS, as_of=T1) == 2
    got = {r.customer_code: (r.payment_amount, r.p, r.q) for r in spark.table(table).collect()}
    assert got == {
        "a": (6.0, "1", "2"), "b": (1.0, None, None), "c": (1.0, None, "2"), "d": (1.0, None, "2"), "e": (5.0, None, None),
    }
    # all rows leave the partition without a value: it goes, and so do its rows
    moved = first.filter("customer_code in ('b', 'c', 'd')").withColumns({"p": F.lit("9"), "received_ts": F.lit(T3).cast("timestamp")})
    upsert.upsert(moved, table, KEYS, as_of=T1)
    places = Counter((r.p, r.q) for r in spark.table(table).collect())
    assert places == Counter([("1", "2"), (None, None), ("9", None), ("9", "2"), ("9", "2")])
    spark.sql(f"DROP TABLE {table}")


def test_only_touched_partitions_are_read(spark, plan):
    table = fresh_table("t")
    upsert.upsert(keyed(spark, 40), table, ["customer_code", "p"], as_of=T1, partition_by=["p"])
    before = {p: files_of(spark.table(table).filter(F.col("p") == p)) for p in range(4)}
    batch = keyed(spark, 40).filter("p = 2 AND customer_code < '2'").withColumn("payment_amount", F.lit(7.0))
    places = upsert.touched_places(spark.table(table), ["p"], [(["customer_code", "p"], batch)])
    assert places == [(2,)]
    text = plan(spark.table(table).where(upsert.among(["p"], places)))
    assert "PartitionFilters: [isnotnull(p" in text and "PartitionFilters: []" not in text
    # the keys say where a row is: no plan of the upsert reads another partition
    store = spark._jsparkSession.sharedState().statusStore()
    seen = store.executionsCount()
    upsert.upsert(batch, table, ["customer_code", "p"], as_of=T1)
    ran = store.executionsList(seen, 1000)
    scans = [ran.apply(i).physicalPlanDescription() for i in range(ran.length())]
    scans = [line for t in scans for line in t.splitlines() if "PartitionFilters" in line]
    assert scans and all("= 2)" in line or "(p" in line for line in scans)
    after = {p: files_of(spark.table(table).filter(F.col("p") == p)) for p in range(4)}
    assert [p for p in range(4) if before[p] != after[p]] == [2]
    assert spark.table(table).filter("payment_amount = 7").count() == batch.count()
    assert spark.table(table).count() == 40
    spark.sql(f"DROP TABLE {table}")


@pytest.mark.parametrize("options", [{}, {"partition_by": ["p"]}, {"buckets": 4}])
def test_what_others_keep_in_the_folder_survives(spark, tmp_path, options):
    table, home = fresh_table("t"), tmp_path / "home"
    for i in range(4):
        batch = keyed(spark, 12).withColumn("payment_amount", F.lit(float(i)))
        upsert.upsert(batch, table, KEYS, path=str(home), as_of=T1, **options)
        if i == 0:
            (home / "other").mkdir()
            (home / "other" / "note.txt").write_text("kept")
            (home / "part-of-another-job.txt").write_text("kept")
        assert Counter(r.payment_amount for r in spark.table(table).collect()) == Counter({float(i): 12})
    assert (home / "other" / "note.txt").read_text() == "kept"
    assert (home / "part-of-another-job.txt").exists()
    # the files of the version before are there for its readers, older ones are gone
    data = [p for p in home.rglob("part-*.parquet")]
    now = {f.removeprefix("file:").replace("///", "/") for f in spark.table(table).inputFiles()}
    assert now <= {str(p) for p in data}
    assert len(data) <= 2 * max(len(now), 4)
    spark.sql(f"DROP TABLE {table}")


def test_readers_keep_the_version_that_they_began_with(spark):
    table = fresh_table("t")
    upsert.upsert(keyed(spark, 20), table, KEYS, as_of=T1, buckets=4)
    before = spark.table(table)
    before.count()
    files = before.inputFiles()
    upsert.upsert(keyed(spark, 20).withColumn("payment_amount", F.lit(2.0)), table, KEYS, as_of=T1)
    assert spark.read.parquet(*files).agg(F.sum("payment_amount")).first()[0] == 20.0
    assert spark.table(table).agg(F.sum("payment_amount")).first()[0] == 40.0
    spark.sql(f"DROP TABLE {table}")


def test_a_batch_rewrites_its_buckets_only(spark):
    """One key in a hundred, in one bucket of a hundred: about one file in a hundred is new."""
    table = fresh_table("t")
    rows = keyed(spark, 20_000).withColumn("payment_due_label", (F.col("email_unique_id").cast("int") % 200).cast("string"))
    upsert.upsert(rows, table, KEYS, as_of=T1, buckets=100, bucket_by=["payment_due_label"])
    before = files_of(spark.table(table))
    batch = rows.filter("payment_due_label in ('7', '8')").withColumn("payment_amount", F.lit(3.0))
    assert upsert.upsert(batch, table, KEYS, as_of=T1) == 200
    after = files_of(spark.table(table))
    assert len(after - before) <= 2 and len(before - after) <= 2 and len(before) > 80
    got = spark.table(table).groupBy("payment_amount").count().collect()
    assert {r.payment_amount: r["count"] for r in got} == {1.0: 19_800, 3.0: 200}
    with pytest.raises(ValueError, match="lacks payment_due_label"):
        upsert.upsert(rows.drop("payment_due_label"), table, ["customer_code"], as_of=T1)
    spark.sql(f"DROP TABLE {table}")


def test_null_keys_are_spread_over_buckets(spark):
    table = fresh_table("t")
    rows = keyed(spark, 2_000).withColumn("customer_code", F.lit(None).cast("string"))
    upsert.upsert(rows, table, KEYS, as_of=T1, buckets=8)
    sizes = [r["count"] for r in spark.table(table).groupBy("_bucket").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 400
    spark.sql(f"DROP TABLE {table}")


def test_keys_that_leave_the_bucket_open(spark):
    """The key alone does not tell the bucket, so stored keys are searched; a row may move."""
    table = fresh_table("t")
    upsert.upsert(keyed(spark, 50), table, KEYS, as_of=T1, buckets=8, bucket_by=["customer_code", "payment_due_label"])
    moved = keyed(spark, 50).filter("customer_code < '3'").withColumn("payment_due_label", F.lit("y"))
    upsert.upsert(moved, table, "customer_code", as_of=T1)
    got = Counter(r.payment_due_label for r in spark.table(table).collect())
    assert got == Counter({"y": moved.count(), "x": 50 - moved.count()})
    spark.sql(f"DROP TABLE {table}")


def test_a_second_writer_is_refused(spark):
    table = fresh_table("t")
    upsert.upsert(keyed(spark, 5), table, KEYS, as_of=T1)
    late = versions.NewVersion(spark, table)
    upsert.upsert(keyed(spark, 6), table, KEYS, as_of=T1)
    late.replaces(spark.table(table))
    with pytest.raises(RuntimeError, match="another writer"):
        late.publish_table()
    assert spark.table(table).count() == 6
    spark.sql(f"DROP TABLE {table}")


def test_a_row_without_a_place_fails_the_write(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", None)], "k string, p int")
    with pytest.raises(Exception, match="partition that was not read"):
        versions.write_places(rows, str(tmp_path / "v"), "parquet", ["p"], [(1,)])


def test_replayed_batches_add_nothing(spark, sf, tmp_path):
    """The last micro-batch's commit is lost, once before and once after its state row."""
    names = [fresh_table(x) for x in ("s", "log", "state")]
    path, offsets = str(tmp_path / "in"), tmp_path / "offsets"
    fx.payloads(kv(spark, sf)).repartition(6).write.json(path)

    def run():
        flat = standardize(stream_messages(spark, path, max_files=2))
        stream.drain(stream.intake_stream(flat, kv_rules(), *names, str(offsets), as_of=T1, label_mode="normalized"))

    def rows():
        for t in names:
            spark.catalog.refreshTable(t)  # the stream has a session of its own
        return [Counter(map(tuple, spark.table(t).drop("_bucket").collect())) for t in names]

    run()
    done = rows()
    commits = {int(p.name): p for p in (offsets / "commits").glob("[0-9]*")}
    assert len(commits) >= 3
    last = max(commits)

    def lose_commit():
        commits[last].unlink()
        commits[last].with_name(f".{last}.crc").unlink(missing_ok=True)

    lose_commit()
    run()
    assert rows() == done
    lose_commit()
    name = spark.table(names[2]).first()["query"]
    spark.sql(f"ALTER TABLE {names[2]} DROP PARTITION (query = '{name}', batch = {last})")
    run()
    assert rows() == done
    for table in names:
        spark.sql(f"DROP TABLE {table}")


def test_bucketed_tables_are_refused(spark):
    table = fresh_table("t")
    batch = sinks.stamp(rec(spark, ("a", "x", 1.0, T1, "1")), as_of=T1)
    batch.write.bucketBy(2, "customer_code").saveAsTable(table)
    with pytest.raises(ValueError, match="bucketed"):
        upsert.upsert(rec(spark, ("a", "x", 2.0, T1, "2")), table, KEYS, as_of=T1)
    spark.sql(f"DROP TABLE {table}")


def test_merge_source_is_shuffled_once(spark, plan):
    target = rec(spark, ("a", "x", 1.0, T1, "1"))
    text = plan(upsert.merge_frames(target, target, KEYS))
    assert text.count("Exchange hashpartitioning") == 2


def test_latest_cuts_groups_before_the_shuffle(spark, sf, plan):
    text = plan(QUERIES["w_latest"](spark, sf))
    shuffle, partial = text.index("Exchange hashpartitioning"), text.rindex("WindowGroupLimit")
    assert partial > shuffle and "Partial" in text  # deeper in the tree: before the shuffle


# --- plan shapes --------------------------------------------------------------------------------


def test_routing_is_one_narrow_stage(spark, sf, plan):
    text = plan(QUERIES["f_route_first"](spark, sf))
    assert "Join" not in text and "hashpartitioning" not in text
    assert text.count("ArrowEvalPython") == 1
    # The subject filter sits below the parsing step.
    assert text.index("ArrowEvalPython") < text.rindex("RLIKE(")


@pytest.mark.parametrize("name", ["t_currency", "t_currency_jp", "t_json", "r_full", "k_audit", "a_profile"])
def test_no_python_outside_html_and_width(spark, sf, plan, name):
    text = plan(QUERIES[name](spark, sf))
    # the audit log joins the messages with the rows read from them
    assert text.count("EvalPython") == (2 if name == "k_audit" else 0)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins(spark, sf, plan, name):
    """Also in the jobs that a query runs while it is built: writes, upserts, streams."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    texts = [plan(QUERIES[name](spark, sf))]
    ran = store.executionsList(before, 1000)
    texts += [ran.apply(i).physicalPlanDescription() for i in range(ran.length())]
    for text in texts:
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_profile_reads_once(spark, sf, plan):
    assert plan(profile.profile(fx.table(spark, sf, "orders"))).count("FileScan") == 1


def test_filters_reach_the_scan(spark, sf, plan):
    guard = plan(QUERIES["f_guard"](spark, sf))
    assert "GreaterThanOrEqual(l_shipdate" in guard and "LessThan(l_shipdate" in guard
    assert "l_extendedprice" not in guard.split("ReadSchema")[1]


# --- reconciliation -----------------------------------------------------------------------------


def _pair(spark):
    source = spark.createDataFrame([("a", 10, 1), (None, 5, 0), ("NULL", 7, 0)], "g string, q int, z int")
    target = spark.createDataFrame([("a", 10, 0), (None, 4, 0), ("b", 3, 0)], "g string, q int, z int")
    return source, target


def test_wide_join_equals_unpivoted_join(spark):
    source, target = _pair(spark)
    direct = recon.recon_join(
        recon.unpivot_kpis(source, ["g"], ["q", "z"]), recon.unpivot_kpis(target, ["g"], ["q", "z"]), ["g"]
    )
    wide = recon.recon_wide(source, target, ["g"], ["q", "z"])
    assert Counter(direct.collect()) == Counter(wide.select(direct.columns).collect())
    assert wide.count() == 8  # a, NULL, 'NULL', b


def test_reconcile_statuses_and_padding(spark):
    source, target = _pair(spark)
    stamp = lambda t, c: spark.createDataFrame([(t,)], f"{c} string")
    out = recon.reconcile(
        source, target, stamp(T2, "s"), stamp(T1, "t"), ["g"], ["q", "z"], "src", "tgt", as_of=T1
    )
    assert len(out.columns) == 18
    rows = {(r.key_col1_value, r.kpis): r for r in out.collect()}
    assert rows["a", "q"].status == "WITHIN_THRESHOLD" and rows["a", "q"].diff_percentage == "0.00%"
    assert rows["b", "z"].status == "MATCH" and rows["b", "z"].diff_percentage == "0%"
    assert rows["a", "z"].status == "DISCREPANCY" and rows["a", "z"].diff_percentage is None
    assert rows[None, "q"].diff_percentage == "-25.00%"
    first = rows["a", "q"]
    assert (first.key_col1, first.key_col2, first.key_col2_value, first.target_up_to_date_flag) == ("g", "NA", None, "No")
    assert str(first.reconciliation_time) == "2026-01-01 09:00:00"


def test_reconcile_refuses_bad_inputs(spark):
    source, target = _pair(spark)
    fresh = spark.createDataFrame([(T1,)], "s string")
    cases = [
        dict(grain=["g", "q", "z", "w"], kpis=["q"]), dict(grain=["g"], kpis=["absent"]),
        dict(grain=["g"], kpis=[]), dict(grain=[], kpis=["q"]),
    ]
    for case in cases:
        with pytest.raises(ValueError):
            recon.reconcile(source, target, fresh, fresh, source_table="s", target_table="t", **case)
    with pytest.raises(ValueError, match="target_refresh"):
        recon.check_inputs(source, target, fresh, None, ["g"], ["q"])


# --- profiles and observability -----------------------------------------------------------------


def test_distinct_counts_within_tolerance(spark, sf):
    orders = fx.table(spark, sf, "orders")
    got = {r.column: r.distinct_count for r in profile.profile(orders).collect()}
    for column in orders.columns:
        exact = orders.select(column).distinct().count()
        assert abs(got[column] - exact) <= max(1, 3 * profile.DISTINCT_RSD * exact)


def test_profiles_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert [(r.total_rows, r.null_count, r.null_pct, r.distinct_count) for r in profile.profile(empty).collect()] == [
        (0, 0, None, 0), (0, 0, None, 0),
    ]
    assert [r.null_pct for r in profile.null_profile(empty).collect()] == [0.0, 0.0]
    assert profile.grain_check(empty, ["a"]).first().total_rows == 0


def test_dq_split_is_a_set_difference(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1), (2, 1)], "a int, b int")
    ok, bad = profile.dq_split(df, F.col("a").isNotNull())
    assert (ok.count(), bad.count()) == (2, 1)
    assert profile.dq_split(df, F.col("a").isNotNull(), keep_duplicates=True)[1].count() == 2
    assert Counter(bad.collect()) == Counter(df.subtract(ok).collect())


def test_last_run_and_producers_of_one(spark, sf):
    runs = fx.job_runs(fx.table(spark, sf, "events"))
    every = {r.job_id: r.run_id for r in observe.last_run(runs, fx.AS_OF_EVENTS).collect()}
    job = next(iter(every))
    assert observe.last_run(runs, fx.AS_OF_EVENTS, job_id=job).first().run_id == every[job]
    lineage = fx.lineage(fx.table(spark, sf, "lineitem"))
    one = observe.producers(lineage, runs, "s_1")
    assert {r.target_table_full_name for r in one.collect()} == {"s_1"}


def test_orders_for_display(spark):
    stale = spark.sql("SELECT * FROM VALUES (1, timestamp '2024-01-02'), (2, null), (3, timestamp '2024-01-01') t(job_id, last_executed_at)")
    assert [r.job_id for r in observe.stale_order(stale).collect()] == [2, 3, 1]
    lin = spark.sql("SELECT * FROM VALUES ('a', 'x', date '2024-01-01'), ('b', 'x', date '2024-01-03') t(source_table_full_name, target_table_full_name, event_time)")
    assert [r.source_table_full_name for r in observe.lineage_order(lin).collect()] == ["b", "a"]
    rows = spark.sql("SELECT * FROM VALUES ('a', 'k2'), ('b', 'k1'), ('b', 'k0') t(key_col1_value, kpis)")
    assert [(r.key_col1_value, r.kpis) for r in recon.presentation_order(rows).collect()] == [("b", "k0"), ("b", "k1"), ("a", "k2")]


def test_slices_and_unfinished_runs(spark):
    runs = spark.sql(
        "SELECT * FROM VALUES (1, 10, timestamp '2024-01-01 00:00', timestamp '2024-01-01 01:00', 'RUNNING', 5L),"
        " (1, 10, timestamp '2024-01-01 01:00', timestamp '2024-01-01 02:00', 'SUCCEEDED', 9L),"
        " (1, 11, timestamp '2024-01-02 00:00', null, null, null)"
        " t(job_id, run_id, period_start_time, period_end_time, result_state, execution_duration)"
    )
    lineage = spark.sql(
        "SELECT 'a' AS source_table_full_name, 'b' AS target_table_full_name, true AS direct_access,"
        " named_struct('job_info', named_struct('job_id', 1, 'job_run_id', 10)) AS entity_metadata"
    )
    (row,) = observe.producers(lineage, runs).collect()
    assert row.result_state == "SUCCEEDED"
    extremes = observe.run_extremes(runs).first()
    assert (extremes.fastest_run_id, extremes.fastest_duration, extremes.slowest_duration) == (10, 5, 9)


def test_amounts_that_do_not_fit(spark):
    from mailtally.operators.enrich import intake_summary, total_amount, unfit_amounts

    df = spark.sql("SELECT 'p' AS customer_name, a AS payment_amount FROM VALUES (1e17D), (1e40D), (2.5D), (null) t(a)")
    assert float(intake_summary(df).first().total_amount) == 1e17 + 2.5
    assert df.agg(total_amount(), unfit_amounts()).first()[1] == 1


def test_untimed_messages_are_kept_and_told(spark):
    from mailtally.operators import gates
    from mailtally.streaming.intake import untimed

    mails = spark.sql("SELECT 'a' AS id, 'c' AS conversation_id, 'bad' AS received_at, CAST(null AS timestamp) AS received_ts")
    stored = spark.sql("SELECT timestamp '2024-01-01' AS received_ts, 'z' AS email_unique_id")
    assert gates.after_watermark(mails, stored).count() == 1
    assert [(r.message_id, r.status) for r in untimed(mails).collect()] == [("a", "FAILED")]


def test_partial_days_of_times(spark):
    hours = spark.sql("SELECT timestamp '2024-01-01' + make_dt_interval(0, id) AS t FROM range(48)")
    got = recon.partial_days(hours, hours, "t").collect()
    assert [r.source_rows for r in sorted(got)] == [24, 24]
