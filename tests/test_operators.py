"""Joins, aggregates and helpers, also against brute force and on skewed input."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark import scale
from tidemark.functions.keys import hash_key
from tidemark.operators import aggregates as agg
from tidemark.operators import filters as flt
from tidemark.operators import joins, lines, paging, sets
from tidemark.plans import vault
from tidemark.schemas import PRICE, VAULT
from tidemark.sinks import quarantine, write

DAY = dt.datetime(2024, 1, 1)


def test_scratch_goes_with_its_scope(spark, tmp_path):
    with scale.scratch_scope(spark):
        numbered = scale.with_ordinal(spark.range(100), ["id"])
        numbered.write.parquet(str(tmp_path / "out"))
        files = numbered.inputFiles()
        assert files and all(os.path.exists(f.removeprefix("file://")) for f in files)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100


@pytest.mark.parametrize("partitions", [1, 7])
def test_ordinal(spark, partitions):
    values = list(range(2000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = scale.with_ordinal(df, ["v"], start=5)
        assert got.rdd.getNumPartitions() > 1
        assert {(r["v"], r["ordinal"]) for r in got.collect()} == {(v, v + 5) for v in values}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert scale.with_ordinal(df.limit(0), ["v"]).count() == 0


def test_packed_order(spark):
    df = spark.createDataFrame([(2, 1), (1, 9_000_000_000_000_000_000), (1, 0)], "a bigint, b bigint")
    got = df.orderBy(scale.packed_order(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(1, 0), (1, 9_000_000_000_000_000_000), (2, 1)]


def _asof_brute(left, right):
    expected = {}
    for i, key, ts in left:
        rows = [(t, v) for k, t, v in right if k == key and t <= ts]
        expected[i] = max(rows)[1] if rows else None
    return expected


@pytest.fixture()
def many_ranges(spark):
    """Small ranges stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed", [1, 2])
def test_asof_against_brute_force(spark, many_ranges, seed):
    rng = random.Random(seed)

    def time():
        return DAY + dt.timedelta(minutes=rng.randrange(60 * 24 * 40))

    # Two thirds of the left rows have one key, and a third one time.
    left = [(i, rng.choice(["hot", "hot", "b", "none"]), DAY + dt.timedelta(days=9) if i % 3 else time()) for i in range(300)]
    right = [(rng.choice(["hot", "b"]), time(), rng.randrange(1000)) for _ in range(120)]
    right += [("hot", DAY + dt.timedelta(days=9), 5), ("hot", DAY + dt.timedelta(days=9), 7)]
    l_df = spark.createDataFrame(left, "i int, k string, ts timestamp_ntz")
    r_df = spark.createDataFrame(right, "k string, rts timestamp_ntz, v int")
    got = joins.asof_join(l_df, r_df, "k", "ts", "rts", ["v"])
    assert {r["i"]: r["v"] for r in got.collect()} == _asof_brute(left, right)
    matched = joins.asof_join(l_df, r_df, "k", "ts", "rts", ["v"], how="inner")
    assert matched.count() == sum(v is not None for v in _asof_brute(left, right).values())


def test_asof_reads_the_left_side_once_and_splits_a_hot_key(spark, many_ranges, tmp_path):
    keys = F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(99).alias("k")
    times = (F.lit(DAY).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") % 50).cast("int"))).alias("ts")
    spark.range(20_000).select("id", keys, times).write.parquet(str(tmp_path / "left"))
    left = spark.read.parquet(str(tmp_path / "left"))
    right = left.where("id % 100 = 7").select("k", F.col("ts").alias("rts"), F.col("id").alias("v"))
    ranges = []
    kept = joins.cut_lineage
    joins.cut_lineage = lambda df, name: ranges.append(df) or kept(df, name)
    try:
        joined = joins.asof_join(left, right, "k", "ts", "rts", ["v"])
    finally:
        joins.cut_lineage = kept
    assert joined.count() == 20_000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert str(tmp_path) not in plan and "SortAggregate" not in plan
    # Once as the left side, once as the source of the right one.
    assert ranges[0]._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    sizes = [r["count"] for r in ranges[0].where("_asks").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 20_000 / 4


def test_role_join(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 9)], "a int, b int")
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string")
    got = joins.join_role(pairs, dim, "id", {"a": "a_", "b": "b_"}, "left").collect()
    assert {(r["a"], r["a_name"], r["b_name"]) for r in got} == {(1, "x", "y"), (2, "y", None)}


def test_only_new_with_filter_and_nulls(spark):
    new = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    old = spark.createDataFrame([("a", None), ("b", 1), (None, None)], "k string, closed int")
    got = joins.only_new(new, old, "k", F.col("closed").isNull()).collect()
    # A NULL key in the old rows does not hide everything.
    assert {r["k"] for r in got} == {"b", None}


def test_prune_empty(spark):
    leaves = spark.createDataFrame([("b1",), ("b1",)], "parent string")
    blocks = spark.createDataFrame([("b1", "d1"), ("b2", "d2")], "key string, up string")
    districts = spark.createDataFrame([("d1", "r"), ("d2", "r")], "key string, up string")
    region = spark.createDataFrame([("r",)], "key string")
    kept = joins.prune_empty([(blocks, "up"), (districts, "up"), (region, None)], leaves, "key")
    assert [[r["key"] for r in rows.collect()] for rows in kept] == [["b1"], ["d1"], ["r"]]


def test_first_per_key_is_stable(spark):
    rows = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, None)]
    expected = {("a", 1, "y"), ("b", 5, None)}
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, o int, v string")
        assert {tuple(r) for r in agg.first_per_key(df, ["k"], ["o", "v"]).collect()} == expected


def test_extreme_times(spark):
    rows = [("s", DAY, 5), ("s", DAY + dt.timedelta(hours=1), 9), ("s", DAY + dt.timedelta(hours=2), 9), ("s", DAY + dt.timedelta(hours=3), 5)]
    df = spark.createDataFrame(rows, "s string, time timestamp_ntz, volume bigint")
    got = df.groupBy("s").agg(agg.earliest_at_max("time", "volume"), agg.earliest_at_min("time", "volume")).first()
    assert got[1] == DAY + dt.timedelta(hours=1) and got[2] == DAY
    assert agg.arg_max(df, ["s"], "volume", "volume").first()["arg_max"] == 9
    plan = df.groupBy("s").agg(agg.earliest_at_max("time", "volume"))._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan


def test_ratio_and_change(spark):
    row = spark.createDataFrame([(1, 4, 0)], "a int, b int, z int").select(
        agg.ratio("a", "b"), agg.ratio("a", "z"), agg.pct_change("b", "a"), agg.pct_change("z", "a")
    ).first()
    assert row[0] == 0.25 and row[1] is None and float(row[2]) == -75 and row[3] is None


def test_non_empty_columns(spark):
    df = spark.createDataFrame([("a", "", None, 1), ("a", "x", None, 2), ("b", "", "", None)], "c string, p string, q string, r int")
    got = {r["c"]: (r["p"], r["q"], r["r"]) for r in agg.non_empty_columns(df, "c").collect()}
    assert got == {"a": (True, False, True), "b": (False, False, False)}


def test_three_valued_filter(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "u boolean")
    assert [r["u"] for r in df.filter(flt.is_not_true("u")).collect()] == [False, None]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_day_slice_bounds(spark, kind):
    rows = ["2023-12-31 23:59:59", "2024-01-01 00:00:00", "2024-01-01 23:59:59.999", "2024-01-02 00:00:00"]
    df = spark.createDataFrame([(r,) for r in rows], "t string").select(F.col("t").cast("timestamp").cast(kind).alias("t"))
    assert flt.day_slice(df, "t", "2024-01-01").count() == 2


def test_day_slice_reaches_the_scan(spark, tmp_path):
    spark.range(3).select(F.lit(DAY).cast("timestamp").alias("t")).write.parquet(str(tmp_path / "t"))
    plan = flt.day_slice(spark.read.parquet(str(tmp_path / "t")), "t", "2024-01-01")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(t" in plan and "LessThan(t" in plan


def test_block_pages(spark):
    rows = [("/a", "ok"), ("/blocked", "ok"), ("/a", None), ("/a", 'x "error": 1'), ("/search?q", "ok"), (None, "ok")]
    df = spark.createDataFrame(rows, "url string, html string")
    assert [r["url"] for r in flt.not_blocked(df).collect()] == ["/a"]


def test_align_schema(spark):
    df = spark.createDataFrame([("1.5", "x", "7")], "open string, other string, volume string")
    got = flt.align_schema(df, PRICE)
    assert got.columns == ["open", "volume"] and got.schema["volume"].dataType.typeName() == "long"


def test_paging_covers_everything(spark):
    df = spark.range(1, 26)
    pages = [paging.keyset_page(df, "id", last, 10).count() for last in (0, 10, 20, 30)]
    assert pages == [10, 10, 5, 0]
    assert df.select(paging.page_of("id", 10).alias("p")).distinct().count() == 3
    assert paging.exists(df, F.col("id") == 25) and not paging.exists(df, F.col("id") == 26)


def test_line_rewrites(spark):
    rows = [("a.mif", 1, "Delimiter ;"), ("a.mif", 2, " CoordSys Earth"), ("a.mif", 3, "x")]
    df = spark.createDataFrame(rows, "f string, n int, line string")
    got = df.withColumn("line", lines.map_coordinates(lines.map_delimiter(F.col("line")))).orderBy("n").collect()
    assert [r["line"] for r in got] == ['Delimiter ","', "CoordSys Earth", "x"]
    mid = spark.createDataFrame([("b", 1, "7,a"), ("a", 1, "7,b"), ("a", 2, "none")], "f string, n int, line string")
    got = lines.renumber_leading(mid, ["f", "n"]).orderBy("f", "n").collect()
    assert [r["line"] for r in got] == ["1,b", "none", "3,a"]


def test_unions(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "q")], "x int, y string")
    assert {tuple(r) for r in sets.union_padded(a, b).collect()} == {(1, None), (2, "q")}
    roles = spark.createDataFrame([(1, 2), (2, None)], "f int, t int")
    assert {r[0] for r in sets.union_roles(roles, ["f", "t"], "n").collect()} == {1, 2}


# --- sinks ------------------------------------------------------------------------------


def test_rejects(spark):
    from tidemark.schemas import struct_of

    df = spark.createDataFrame([("1", "2024-01-01", "k1"), ("x", None, "k2"), (None, "2024-02-30", "k3")], "n string, d string, k string")
    schema = struct_of("n bigint, d date")
    good, bad = quarantine.copy_with_rejects(df, schema)
    assert [tuple(r) for r in good.collect()] == [("k1", 1, dt.date(2024, 1, 1))]
    assert {(r["k"], r["n"], r["reject_reason"]) for r in bad.collect()} == {
        ("k2", "x", "n: not a bigint; d: missing"), ("k3", None, "n: missing; d: not a date")
    }
    good, bad = quarantine.copy_with_rejects(df, schema, required=["n"])
    assert good.count() == 1 and bad.count() == 2


def test_quarantine_takes_out_the_unit(spark):
    df = spark.createDataFrame([("f1", 1), ("f1", -1), ("f1", -2), ("f2", 3)], "file string, n int")
    problem = F.when(F.col("n") < 0, F.concat(F.lit("bad "), F.col("n").cast("string")))
    good, log = quarantine.quarantine(df, problem, "t", "s", F.lit("2024-01-01").cast("timestamp"), file_name=F.col("file"), unit=["file"])
    assert [tuple(r) for r in good.collect()] == [("f2", 3)]
    assert [(r["file_name"], r["description"]) for r in log.collect()] == [("f1", "bad -1")]


def test_append_partition_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    day1 = spark.createDataFrame([(1, DAY)], "i int, ts timestamp")
    both = spark.createDataFrame([(2, DAY), (3, DAY + dt.timedelta(days=1))], "i int, ts timestamp")
    for rows in (day1, both, both):
        write.append_partition(rows, path, "ts")
    assert {r["i"] for r in spark.read.parquet(path).collect()} == {2, 3}


def test_insert_ignore_and_state(spark):
    target = spark.createDataFrame([(1, "a", "old")], "k int, d string, v string")
    new = spark.createDataFrame([(1, "a", "new"), (1, "b", "y"), (1, "b", "x")], "k int, d string, v string")
    assert [tuple(r) for r in write.insert_ignore(target, new, ["k", "d"], ["v"]).collect()] == [(1, "b", "x")]
    state = spark.createDataFrame([("a", "{1}", 1), ("b", "{1}", 5)], "key string, js string, ver int")
    change = spark.createDataFrame([("a", "{2}", 1), ("b", "{0}", 4), ("c", "{3}", 1)], "key string, js string, ver int")
    got = {r["key"]: r["js"] for r in write.upsert_state(state, change, "key", "ver").collect()}
    assert got == {"a": "{2}", "b": "{1}", "c": "{3}"}


def test_replace_table_that_feeds_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = spark.range(1).schema
    assert write.read_or_empty(spark, path, schema).count() == 0
    spark.range(3).write.parquet(path)
    write.replace_table(spark.read.parquet(path).filter("id > 0"), path)
    assert write.read_or_empty(spark, path, schema).count() == 2


def test_export_by_category(spark, tmp_path):
    rows = [("a", 1, None, None), ("a", None, 'say "x", y', None), ("b", None, "x\ny", ""), (None, 2, None, None)]
    df = spark.createDataFrame(rows, "`Вид` string, n int, t string, none string")
    write.export_by_category(df, "Вид", str(tmp_path / "out"))

    def read(category):
        got = spark.read.csv(str(tmp_path / "out" / f"_category={category}"), header=True, multiLine=True, escape='"')
        return [c for c in got.columns if c != "_file"], sorted((tuple(r)[:-1] for r in got.collect()), key=str)

    assert read("a") == (["Вид", "n", "t"], [("a", "1", None), ("a", None, 'say "x", y')])
    assert read("b") == (["Вид", "t"], [("b", "x\ny")])
    assert read("__HIVE_DEFAULT_PARTITION__") == (["Вид", "n"], [(None, "2")])


def test_export_of_a_large_category_in_several_files(spark, tmp_path):
    df = spark.range(1000).select(F.lit("a").alias("c"), F.col("id"))
    write.export_by_category(df, "c", str(tmp_path / "out"), rows_per_file=100)
    files = [f.read_text().splitlines() for f in (tmp_path / "out").rglob("part-*.txt")]
    assert len(files) == 10 and all(f[0] == "c,id" for f in files)
    assert sorted(int(line.split(",")[1]) for f in files for line in f[1:]) == list(range(1000))


def test_load_does_not_shuffle_the_bucketed_hub(spark, tmp_path):
    path, schema = str(tmp_path / "hub"), VAULT["h_accounts"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hub = write.read_bucketed(spark, path, schema, ["account_number"])
        for low, high in ((0, 50), (40, 60), (0, 60)):
            day = spark.range(low, high).select(F.col("id").alias("account_number"))
            fresh = vault.load_hub(hub, day, "account_number", F.current_timestamp(), "test")
            fresh.count()
            below = fresh._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[-1]
            assert "Bucketed: true" in below and below.count("Exchange hashpartitioning") == 1
            hub = write.append_bucketed(fresh, path, schema, ["account_number"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    assert hub.count() == hub.select("account_number").distinct().count() == hub.select("hk").distinct().count() == 60
    # Another session only knows the path, and other settings.
    other = spark.newSession()
    spark.sql(f"DROP TABLE {write._bucketed_name(path)}")
    other.conf.set("spark.sql.shuffle.partitions", "3")
    assert write.read_bucketed(other, path, schema, ["account_number"]).count() == 60


def test_hash_keys_of_128_bits(spark):
    rows = spark.range(20_000).select(hash_key("id").alias("k"))
    assert rows.distinct().count() == 20_000 and len(rows.first()["k"]) == 16
    halves = rows.select(F.substring("k", 1, 8).alias("a"), F.substring("k", 9, 8).alias("b"))
    assert halves.where("a = b").count() == 0
    # Where the first halves collide, as when both see no text, the second still tells inputs apart.
    some = spark.createDataFrame([("x", None), (None, "x"), (None, None)], "a string, b string").select(hash_key("a", "b").alias("k"))
    assert some.distinct().count() == 3 and some.select(F.substring("k", 1, 8)).distinct().count() == 2


def test_arg_max_of_any_type(spark):
    rows = [("a", dt.datetime(2024, 1, 2), 5), ("a", dt.datetime(2024, 1, 1), 5), ("a", dt.datetime(2024, 1, 3), 4), ("b", None, None)]
    df = spark.createDataFrame(rows, "s string, time timestamp, volume int")
    got = {r["s"]: r["arg_max"] for r in agg.arg_max(df, ["s"], "time", "volume").collect()}
    assert got == {"a": dt.datetime(2024, 1, 1)}
