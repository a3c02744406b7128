import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ticketmill.operators import merge
from ticketmill.operators.merge import (
    absent_rows,
    first_per_key,
    insert_counts,
    insert_if_absent,
    last_per_key,
    replace_by_key,
    replace_counts,
    split_required,
)
from ticketmill.sources import sinks

SCHEMA = "id string, campus string, status string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def batch(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", _seq int")


def insert(existing, incoming):
    return insert_if_absent(existing, incoming, "id", "_seq", ["campus", "status"])


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stored_row_wins_and_first_of_the_batch_counts(spark):
    old = frame(spark, [("1", "K", "old")])
    new = batch(spark, [("1", "K", "changed"), ("2", "M", "first"), ("2", "M", "second")])
    assert bag(insert(old, new)) == [("1", "K", "old"), ("2", "M", "first")]


def test_incomplete_rows_are_skipped_before_the_first_is_chosen(spark):
    new = batch(spark, [("1", None, "a"), ("1", "K", None), ("1", "K", "complete")])
    assert bag(insert(frame(spark, []), new)) == [("1", "K", "complete")]
    kept, rejected = split_required(new, ["campus", "status"])
    assert (kept.count(), rejected.count()) == (1, 2)


def test_null_keys_never_match(spark):
    old = frame(spark, [(None, "K", "old")])
    new = batch(spark, [(None, "K", "a"), (None, "K", "a"), ("1", "K", "b")])
    assert bag(insert(old, new)) == bag(frame(spark, [
        (None, "K", "old"), (None, "K", "a"), (None, "K", "a"), ("1", "K", "b")]))


def test_keys_are_not_trimmed(spark):
    assert insert(frame(spark, [("1", "K", "a")]), batch(spark, [("1 ", "K", "a")])).count() == 2


def test_insert_is_idempotent_but_for_null_keys(spark):
    old = frame(spark, [("1", "K", "old")])
    keyed = batch(spark, [("1", "K", "x"), ("2", "K", "x"), ("2", "K", "y")])
    once = insert(old, keyed)
    assert bag(insert(once, keyed)) == bag(once)
    unkeyed = batch(spark, [(None, "K", "x")])
    assert insert(insert(old, unkeyed), unkeyed).count() == 3


def test_insert_counts(spark):
    old = frame(spark, [("1", "K", "old"), ("9", "K", "old")])
    new = batch(spark, [("1", "K", "x"), ("2", "K", "x"), ("2", "K", "y"), ("3", None, "z"),
                        (None, "K", "n")])
    counts = insert_counts(old, new, "id", "_seq", ["campus", "status"]).first().asDict()
    assert counts == {"rows_before": 2, "batch_rows": 5, "rejected_rows": 1, "inserted_rows": 2,
                      "rows_after": 4}


def test_one_id_with_a_third_of_the_rows(spark):
    rows = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("K").alias("campus"), F.col("id").cast("string").alias("status"),
        F.col("id").alias("_seq"))
    added = absent_rows(frame(spark, []), rows, "id", "_seq")
    assert added.count() == 20_001
    assert added.filter("id = 'hot'").first().status == "0"
    assert last_per_key(rows, ["id"], "_seq").filter("id = 'hot'").first().status == "29997"
    plan = first_per_key(rows, ["id"], "_seq")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle


def weather(spark, rows):
    return spark.createDataFrame(rows, "date date, campus string, high double")


def readings(spark, rows):
    return spark.createDataFrame(
        [(*r, i) for i, r in enumerate(rows)], "date date, campus string, high double, _seq int")


KEY = ("date", "campus")


def test_batch_wins_and_its_last_row_counts(spark, days):
    d1, d2, d3 = days
    old = weather(spark, [(d1, "K", 1.0), (d2, "K", 2.0)])
    new = readings(spark, [(d2, "K", 20.0), (d2, "K", None), (d3, "K", 3.0)])
    merged = replace_by_key(old, new, KEY, "_seq")
    assert bag(merged) == bag(weather(spark, [(d1, "K", 1.0), (d2, "K", None), (d3, "K", 3.0)]))
    assert bag(replace_by_key(merged, new, KEY, "_seq")) == bag(merged)
    assert replace_counts(old, new, KEY).first().asDict() == {
        "rows_before": 2, "replaced_rows": 1, "inserted_rows": 1, "rows_after": 3}


@pytest.mark.parametrize("key", KEY)
def test_null_in_a_key_aborts(spark, days, key):
    new = readings(spark, [(days[0], "K", 1.0)]).withColumn(
        key, F.lit(None).cast(dict(date="date", campus="string")[key]))
    with pytest.raises(Exception, match=f"NULL in key column {key}"):
        replace_by_key(weather(spark, []), new, KEY, "_seq").collect()


@pytest.fixture
def days():
    from tests.conftest import day

    return [day(f"2025-09-1{i}") for i in range(3)]


def random_row(rng, keys):
    return rng.choice(keys), rng.choice("KM" * 4 + "-").replace("-", "") or None, rng.choice("xyz")


@pytest.mark.parametrize("seed", range(3))
def test_insert_against_a_dictionary(spark, seed):
    rng = random.Random(seed)
    keys = [*map(str, range(12)), None]
    old = [(k, "K", "old") for k in rng.sample(keys, 5)]
    new = [random_row(rng, keys) for _ in range(60)]

    table, unkeyed = {k: r for r in old if (k := r[0])}, [r for r in old if r[0] is None]
    for row in new:
        if row[1] is None:
            continue
        if row[0] is None:
            unkeyed.append(row)
        else:
            table.setdefault(row[0], row)
    assert bag(insert(frame(spark, old), batch(spark, new))) == sorted(
        [*table.values(), *unkeyed], key=str
    )


@pytest.mark.parametrize("seed", range(3))
def test_replace_against_a_dictionary(spark, days, seed):
    rng = random.Random(seed)
    pool = [(d, c) for d in days for c in "KM"]
    old = [(*k, 0.0) for k in rng.sample(pool, 3)]
    new = [(*rng.choice(pool), rng.random()) for _ in range(8)]
    table = {r[:2]: r for r in [*old, *new]}
    merged = replace_by_key(weather(spark, old), readings(spark, new), KEY, "_seq")
    assert bag(merged) == sorted(table.values(), key=str)


def test_large_batch_is_shuffled_once_and_gives_the_same_rows(spark):
    stored = spark.createDataFrame([(str(i), "old") for i in range(50)], "k string, v string")
    rows = [(str(i % 80), f"v{i}", i) for i in range(200)] + [(None, "n", 1), (None, "n", 2)]
    batch = spark.createDataFrame(rows, "k string, v string, s int")
    small = absent_rows(stored, batch, "k", "s")
    large = absent_rows(stored, batch, "k", "s", large_batch=True)
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, large.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        again = absent_rows(stored, batch, "k", "s", large_batch=True)
        plan = again._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # the batch and the stored keys


def scanned(df):
    """(rows that the scan of the plan gave, result)."""
    plan = df._jdf.queryExecution().executedPlan()
    n = len(plan.executeCollect())
    return plan.collectLeaves().head().metrics().get("numOutputRows").get().value(), n


def test_a_few_keys_are_looked_up_without_reading_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "LOOKUP_ROW_GROUP", 1 << 16)
    path, n = str(tmp_path / "t"), 200_000
    rows = spark.range(n, numPartitions=4).select(
        F.sha2(F.col("id").cast("string"), 256).alias("k"), (F.col("id") % 2).cast("int").alias("month")
    )
    sinks.write_zone(rows, path, ["month"], rebalance=True, lookup_key="k")
    stored = spark.read.parquet(path)
    keys = rows.filter("month = 1").limit(20).unionByName(
        spark.createDataFrame([(f"{i:064x}", 0) for i in range(20)] + [(None, 0)], "k string, month int"))
    found = merge.with_keys(stored, keys, "k", 40)
    read, kept = scanned(found)
    assert kept == 20 and read < n / 5
    assert scanned(stored)[0] == n
    none = keys.filter("k IS NULL")
    assert scanned(merge.with_keys(stored, none, "k", 0))[1] == 0
    assert merge.with_keys(stored, keys, "k", merge.LOOKED_UP + 1) is stored


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("looked_up", [0, 1000])
def test_staged_batch_inserts_what_absent_rows_does(spark, monkeypatch, seed, looked_up):
    monkeypatch.setattr(merge, "LOOKED_UP", looked_up)
    rng = random.Random(seed)
    keys = [*map(str, range(12)), None]
    old = frame(spark, [(k, "K", "old") for k in rng.sample(keys, 5)])
    new = batch(spark, [random_row(rng, keys) for _ in range(60)])
    required = [c for c in old.columns[1:2]]
    staged = merge.staged_batch(new, old.columns[0], "_seq", required)
    counted = staged.agg(F.sum("copies")).first()[0]
    complete = staged.filter("complete")
    ids = complete.filter(F.col(old.columns[0]).isNotNull()).count()
    for large in (False, True):
        found = merge.unstored(old, complete, old.columns[0], ids, large)
        wanted = absent_rows(old, new, old.columns[0], "_seq", required)
        assert bag(found) == bag(wanted)
    assert counted == 60
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
