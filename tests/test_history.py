"""Type-2 histories over hand-made batches."""

import datetime as dt
import random
import re
from dataclasses import replace

import pytest

from marlstone.operators import quality
from marlstone.operators.history import (
    CUSTOMER_SNAPSHOT,
    SILVER_CUSTOMERS,
    customer_dimension,
    first_load,
    merge_history,
)
from marlstone.plans.silver_job import merge_into, read_history
from marlstone.sources.scratch import written
from marlstone.sources.versions import last_commit, read_versions

COLUMNS = (
    "customer_id bigint, first_name string, email string, phone string, address string, city string, "
    "state string, zip_code string, income_bracket string, is_churned boolean, registration_date date"
)
T = [dt.datetime(2024, 1, day) for day in range(1, 5)]
END = dt.datetime(9999, 12, 31)


def person(key, name="n", city="c", phone="p", registered=dt.date(2023, 5, 6)):
    return (key, name, f"{key}@x", phone, "a", city, "s", "z", "low", False, registered)


def frame(spark, *people):
    return spark.createDataFrame(people, COLUMNS)


def versions(df):
    return sorted(
        (r.customer_id, r.first_name, r.city, r.effective_from, r.effective_to, r.is_current)
        for r in df.collect()
    )


REGISTERED = dt.datetime(2023, 5, 6)


def test_first_load_dates_versions_by_registration(spark):
    loaded = first_load(frame(spark, person(1), person(2, registered=None)), SILVER_CUSTOMERS, T[0])
    assert versions(loaded) == [
        (1, "n", "c", REGISTERED, END, True),
        (2, "n", "c", T[0], END, True),
    ]


def test_silver_merge(spark):
    start = first_load(
        frame(spark, person(1), person(2), person(3), person(4)), SILVER_CUSTOMERS, T[0]
    )
    # 1 moves, 2 changes an untracked column only, 3 is unchanged, 4 vanishes, 5 is new.
    second = frame(spark, person(1, city="d"), person(2, name="m"), person(3), person(5, registered=None))
    merged = merge_history(start, second, SILVER_CUSTOMERS, T[1])
    expected = [
        (1, "n", "c", REGISTERED, T[1], False),
        (1, "n", "d", T[1], END, True),
        (2, "n", "c", REGISTERED, END, True),
        (3, "n", "c", REGISTERED, END, True),
        (4, "n", "c", REGISTERED, END, True),
        (5, "n", "c", T[1], END, True),
    ]
    assert versions(merged) == expected
    # The same batch again finds nothing to do.
    assert versions(merge_history(merged, second, SILVER_CUSTOMERS, T[2])) == expected


def test_null_to_value_is_a_change(spark):
    start = first_load(frame(spark, person(1, phone=None)), SILVER_CUSTOMERS, T[0])
    merged = merge_history(start, frame(spark, person(1, phone="7")), SILVER_CUSTOMERS, T[1])
    assert [r[5] for r in versions(merged)] == [False, True]


def test_snapshot_closes_vanished_and_reopens_returning_keys(spark):
    rules = CUSTOMER_SNAPSHOT
    dimension = first_load(frame(spark, person(1), person(2)), rules, T[0])
    dimension = merge_history(dimension, frame(spark, person(2)), rules, T[1])
    dimension = merge_history(dimension, frame(spark, person(1), person(2, city="d")), rules, T[2])
    got = sorted(
        (r.customer_id, r.city, r.dbt_valid_from, r.dbt_valid_to, r.dbt_updated_at)
        for r in dimension.fillna({"city": "-"}).collect()
        if r.dbt_valid_to
    )
    assert got == [(1, "c", T[0], T[1], T[0]), (2, "c", T[0], T[2], T[0])]
    current = sorted((r.customer_id, r.city, r.dbt_valid_from) for r in dimension.collect() if not r.dbt_valid_to)
    assert current == [(1, "c", T[2]), (2, "d", T[2])]


def test_columns_may_come_and_go(spark):
    start = first_load(frame(spark, person(1), person(2)), SILVER_CUSTOMERS, T[0])
    wider = frame(spark, person(1, city="d"), person(3)).selectExpr("*", "'gold' AS loyalty")
    merged = merge_history(start, wider, SILVER_CUSTOMERS, T[1])
    assert {(r.customer_id, r.is_current): r.loyalty for r in merged.collect()} == {
        (1, False): None,
        (1, True): "gold",
        (2, True): None,
        (3, True): "gold",
    }
    narrow = frame(spark, person(1, city="e"))
    again = merge_history(merged, narrow, SILVER_CUSTOMERS, T[2])
    assert {r.city: r.loyalty for r in again.filter("customer_id = 1").collect()} == {
        "c": None,
        "d": "gold",
        "e": None,
    }


@pytest.mark.parametrize("rules", [SILVER_CUSTOMERS, CUSTOMER_SNAPSHOT], ids=["silver", "snapshot"])
def test_stored_history_equals_merged_history(spark, tmp_path, rules):
    batches = [
        frame(spark, person(1), person(2), person(3)),
        frame(spark, person(1, city="d"), person(3)),
        frame(spark, person(1, city="d"), person(2), person(3, city="x"), person(4)),
    ]
    base = str(tmp_path / "customers")
    in_memory = first_load(batches[0], rules, T[0])
    for i, rows in enumerate(batches):
        merge_into(rows, base, rules, f"b{i}", T[i])
        if i:
            in_memory = merge_history(in_memory, rows, rules, T[i])
    stored = read_history(spark, base, rules)
    names = sorted(in_memory.columns)
    assert sorted(map(str, stored.select(*names).collect())) == sorted(map(str, in_memory.select(*names).collect()))
    # Replaying a committed batch changes nothing.
    before = last_commit(spark, base)
    assert merge_into(batches[1], base, rules, "b1", T[3]) == before


def test_unfinished_version_is_ignored_and_replaced(spark, tmp_path):
    base = str(tmp_path / "customers")
    merge_into(frame(spark, person(1)), base, SILVER_CUSTOMERS, "b0", T[0])
    # A run that died after writing files, before its commit record.
    lost = first_load(frame(spark, person(99)), SILVER_CUSTOMERS, T[1])
    lost.write.partitionBy("is_current").parquet(f"{base}/v=2")
    commit = last_commit(spark, base)
    assert [r.customer_id for r in read_versions(spark, base, commit).collect()] == [1]
    merge_into(frame(spark, person(1, city="d")), base, SILVER_CUSTOMERS, "b1", T[1])
    assert versions(read_history(spark, base, SILVER_CUSTOMERS)) == [
        (1, "n", "c", REGISTERED, T[1], False),
        (1, "n", "d", T[1], END, True),
    ]


def test_current_rows_are_read_from_their_partition_only(spark, tmp_path):
    base = str(tmp_path / "customers")
    for i, city in enumerate("abc"):
        merge_into(frame(spark, person(1, city=city)), base, SILVER_CUSTOMERS, f"b{i}", T[i])
    current = read_versions(spark, base, last_commit(spark, base), "current")
    assert [r.city for r in current.collect()] == ["c"]
    plan = current._jdf.queryExecution().executedPlan().toString()
    pruned_by = re.search(r"PartitionFilters: \[(.*?)\], Pushed", plan).group(1)
    assert "is_current" in pruned_by and "v#" in pruned_by


def test_one_current_check_finds_none_and_many(spark):
    rows = spark.createDataFrame(
        [(1, True), (1, False), (2, False), (3, True), (3, True)], "customer_id bigint, is_current boolean"
    )
    got = {r.customer_id: r.current_count for r in quality.not_one_current(rows).collect()}
    assert got == {2: 0, 3: 2}


def test_surrogate_keys_differ_per_version(spark):
    start = first_load(frame(spark, person(1), person(2)), CUSTOMER_SNAPSHOT, T[0])
    merged = merge_history(start, frame(spark, person(1, city="d"), person(2)), CUSTOMER_SNAPSHOT, T[1])
    wide = merged.selectExpr(
        "*", "'l' AS last_name", "'US' AS country", "'m' AS gender", "date'1990-01-01' AS birth_date",
        "CAST(NULL AS date) AS churn_date",
    )
    dimension = customer_dimension(wide)
    assert dimension.select("customer_key").distinct().count() == 3
    assert dimension.filter("is_current").count() == 2


def simulate(batches, closes_absent):
    """Versions as (key, city, opened by, closed by), by walking through the batches."""
    done, current = [], {}
    for n, batch in enumerate(batches):
        for key in list(current):
            city, opened = current[key]
            if (key not in batch and closes_absent) or (key in batch and batch[key] != city):
                done.append((key, city, opened, n))
                del current[key]
        for key, city in batch.items():
            current.setdefault(key, (city, n))
    return sorted(done + [(k, c, o, None) for k, (c, o) in current.items()], key=str)


@pytest.mark.parametrize("closes_absent", [False, True])
def test_random_batches_by_brute_force(spark, closes_absent):
    chance = random.Random(7)
    batches = [
        {k: chance.choice("ab") for k in range(300) if chance.random() < 0.7} for _ in range(len(T))
    ]
    rules = replace(CUSTOMER_SNAPSHOT, closes_absent=closes_absent)
    frames = [frame(spark, *[person(k, city=c) for k, c in batch.items()]) for batch in batches]
    dimension = first_load(frames[0], rules, T[0])
    for rows, at in zip(frames[1:], T[1:]):
        dimension = merge_history(written(dimension, "history"), rows, rules, at)
    number = {at: n for n, at in enumerate(T)} | {None: None}
    got = [(r.customer_id, r.city, number[r.dbt_valid_from], number[r.dbt_valid_to]) for r in dimension.collect()]
    assert sorted(got, key=str) == simulate(batches, closes_absent)
