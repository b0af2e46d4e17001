"""Histories whose batches come in any order."""

import datetime as dt
import random
from dataclasses import replace

import pytest

from marlstone.operators.history import CUSTOMER_SNAPSHOT, SILVER_CUSTOMERS, first_load, merge_history
from marlstone.operators.splicing import OBSERVED, observed_load, splice_batch
from marlstone.plans.silver_job import merge_into, read_history
from marlstone.sources.scratch import written
from marlstone.sources.versions import last_commit, read_versions
from tests.test_history import END, REGISTERED, T, frame, person, versions

ANY_ORDER = replace(SILVER_CUSTOMERS, any_order=True)


def rows_of(df, names):
    return sorted(map(str, df.select(*names).collect()))


@pytest.mark.parametrize("rules", [SILVER_CUSTOMERS, CUSTOMER_SNAPSHOT], ids=["silver", "snapshot"])
def test_any_order_gives_the_history_of_the_order_of_time(spark, tmp_path, rules):
    chance = random.Random(11)

    def some_person(key):
        registered = dt.date(2023, 5, chance.randint(1, 3)) if chance.random() < 0.8 else None
        return person(key, name=chance.choice("nm"), city=chance.choice(["a", "b", None]), registered=registered)

    batches = [frame(spark, *[some_person(k) for k in range(400) if chance.random() < 0.7]) for _ in T]
    expected = first_load(batches[0], rules, T[0])
    for rows, at in zip(batches[1:], T[1:]):
        expected = merge_history(written(expected, "history"), rows, rules, at)
    names = sorted(expected.columns)
    expected = rows_of(expected, names)
    for order in [(3, 2, 1, 0), (2, 0, 3, 1)]:
        base = str(tmp_path / "".join(map(str, order)))
        for n in order:
            merge_into(batches[n], base, replace(rules, any_order=True), f"b{n}", T[n])
        stored = read_history(spark, base, rules)
        assert sorted(stored.columns) == names
        assert rows_of(stored, names) == expected, order


def test_a_late_batch_splits_the_version_of_its_time(spark):
    start = observed_load(frame(spark, person(1), person(2)), SILVER_CUSTOMERS, T[0])
    start = splice_batch(start, frame(spark, person(1), person(2, city="d")), SILVER_CUSTOMERS, T[2])
    late = splice_batch(start, frame(spark, person(1, city="x"), person(2, city="d"), person(3)), SILVER_CUSTOMERS, T[1], T[2])
    assert versions(late) == [
        (1, "n", "c", REGISTERED, T[1], False),
        (1, "n", "c", T[2], END, True),
        (1, "n", "x", T[1], T[2], False),
        (2, "n", "c", REGISTERED, T[1], False),
        (2, "n", "d", T[1], END, True),
        (3, "n", "c", REGISTERED, END, True),
    ]
    # A version after the split shows the untracked columns of the batch it opens with.
    assert all(len(r[OBSERVED]) == 1 for r in late.filter("customer_id = 1").collect())


def test_late_batch_with_other_columns_and_without_rows(spark):
    start = observed_load(frame(spark, person(1)), SILVER_CUSTOMERS, T[1])
    wider = frame(spark, person(1, city="b")).selectExpr("*", "'gold' AS loyalty")
    merged = splice_batch(start, wider, SILVER_CUSTOMERS, T[0], T[1])
    assert {r.city: r.loyalty for r in merged.collect()} == {"b": "gold", "c": None}
    assert versions(splice_batch(merged, frame(spark), SILVER_CUSTOMERS, T[2])) == versions(merged)
    empty = observed_load(frame(spark), SILVER_CUSTOMERS, T[1])
    assert versions(splice_batch(empty, frame(spark, person(1)), SILVER_CUSTOMERS, T[0])) == [(1, "n", "c", REGISTERED, END, True)]


def test_rules_times_and_old_commits(spark, tmp_path):
    base = str(tmp_path / "late")
    merge_into(frame(spark, person(1, city="b")), base, ANY_ORDER, "b1", T[1])
    merge_into(frame(spark, person(1, city="d")), base, ANY_ORDER, "b3", T[3])
    before = last_commit(spark, base)
    merge_into(frame(spark, person(1, city="c")), base, ANY_ORDER, "b2", T[2])
    assert [v[2] for v in versions(read_history(spark, base, ANY_ORDER))] == ["b", "c", "d"]
    assert [v[2] for v in versions(read_versions(spark, base, before))] == ["b", "d"]
    assert merge_into(frame(spark, person(1)), base, ANY_ORDER, "b2", T[2]) == last_commit(spark, base)
    with pytest.raises(ValueError, match="already"):
        merge_into(frame(spark, person(1)), base, ANY_ORDER, "b9", T[2])
    with pytest.raises(ValueError, match="any order"):
        merge_into(frame(spark, person(1)), base, SILVER_CUSTOMERS, "b9", T[0])
    plain = str(tmp_path / "plain")
    merge_into(frame(spark, person(1)), plain, SILVER_CUSTOMERS, "b1", T[1])
    with pytest.raises(ValueError, match="without observations"):
        merge_into(frame(spark, person(1)), plain, ANY_ORDER, "b0", T[0])
