"""Schemas that change, incremental silver runs and the check run of the warehouse."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.entities import ENTITIES
from marlstone.operators.history import SILVER_CUSTOMERS
from marlstone.plans.bronze_job import ingest_frame
from marlstone.plans.cli import main
from marlstone.plans.gold_job import build_aggregate, refresh_aggregate
from marlstone.plans.silver_job import merge_into, process_entity, read_history, read_silver
from marlstone.plans.silver_update import update_entity
from marlstone.sources.evolution import common_type, union_evolved
from marlstone.sources.writers import read_batches
from tests.test_jobs import customer, item, order, product

DAY = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)


def at(hour):
    return DAY + dt.timedelta(hours=hour)


def kind(text):
    return T.StructType.fromDDL(f"x {text}")["x"].dataType


@pytest.mark.parametrize(
    "a, b, above",
    [
        ("int", "bigint", "bigint"),
        ("bigint", "double", "double"),
        ("decimal(9,2)", "bigint", "double"),
        ("double", "string", "string"),
        ("boolean", "bigint", "string"),
        ("date", "timestamp", "timestamp"),
        ("date", "bigint", "string"),
        ("array<int>", "array<double>", "array<double>"),
        ("struct<a:int>", "struct<a:string,b:int>", "struct<a:string,b:int>"),
        ("struct<a:int>", "string", "string"),
        ("map<string,int>", "map<string,double>", "map<string,double>"),
    ],
)
def test_common_type(spark, a, b, above):
    assert common_type(kind(a), kind(b)).simpleString() == above
    assert common_type(kind(b), kind(a)).simpleString() == above
    assert common_type(kind(a), T.NullType()) == common_type(T.NullType(), kind(a)) == kind(a)


def test_union_of_changed_columns(spark):
    parts = [
        spark.createDataFrame([(1, None, (1,), [1])], "k long, v string, s struct<a:int>, l array<int>"),
        spark.createDataFrame([(2, 5, (2, "b"), [0.5])], "k long, v long, s struct<a:long,b:string>, l array<double>"),
        spark.createDataFrame([(3, 2.5, None)], "k long, v double, extra date"),
    ]
    found = union_evolved(parts)
    assert dict(found.dtypes) == {"k": "bigint", "v": "double", "s": "struct<a:bigint,b:string>", "l": "array<double>", "extra": "date"}
    rows = {r.k: r for r in found.collect()}
    assert [rows[k].v for k in (1, 2, 3)] == [None, 5.0, 2.5]
    assert rows[1].s == (1, None) and rows[2].s == (2, "b") and rows[3].s is None and rows[1].l == [1.0]
    text = union_evolved([*parts, spark.createDataFrame([(4, "x")], "k long, v string")])
    assert [r.v for r in text.orderBy("k").collect()] == [None, "5", "2.5", "x"]


def test_history_keeps_rows_of_older_types(spark, tmp_path):
    base = str(tmp_path / "history")
    types = dict(ENTITIES["customers"].types)
    schema = ", ".join(f"{c} {'date' if 'date' in c else t}" for c, t in types.items())

    def incoming(city, value, value_type):
        row = customer(1, city=city, registration_date=dt.date(2023, 1, 2), birth_date=dt.date(1990, 1, 1))
        return spark.createDataFrame([tuple(row[c] for c in types) + (value,)], f"{schema}, points {value_type}")

    for n, (city, value, value_type) in enumerate([("a", 5, "long"), ("b", None, "string"), ("c", 2.5, "double"), ("d", "x", "string")]):
        merge_into(incoming(city, value, value_type), base, SILVER_CUSTOMERS, f"b-{n}", at(n))
    rows = read_history(spark, base, SILVER_CUSTOMERS).orderBy("effective_from").collect()
    assert [(r.city, r.points) for r in rows] == [("a", "5"), ("b", None), ("c", "2.5"), ("d", "x")]
    assert [r.is_current for r in rows] == [False, False, False, True]


def rows_of(df):
    return sorted(map(str, df.drop("_silver_processed_at").collect()))


def full_run(spark, name, bronze, tmp_path):
    base = str(tmp_path / f"full-{len(os.listdir(tmp_path))}")
    process_entity(spark, name, bronze, base, null_limit=50.0, processed_at=at(0))
    return rows_of(read_silver(spark, base, name))


def test_update_reads_and_replaces_touched_months_only(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")

    def arrive(batch, hour, records):
        frame = spark.createDataFrame(records)
        ingest_frame(frame, ENTITIES["orders"], bronze, batch, as_of="2024-06-01", ingested_at=at(hour))

    def update():
        found = update_entity(spark, "orders", bronze, silver, null_limit=50.0, processed_at=at(0))
        assert rows_of(read_silver(spark, silver, "orders")) == full_run(spark, "orders", bronze, tmp_path)
        return found

    arrive("1", 0, [order(i, order_date=f"2024-{1 + i % 5:02d}-10") for i in range(1, 41)] + [order(50, order_date="no date")])
    first = update()
    assert first.full and first.rows_changed == 41 and first.files_stored == 6
    arrive("2", 2, [order(1, status="Returned", order_date="2024-02-10"), order(99, order_date="2024-02-11")])
    second = update()
    assert not second.full and second.partitions == ((2024, 2),) and second.rows_changed == 2
    assert second.files_read == 2  # of the table and of its recency
    arrive("3", 1, [order(1, status="stale", order_date="2024-02-10")])  # older than batch 2
    assert update().rows_changed == 0
    arrive("4", 3, [order(50, order_date="2024-07-01"), *[order(i, order_date="2024-07-02") for i in range(5, 41, 5)]])
    moved = update()  # January and the rows without a date are empty now
    assert set(moved.partitions) == {(2024, 1), (2024, 7), (None, None)}
    assert update().batches == ()
    arrive("2", 4, [order(2, status="Returned")])  # a replay with other rows
    assert update().full


@pytest.mark.parametrize("name, make", [("order_items", item), ("products", product), ("customers", customer)])
def test_update_of_tables_without_months(spark, tmp_path, name, make):
    bronze, silver, entity = str(tmp_path / "bronze"), str(tmp_path / "silver"), ENTITIES[name]
    changed = {"order_items": "unit_price", "products": "brand", "customers": "city"}[name]
    for n, keys in enumerate([range(1, 9), (3, 20), (3,)]):
        schema = ", ".join(f"{c} {'string' if t in ('date', 'timestamp') else t}" for c, t in entity.types.items())
        records = [make(k, **{changed: float(k + n) if changed == "unit_price" else f"v{n}"}) for k in keys]
        frame = spark.createDataFrame([tuple(r[c] for c in entity.types) for r in records], schema)
        ingest_frame(frame, entity, bronze, f"b-{n}", ingested_at=at(5 - 5 * (n == 2)))  # the third batch is older
        found = update_entity(spark, name, bronze, silver, null_limit=50.0, processed_at=at(n))
        assert found.rows_changed == {0: 8, 1: 2, 2: 0}[n]
    stored = {r[entity.key]: r[changed] for r in read_silver(spark, silver, name).collect() if name != "customers" or r.is_current}
    assert sorted(stored) == [*range(1, 9), 20]
    assert stored[3] == (4.0 if changed == "unit_price" else "v1")


def test_batches_with_changed_types_reach_silver(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    for n, (value, value_type) in enumerate([(None, "string"), (7, "long"), ("x", "string")]):
        frame = spark.createDataFrame([order(n)]).withColumn("note", F.lit(value).cast(value_type))
        ingest_frame(frame, ENTITIES["orders"], bronze, f"b-{n}", ingested_at=at(n))
    found = read_batches(spark, bronze, "orders")
    assert [(r.order_id, r.note, r.order_month) for r in found.orderBy("order_id").collect()] == [(0, None, 5), (1, "7", 5), (2, "x", 5)]
    numbers = read_batches(spark, bronze, "orders", ["b-0", "b-1"])
    assert dict(numbers.dtypes)["note"] == "bigint" and numbers.count() == 2


def write_samples(folder, broken):
    tables = {
        "customers": [customer(1, churn_date=""), customer(2, gender="x" if broken else "f", churn_date="")],
        "products": [product(1)],
        "orders": [order(1), order(2, customer_id=9 if broken else 2)],
        "order_items": [item(1), item(1 if broken else 2, order_id=2)],
    }
    for name, records in tables.items():
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{name}_sample.csv", "w") as out:
            out.write(",".join(records[0]) + "\n")
            out.writelines(",".join(str(v) for v in r.values()) + "\n" for r in records)


def test_warehouse_checks_set_the_exit_status(spark, tmp_path, capsys):
    def run(broken, *more):
        samples, warehouse = str(tmp_path / f"samples-{broken}"), str(tmp_path / f"warehouse-{broken}-{len(more)}")
        write_samples(samples, broken)
        status = main(["warehouse", "--samples-path", samples, "--warehouse", warehouse, "--batch-id", "r1", "--as-of", "2024-06-01", *more])
        return status, warehouse, capsys.readouterr().out

    status, warehouse, out = run(False)
    assert status == 0 and "checks: ok 130" in out
    report = spark.read.parquet(f"{warehouse}/checks/batch=id-r1")
    assert report.count() == 130 and report.filter("failures > 0").isEmpty()
    status, warehouse, out = run(True)
    assert status == 1
    report = spark.read.parquet(f"{warehouse}/checks/batch=id-r1").filter("failures > 0")
    found = {(r.model, r.check_name, r.column_name): r.failures for r in report.collect()}
    assert found[("stg_orders", "relationships", "customer_id")] == 1
    assert found[("stg_order_items", "unique", "order_item_id")] == 1
    assert found[("stg_customers", "accepted_values", "gender")] == 1
    assert run(True, "--no-checks")[0] == 0


def test_gold_follows_the_months_that_silver_runs_changed(spark, tmp_path):
    bronze, silver, refreshed = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    makers = {"orders": order, "order_items": item, "products": product}

    def arrive(name, batch, hour, rows):
        entity = ENTITIES[name]
        schema = ", ".join(f"{c} {'string' if t in ('date', 'timestamp') else t}" for c, t in entity.types.items())
        records = [makers[name](**r) for r in rows]
        frame = spark.createDataFrame([tuple(r[c] for c in entity.types) for r in records], schema)
        ingest_frame(frame, entity, bronze, batch, ingested_at=at(hour))
        update_entity(spark, name, bronze, silver, null_limit=50.0, processed_at=at(hour))

    def refresh(expected):
        found = refresh_aggregate(spark, "daily_revenue", silver, refreshed)
        assert found.months == expected
        full = str(tmp_path / f"full-{len(os.listdir(tmp_path))}")
        build_aggregate(spark, "daily_revenue", silver, full)
        tables = [spark.read.parquet(f"{base}/daily_revenue_by_category") for base in (refreshed, full)]
        columns = sorted(tables[1].columns)
        assert len({str(sorted(map(str, t.select(*columns).collect()))) for t in tables}) == 1

    arrive("orders", "1", 0, [dict(key=i, order_date=f"2024-0{i}-10") for i in range(1, 6)])
    arrive("order_items", "1", 0, [dict(key=i, order_id=i, product_id=i % 3) for i in range(1, 6)])
    arrive("products", "1", 0, [dict(key=i, category=f"c{i}") for i in range(3)])
    refresh(None)
    refresh(frozenset())
    arrive("order_items", "2", 1, [dict(key=1, order_id=2, product_id=1, line_total=7.0)])  # a line leaves January
    refresh(frozenset({(2024, 1), (2024, 2)}))
    arrive("products", "2", 2, [dict(key=0, category="new")])
    refresh(frozenset({(2024, 3)}))
    arrive("orders", "2", 3, [dict(key=5, order_date="2024-04-11")])
    refresh(frozenset({(2024, 4), (2024, 5)}))


def test_a_full_run_copies_its_rows_once(spark, tmp_path, monkeypatch):
    from marlstone.plans import silver_update

    bronze, silver, labels = f"{tmp_path}/bronze", f"{tmp_path}/silver", []
    plain = silver_update.scratch_table
    monkeypatch.setattr(silver_update, "scratch_table", lambda df, label: labels.append(label) or plain(df, label))
    for n in (1, 2):
        rows = spark.createDataFrame([order(1, status="shipped" if n == 1 else "returned"), order(n + 1)])
        ingest_frame(rows, ENTITIES["orders"], bronze, f"b-{n}", as_of=DAY.date(), ingested_at=at(n))
        update_entity(spark, "orders", bronze, silver, null_limit=50.0, processed_at=at(n))
        assert ("winners-orders" in labels) == (n == 2)
    assert {(r.order_id, r.status) for r in read_silver(spark, silver, "orders").collect()} == {(1, "returned"), (2, order(2)["status"]), (3, order(3)["status"])}
