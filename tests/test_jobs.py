"""Jobs over files in a temporary folder."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from marlstone.operators.quality import DataQualityError
from marlstone.plans import warehouse
from marlstone.plans.bronze_job import ingest_entity, run_bronze
from marlstone.plans.cli import main
from marlstone.plans.gold_job import run_gold
from marlstone.plans.outcomes import exit_status, run_each
from marlstone.plans.silver_job import process_entity, read_silver, run_silver
from marlstone.plans.warehouse import build_warehouse
from marlstone.sources.readers import read_csv, read_if_present, read_json
from marlstone.sources.scratch import CLEANUP, shared_folder
from marlstone.sources.writers import export_sample, read_batches, replace_months, write_csv, write_table
from marlstone.streaming.arrivals import ingest_arrivals

AT = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)


def customer(key, **more):
    base = dict(
        customer_id=key, first_name="F", last_name="L", email=f"{key}@x", phone="1", address="a", city="c",
        state="s", zip_code="z", country="US", registration_date="2023-01-02", birth_date="1990-01-01",
        gender="m", income_bracket="low", is_churned=False, churn_date=None,
    )
    return {**base, **more}


def order(key, **more):
    base = dict(
        order_id=key, customer_id=1, order_date="2024-05-20", order_timestamp="2024-05-20 10:00:00",
        status="completed", payment_method="paypal", shipping_city="c", shipping_state="s", shipping_zip="z",
        subtotal=10.0, shipping_cost=1.0, tax=0.5, total=11.5,
    )
    return {**base, **more}


def item(key, **more):
    base = dict(
        order_item_id=key, order_id=1, product_id=1, quantity=1, unit_price=10.0, discount_pct=0.0, line_total=10.0
    )
    return {**base, **more}


def product(key, **more):
    base = dict(
        product_id=key, product_name="P", category="A", sub_category="a", brand="b", price=10.0, cost=6.0,
        weight_kg=1.0, rating=4.0, review_count=3, is_active=True, created_date="2020-01-01",
    )
    return {**base, **more}


def write_array(path, records):
    """A JSON array with one object per line."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("[\n" + ",\n".join(json.dumps(r) for r in records) + "\n]\n")


@pytest.fixture
def raw(tmp_path):
    folder = str(tmp_path / "raw")
    write_array(f"{folder}/customers.json", [customer(1), customer(2, email=None), customer(3)])
    write_array(f"{folder}/products.json", [product(1), product(2, price=None)])
    write_array(
        f"{folder}/orders.json",
        [order(1), order(2, customer_id="x"), order(3, order_date="junk"), order(4, order_date="2024-04-30", gift=True)],
    )
    write_array(f"{folder}/order_items.json", [item(1), item(2, product_id=None), item(3, order_id=4, line_total=None)])
    return folder


@pytest.mark.parametrize("layout", ["lines", "document"])
def test_json_layouts_agree(spark, raw, layout):
    rows = read_json(spark, f"{raw}/orders.json", layout=layout)
    assert rows.count() == 4
    assert sorted(r.order_id for r in rows.collect()) == [1, 2, 3, 4]
    assert "gift" in rows.columns


def test_broken_json_is_quarantined(spark, tmp_path):
    path = str(tmp_path / "orders.json")
    with open(path, "w") as f:
        f.write(json.dumps(order(1)) + "\n{broken\n" + json.dumps(order(2)) + "\n")
    counts = ingest_entity(spark, "orders", path, str(tmp_path / "bronze"), "b")
    assert (counts.total, counts.valid, counts.quarantined) == (3, 2, 1)
    kept = read_batches(spark, str(tmp_path / "bronze/_quarantine"), "orders").collect()
    assert [r._corrupt_record for r in kept] == ["{broken"]


def test_bronze_counts_flags_and_replay(spark, raw, tmp_path):
    base = str(tmp_path / "bronze")
    for _ in range(2):  # the second run replays the batch
        outcomes = run_bronze(spark, raw, base, batch_id="007", as_of=dt.date(2024, 5, 27))
        assert exit_status(outcomes) == 0
    counts = {o.name: (o.detail.total, o.detail.valid, o.detail.quarantined) for o in outcomes}
    assert counts == {"customers": (3, 2, 1), "products": (2, 1, 1), "orders": (4, 3, 1), "order_items": (3, 2, 1)}
    rows = {r.order_id: r for r in read_batches(spark, base, "orders").collect()}
    assert len(rows) == 3 and {r._batch_id for r in rows.values()} == {"007"}
    assert (rows[1]._is_late, rows[4]._is_late, rows[3]._is_late) == (False, True, None)
    assert (rows[3].order_year, rows[4].gift) == (None, True)
    assert read_batches(spark, base + "/_quarantine", "orders").count() == 1


def test_replay_of_a_corrected_batch_clears_its_quarantine(spark, raw, tmp_path):
    base = str(tmp_path / "bronze")
    path = f"{raw}/products.json"
    assert ingest_entity(spark, "products", path, base, "b").quarantined == 1
    write_array(path, [product(1), product(2)])
    counts = ingest_entity(spark, "products", path, base, "b")
    assert (counts.valid, counts.quarantined) == (2, 0)
    assert read_batches(spark, base, "products").count() == 2
    assert not os.path.exists(f"{base}/_quarantine/products/batch_folder=id-b")


@pytest.mark.parametrize("again", [[], [{"name": "without a key"}]])
def test_replay_without_valid_rows_clears_the_earlier_ones(spark, raw, tmp_path, again):
    base, path = str(tmp_path / "bronze"), f"{raw}/products.json"
    assert ingest_entity(spark, "products", path, base, "b").valid == 1
    write_array(path, again)
    counts = ingest_entity(spark, "products", path, base, "b")
    assert (counts.valid, counts.quarantined) == (0, len(again))
    assert not os.path.exists(f"{base}/products/batch_folder=id-b")
    assert os.path.exists(f"{base}/_quarantine/products/batch_folder=id-b") == bool(again)


def test_csv_doubles_quotes(spark, tmp_path):
    path = str(tmp_path / "csv")
    row = (1, '12" vinyl, "best"', "x")
    write_csv(spark.createDataFrame([row], "n int, s string, z string").coalesce(1), path)
    assert [tuple(r) for r in read_csv(spark, path).collect()] == [("1", *row[1:])]
    part = next(f for f in os.listdir(path) if f.endswith(".csv"))
    with open(f"{path}/{part}") as f:
        assert f.read() == 'n,s,z\n1,"12"" vinyl, ""best""",x\n'


def test_empty_source_is_skipped(spark, tmp_path):
    path = str(tmp_path / "orders.json")
    write_array(path, [])
    counts = ingest_entity(spark, "orders", path, str(tmp_path / "bronze"), "b")
    assert (counts.total, counts.valid, counts.quarantined) == (0, 0, 0)
    assert not os.path.exists(tmp_path / "bronze")


def test_source_without_any_record_is_all_quarantine(spark, tmp_path):
    path = str(tmp_path / "orders.json")
    with open(path, "w") as f:
        f.write("no json\nat all\n")
    counts = ingest_entity(spark, "orders", path, str(tmp_path / "bronze"), "b")
    assert (counts.total, counts.valid, counts.quarantined) == (2, 0, 2)


def test_one_failing_entity_does_not_stop_the_others(spark, raw, tmp_path):
    os.remove(f"{raw}/orders.json")
    outcomes = run_bronze(spark, raw, str(tmp_path / "bronze"), ["orders", "products"], "b")
    assert [(o.name, o.ok) for o in outcomes] == [("orders", False), ("products", True)]
    assert exit_status(outcomes) == 1


def test_layers_end_to_end(spark, raw, tmp_path):
    bronze, silver, gold, csv = (str(tmp_path / n) for n in ("bronze", "silver", "gold", "csv"))
    run_bronze(spark, raw, bronze, batch_id="b1", ingested_at="2024-06-01 00:00:00")
    assert exit_status(run_silver(spark, bronze, silver, null_limit=60.0, processed_at=AT, run_id="r1")) == 0
    # A second batch: order 1 is corrected, customer 1 moves.
    write_array(f"{raw}/orders.json", [order(1, total=20.0)])
    write_array(f"{raw}/customers.json", [customer(1, city="elsewhere")])
    run_bronze(spark, raw, bronze, ["orders", "customers"], batch_id="b2", ingested_at="2024-06-02 00:00:00")
    for _ in range(2):  # repeating a run changes nothing
        outcomes = run_silver(spark, bronze, silver, null_limit=60.0, processed_at=AT, run_id="r2")
        assert exit_status(outcomes) == 0
    totals = {r.order_id: r.total for r in read_silver(spark, silver, "orders").collect()}
    assert totals == {1: 20.0, 3: 11.5, 4: 11.5}
    history = read_silver(spark, silver, "customers")
    assert {(r.customer_id, r.city, r.is_current) for r in history.collect()} == {
        (1, "c", False),
        (1, "elsewhere", True),
        (3, "c", True),
    }
    assert history.select("_silver_processed_at").distinct().count() == 1
    may = read_silver(spark, silver, "orders", months=((2024, 5), (2024, 12)))
    assert [r.order_id for r in may.collect()] == [1]

    outcomes = run_gold(spark, silver, gold, csv, as_of=dt.date(2024, 6, 1))
    assert {o.name: o.detail for o in outcomes} == {"daily_revenue": 2, "clv": 2, "funnel": 2, "cohort": 3}
    exported = read_csv(spark, f"{csv}/daily_revenue_by_category")
    assert exported.columns[:4] == ["order_date", "category", "sub_category", "total_revenue"]
    assert {r.total_revenue for r in exported.collect()} == {"10.0"}
    # Scratch tables are gone.
    shared = spark.conf.get("spark.checkpoint.dir") + "/marlstone"
    assert not [n for n in os.listdir(shared) if n.startswith("dedup-")]


def test_gold_refresh_keeps_other_months(spark, raw, tmp_path):
    bronze, silver, gold, csv = (str(tmp_path / n) for n in ("bronze", "silver", "gold", "csv"))
    dates = {1: "2024-03-05", 2: "2024-04-05", 3: "2024-05-05"}

    def store(days):
        rows = [order(k, order_date=d, order_timestamp=f"{d} 10:00:00") for k, d in days.items()]
        write_array(f"{raw}/orders.json", rows)
        run_bronze(spark, raw, bronze, ["orders"], batch_id="b1", ingested_at="2024-06-01 00:00:00")
        run_silver(spark, bronze, silver, ["orders"], null_limit=60.0, processed_at=AT)

    def months():
        rows = spark.read.parquet(f"{gold}/conversion_funnel").select("order_month").distinct().collect()
        assert read_csv(spark, f"{csv}/conversion_funnel").select("order_month").distinct().count() == len(rows)
        return {r.order_month for r in rows}

    store(dates)
    run_gold(spark, silver, gold, csv, ["funnel"])
    assert months() == {3, 4, 5}
    store({**dates, 2: "2024-05-06"})  # April is empty now
    outcomes = run_gold(spark, silver, gold, csv, ["funnel"], months=((2024, 4), (2024, 5)))
    assert exit_status(outcomes) == 0 and months() == {3, 5}
    assert exit_status(run_gold(spark, silver, gold, csv, ["clv"], months=((2024, 4), (2024, 5)))) == 1


def test_quality_gate_stops_one_entity(spark, raw, tmp_path):
    write_array(f"{raw}/customers.json", [customer(k, first_name=None if k < 3 else "F") for k in range(1, 11)])
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    run_bronze(spark, raw, bronze, batch_id="b")
    with pytest.raises(DataQualityError, match="first_name is NULL in 2 of 10 rows"):
        process_entity(spark, "customers", bronze, silver)
    outcomes = {o.name: o.ok for o in run_silver(spark, bronze, silver, ["customers", "products"])}
    assert outcomes == {"customers": False, "products": True}
    assert not os.path.exists(f"{silver}/customers")


def test_stream_keeps_late_rows_and_ingests_files_once(spark, tmp_path):
    source, bronze, state = (str(tmp_path / n) for n in ("arrivals", "bronze", "state"))
    schema = "order_id bigint, customer_id bigint, order_date string, total double"

    def drain():
        ingest_arrivals(
            spark, "orders", source, bronze, state, schema=schema, files_per_batch=1, as_of=dt.date(2024, 5, 27)
        ).awaitTermination()
        return sorted((r.order_id, r._is_late, r._batch_id) for r in read_batches(spark, bronze, "orders").collect())

    write_array(f"{source}/1.json", [order(1), order(2, order_date="2020-01-01"), order(3, customer_id=None)])
    first = drain()
    assert first == [(1, False, "stream-0"), (2, True, "stream-0")]
    assert drain() == first
    write_array(f"{source}/2.json", [order(4)])
    assert drain() == first + [(4, False, "stream-1")]
    assert read_batches(spark, bronze + "/_quarantine", "orders").count() == 1


def test_replace_months_keeps_the_rest(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ("order_year", "order_month")
    rows = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "id int, order_year int, order_month int")
    write_table(rows, path, keys)
    replace_months(rows.filter("order_month = 2").withColumn("id", F.lit(9)), path, keys)
    assert sorted((r.id, r.order_month) for r in spark.read.parquet(path).collect()) == [(1, 1), (9, 2)]


def test_optional_source(spark, tmp_path):
    assert read_if_present(spark, str(tmp_path / "none")) is None
    spark.range(3).write.parquet(str(tmp_path / "some"))
    assert read_if_present(spark, str(tmp_path / "some")).count() == 3


def test_sample_export_is_the_first_rows_by_key(spark, tmp_path):
    path = str(tmp_path / "sample")
    export_sample(spark.range(100).repartition(7), path, ["id"], rows=10)
    assert sorted(int(r.id) for r in read_csv(spark, path).collect()) == list(range(10))


def test_warehouse_from_csv(spark, tmp_path):
    samples, warehouse = str(tmp_path / "samples"), str(tmp_path / "warehouse")
    rows = {
        "customers": [customer(1), customer(2)],
        "products": [product(1), product(2, rating=9.0)],
        "orders": [order(1), order(2, status=" Pending ")],
        "order_items": [item(1), item(2, order_id=2)],
    }
    os.makedirs(samples)
    for name, records in rows.items():
        with open(f"{samples}/{name}_sample.csv", "w") as f:
            f.write(",".join(records[0]) + "\n")
            for record in records:
                f.write(",".join("" if v is None else str(v) for v in record.values()) + "\n")
    at = [dt.datetime(2024, 6, d, tzinfo=dt.timezone.utc) for d in (1, 2)]
    models = build_warehouse(spark, samples, warehouse, "run-1", at[0], as_of=dt.date(2024, 6, 1))
    assert len(models) == 10
    assert spark.table("stg_orders").filter("status = 'pending'").count() == 1
    assert models["fct_daily_revenue"].first().gross_revenue == 10.0
    assert {r.rating for r in models["dim_products"].collect()} == {4.0, 5.0}
    assert models["dim_customers"].filter("is_current").count() == 2
    with open(f"{samples}/customers_sample.csv", "w") as f:  # customer 2 disappears
        values = ["" if v is None else str(v) for v in customer(1).values()]
        f.write(",".join(customer(1)) + "\n" + ",".join(values) + "\n")
    again = build_warehouse(spark, samples, warehouse, "run-2", at[1], as_of=dt.date(2024, 6, 1))
    assert {(r.customer_id, r.is_current) for r in again["dim_customers"].collect()} == {(1, True), (2, False)}


def test_checked_warehouse_parses_each_csv_once(spark, tmp_path):
    samples = f"{tmp_path}/samples"
    rows = {
        "customers": [customer(1), customer(2)],
        "products": [product(1), product(2, rating=9.0)],
        "orders": [order(1), order(2, status=" Pending ")],
        "order_items": [item(1), item(2, order_id=2)],
    }
    for name, records in rows.items():
        spark.createDataFrame([{k: None if v is None else str(v) for k, v in r.items()} for r in records], ", ".join(f"`{k}` string" for k in records[0])).write.option("header", True).csv(f"{samples}/{name}_sample.csv")
    at, day = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc), dt.date(2024, 6, 1)
    plain = build_warehouse(spark, samples, f"{tmp_path}/plain", "run-1", at, as_of=day)
    stored = build_warehouse(spark, samples, f"{tmp_path}/stored", "run-1", at, as_of=day, store_staging=True)
    assert not [f for df in stored.values() for f in df.inputFiles() if samples in f]
    for name, df in stored.items():
        assert df.dtypes == plain[name].dtypes
        assert sorted(map(str, df.collect())) == sorted(map(str, plain[name].collect()))


def sample_files(spark, folder, **rows):
    for name, records in rows.items():
        texts = [{k: None if v is None else str(v) for k, v in r.items()} for r in records]
        columns = ", ".join(f"`{k}` string" for k in records[0])
        spark.createDataFrame(texts, columns).write.option("header", True).csv(f"{folder}/{name}_sample.csv")


def test_warehouse_in_slices_of_orders(spark, tmp_path, monkeypatch):
    """Many lines are computed in slices of orders; orders and lines repeat, some lines have no order and hold no values."""
    statuses = ["completed", "shipped", "pending", None]
    orders = [order(i % 37, customer_id=i % 5, status=statuses[i % 4], order_date=f"2024-05-{1 + i % 9:02d}", total=None if i % 6 == 0 else 1.0 + i) for i in range(40)]
    lines = [
        item(i, order_id=None if i % 17 == 0 else 5 if i % 3 == 0 else i % 50, product_id=i % 4, quantity=1 + i % 3, discount_pct=None if i % 5 else 2.0 + i % 7, line_total=None if i % 11 == 0 else 0.1 * i)
        for i in range(300)
    ]
    products = [product(i, category="A" if i % 2 else None, sub_category=f"S{i}", cost=None if i == 3 else 1.25) for i in range(4)]
    people = [customer(1), customer(2), customer(2, email=None)]
    at, day = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc), dt.date(2024, 6, 1)
    found = {}
    for kind, many in (("whole", 32_000_000), ("sliced", 0)):
        monkeypatch.setattr(warehouse, "MANY_BYTES", many)
        samples = f"{tmp_path}/{kind}-samples"
        sample_files(spark, samples, customers=people, products=products, orders=orders, order_items=lines)
        models = build_warehouse(spark, samples, f"{tmp_path}/{kind}", "run-1", at, as_of=day, store_staging=True, consume_samples=True)
        assert not os.listdir(samples)
        n = warehouse.slices_of(models["stg_order_items"])
        assert n == (1 if kind == "whole" else 4)
        report = warehouse.check_warehouse(models, f"{tmp_path}/{kind}", "run-1", n)
        found[kind] = {name: (df.dtypes, sorted(map(str, df.collect()))) for name, df in [*models.items(), ("report", report)]}
    assert found["sliced"] == found["whole"]
    assert len(found["whole"]["fct_daily_revenue"][1]) > 9 and len(found["whole"]["report"][1]) == 130


def test_the_warehouse_leaves_no_shuffle_files(spark, tmp_path):
    """A job of many plans held the shuffle files of all of them until the driver collected its garbage."""

    def shuffled():
        files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    samples, stored = f"{tmp_path}/samples", f"{tmp_path}/warehouse"
    sample_files(spark, samples, customers=[customer(1)], products=[product(1)], orders=[order(1), order(2)], order_items=[item(1), item(2, order_id=2)])
    at, before = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc), shuffled()
    models = build_warehouse(spark, samples, stored, "run-1", at, as_of=dt.date(2024, 6, 1), store_staging=True)
    assert os.listdir(samples)
    warehouse.check_warehouse(models, stored, "run-1")
    for _ in range(100):  # files are removed behind the job's back
        if not (left := shuffled() - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(CLEANUP) == "false"
    assert models["int_order_enriched"].count() == 2


class Unconfigured:
    """A session without a shared folder."""

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Unconfigured("spark://host:7077"))
    private = shared_folder(Unconfigured("local[2]"))
    assert os.path.isdir(private) and private == shared_folder(Unconfigured("local[2]"))


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_run_each_reports_the_message():
    (outcome,) = run_each(["x"], lambda _: 1 / 0)
    assert not outcome.ok and "division" in outcome.detail


def test_command_line(spark, raw, tmp_path):
    bronze, silver, gold = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    write_array(f"{raw}/customers.json", [customer(1), customer(2)])
    write_array(f"{raw}/products.json", [product(1)])
    write_array(f"{raw}/orders.json", [order(1)])
    write_array(f"{raw}/order_items.json", [item(1)])
    ingest = ["bronze", "--source-base", raw, "--bronze-base", bronze, "--batch-id", "b", "--as-of", "2024-06-01"]
    assert main(ingest) == 0
    assert main(["silver", "--bronze-base", bronze, "--silver-base", silver, "--run-id", "r"]) == 0
    assert main(["gold", "--silver-base", silver, "--gold-base", gold, "--aggregates", "clv", "funnel"]) == 0
    assert spark.read.parquet(f"{gold}/customer_lifetime_value").count() == 2
    assert main(["gold", "--silver-base", str(tmp_path / "none"), "--gold-base", gold]) == 1
    with pytest.raises(SystemExit):
        main(["silver", "--bronze-base", bronze, "--silver-base", silver, "--entities", "invoices"])
    spark.conf.unset("spark.sql.adaptive.forceOptimizeSkewedJoin")
