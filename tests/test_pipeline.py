from __future__ import annotations

import datetime as dt
import shutil
from decimal import Decimal as D
from threading import RLock

import pytest
from conftest import day
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tillmetrics import RETAIL
from tillmetrics.operators import calendar as cal
from tillmetrics.operators import quality
from tillmetrics.plans import pipeline, views
from tillmetrics.sources import schemas as S
from tillmetrics.sources.export import checksums, export_csv, read_csv, row_counts, unchanged
from tillmetrics.sources.warehouse import BATCH, Warehouse, _offsets, shared_folder, stamp

FIRST, SEEDED = day("2026-01-01"), day("2026-01-04")
BATCH_FIELD = S.T.StructField(BATCH, S.T.DateType())
FACTS = ("fact_orders", "fact_marketing_spend", "fact_returns")


def sale(date, order, **changes):
    row = {
        BATCH: day(date),
        "order_id": order,
        "order_date": date,
        "customer_email": "a@example.com",
        "product_name": "Widget",
        "category": "electronics",
        "quantity": 1,
        "unit_price": 10,
    }
    return {**row, **changes}


@pytest.fixture
def warehouse(spark, seeded, tmp_path):
    return Warehouse(spark, shutil.copytree(seeded, tmp_path / "warehouse").as_posix())


@pytest.fixture(scope="module")
def seeded(spark, frame, tmp_path_factory):
    """Dimensions, four days of history, and marketing exports of the following days."""
    w = Warehouse(spark, str(tmp_path_factory.mktemp("seed")))
    customers = [(1, RETAIL.guest_email, "Unknown"), (2, "a@example.com", "Spain")]
    people = frame(
        S.DIM_CUSTOMERS,
        [
            {
                "customer_id": i,
                "full_name": email,
                "email": email,
                "region": region,
                "acquisition_channel": "Email" if i > 1 else "Unknown",
                "signup_date": FIRST,
                "activity_score": 1,
            }
            for i, email, region in customers
        ],
    )
    goods = frame(
        S.DIM_PRODUCTS,
        [
            {
                "product_id": 9,
                "product_name": "Widget",
                "category": "Electronics",
                "unit_cost": 1,
                "list_price": 2,
            }
        ],
    )
    pipeline.load_dimensions(w, people, goods)
    land_sales(
        w,
        frame,
        [sale(f"2026-01-0{d}", d) for d in (1, 2, 3, 4)]
        + [sale("2026-01-04", 4), sale("2026-01-03", 3, quantity=0)],
    )
    spend = [
        {BATCH: day(f"2026-01-0{d}"), "spend_date": f"2026-01-0{d}", "channel": "EMAIL", "spend": d}
        for d in range(1, 8)
    ]
    w.land("raw_marketing_spend", unnumbered(frame(S.RAW_MARKETING, spend, [BATCH_FIELD])), delivery="a")
    pipeline.full_refresh(w, FIRST, SEEDED, RETAIL)
    return w.root


def unnumbered(raw):
    return raw.drop("raw_id", "loaded_at")


def land_sales(w, frame, rows, delivery="shop"):
    w.land("raw_sales_export", unnumbered(frame(S.RAW_SALES, rows, [BATCH_FIELD])), delivery=delivery)


def counts(w):
    return {r["relation"]: r["rows"] for r in row_counts(w.star()).collect()}


def test_refresh(warehouse, rows):
    assert counts(warehouse) == {
        "dim_customers": 2,
        "dim_products": 1,
        "dim_date": 4,
        "fact_orders": 4,
        "fact_marketing_spend": 4,
        "fact_returns": 0,
    }
    report = warehouse.read("report_sales")
    assert rows(report, BATCH, "raw_rows", "duplicates_dropped", "clean_rows") == [
        (day("2026-01-01"), 1, 0, 1),
        (day("2026-01-02"), 1, 0, 1),
        (day("2026-01-03"), 2, 0, 1),
        (day("2026-01-04"), 2, 1, 1),
    ]
    assert quality.reference_violations(warehouse.star()).filter("violations > 0").count() == 0
    assert views.daily_revenue(
        *(warehouse.star()[t] for t in ("fact_orders", "dim_date", "fact_returns"))
    ).count() == 4


def test_append_and_append_again(warehouse, frame, rows):
    land_sales(warehouse, frame, [sale("2026-01-05", 5), sale("2026-01-06", 6), sale("2026-01-07", 7)])
    today = day("2026-01-07")
    assert pipeline.append_missing(warehouse, today, RETAIL) == [day("2026-01-05"), day("2026-01-06")]
    first = counts(warehouse)
    assert (first["fact_orders"], first["fact_marketing_spend"], first["dim_date"]) == (6, 6, 6)
    before = {t: rows(warehouse.read(t)) for t in (*FACTS, "dim_date", "report_sales")}
    assert pipeline.append_missing(warehouse, today, RETAIL) == []
    assert {t: rows(warehouse.read(t)) for t in before} == before
    # the day that was still running is picked up on the next one
    assert pipeline.append_missing(warehouse, day("2026-01-08"), RETAIL) == [today]
    assert counts(warehouse)["fact_orders"] == 7


def test_a_day_without_any_row_is_still_processed(warehouse):
    days = pipeline.append_missing(warehouse, day("2026-01-11"), RETAIL)
    assert days[-1] == day("2026-01-10")
    assert warehouse.read("dim_date").agg(F.max("date")).first()[0] == day("2026-01-10")


def test_a_run_that_died_is_done_again(warehouse, frame, monkeypatch, rows):
    land_sales(warehouse, frame, [sale("2026-01-05", 5)])

    def die(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as broken:
        broken.setattr(Warehouse, "append_dates", die)
        with pytest.raises(RuntimeError, match="executor lost"):
            pipeline.append_missing(warehouse, day("2026-01-06"), RETAIL)
    # published, but out of sight until the day is marked
    assert warehouse.read("fact_orders").count() == 5
    assert counts(warehouse)["fact_orders"] == 4
    assert pipeline.append_missing(warehouse, day("2026-01-06"), RETAIL) == [day("2026-01-05")]
    assert counts(warehouse)["fact_orders"] == 5
    assert rows(warehouse.read("dim_date"), "date_id") == [(20260101 + i,) for i in range(5)]


def contents(w):
    """What readers see: rows of the star and the reports."""
    tables = {**w.star(), **w.reports()}
    return {name: sorted(map(str, frame.collect())) for name, frame in tables.items()}


def at_each_write(monkeypatch, step):
    """Calls step(number) before each Parquet write, and before each rename of a pointer."""
    write, commit, number, lock = DataFrameWriter.parquet, Warehouse.commit, iter(range(1000)), RLock()

    def stepped(then):
        def run(*args, **options):
            with lock:
                step(next(number))
            return then(*args, **options)

        return run

    monkeypatch.setattr(DataFrameWriter, "parquet", stepped(write))
    monkeypatch.setattr(Warehouse, "commit", stepped(commit))


def test_readers_see_the_old_star_until_a_refresh_is_done(warehouse, frame, monkeypatch, rows):
    old = contents(warehouse)
    land_sales(warehouse, frame, [sale("2026-01-02", 20), sale("2026-01-05", 50)], "more")
    steps = []

    def same(number):
        steps.append(number)
        assert contents(warehouse) == old

    with monkeypatch.context() as watched:
        at_each_write(watched, same)
        pipeline.full_refresh(warehouse, FIRST, day("2026-01-05"), RETAIL)
    assert len(steps) == 11  # three sources staged, facts, reports, the calendar and the pointer
    assert contents(warehouse) != old
    assert counts(warehouse)["fact_orders"] == 6 and counts(warehouse)["dim_date"] == 5


@pytest.mark.parametrize("dies_at", [0, 4, 9, 10])
def test_a_refresh_that_died_changes_nothing(warehouse, frame, monkeypatch, dies_at):
    old = contents(warehouse)
    land_sales(warehouse, frame, [sale("2026-01-02", 20)], "more")

    def die(number):
        if number == dies_at:
            raise RuntimeError("executor lost")

    with monkeypatch.context() as broken:
        at_each_write(broken, die)
        with pytest.raises(RuntimeError, match="executor lost"):
            pipeline.full_refresh(warehouse, FIRST, SEEDED, RETAIL)
    assert contents(warehouse) == old
    # what it left is in nobody's way, and the days appended to the old star stay in it
    land_sales(warehouse, frame, [sale("2026-01-05", 5)])
    assert pipeline.append_missing(warehouse, day("2026-01-06"), RETAIL) == [day("2026-01-05")]
    assert counts(warehouse)["fact_orders"] == 5
    pipeline.full_refresh(warehouse, FIRST, day("2026-01-05"), RETAIL)
    assert counts(warehouse)["fact_orders"] == 6
    assert len(warehouse._names("_generations")) <= 3


def test_a_reader_keeps_its_generation(warehouse, frame):
    before, old = warehouse.star(), contents(warehouse)
    land_sales(warehouse, frame, [sale("2026-01-02", 20)], "more")
    pipeline.full_refresh(warehouse, FIRST, SEEDED, RETAIL)
    assert sorted(map(str, before["fact_orders"].collect())) == old["fact_orders"]
    assert counts(warehouse)["fact_orders"] == 5
    first = warehouse.path("fact_orders")
    for _ in range(2):
        pipeline.full_refresh(warehouse, FIRST, SEEDED, RETAIL)
    assert warehouse.path("fact_orders") != first
    # dimensions, the facts of now and before, and those that go with the next draft
    assert len(warehouse._names("_generations")) == 4 and len(warehouse._pointers()) == 2


def test_dimensions_change_together(warehouse, monkeypatch, frame):
    old = contents(warehouse)
    star = warehouse.star()
    more = star["dim_customers"].withColumn("region", F.lit("Italy"))

    def same(_):
        assert contents(warehouse) == old

    with monkeypatch.context() as watched:
        at_each_write(watched, same)
        pipeline.load_dimensions(warehouse, more, star["dim_products"])
    found = warehouse.star()["dim_customers"].select("region").distinct().collect()
    assert [r["region"] for r in found] == ["Italy"]


def refund(line, **changes):
    row = {
        BATCH: day("2026-01-05"),
        "order_line_id": line,
        "return_date": "05/01/2026",
        "reason": None,
        "refund_amount": -10,
    }
    return {**row, **changes}


def test_returns_department_works_from_the_lines_due(warehouse, frame, spark, rows):
    """Lines turn 4 days old here; each one is offered for a return exactly once."""
    offered = []

    def land(w, days):
        star = w.star(committed=False)
        due = views.return_decision_cohort(
            star["fact_orders"], star["dim_date"], star["dim_products"], days, 4
        )
        offered.extend(r["date"] for r in due.collect())
        w.land(
            "raw_returns",
            due.select(
                F.col("decided_on").alias(BATCH),
                "order_line_id",
                "category",
                F.date_format("decided_on", "dd/MM/yyyy").alias("return_date"),
                F.lit(None).cast("string").alias("reason"),
                (-F.col("line_revenue")).alias("refund_amount"),
            ),
            delivery="desk",
        )

    for today in ("2026-01-06", "2026-01-09", "2026-01-09", "2026-01-20"):
        pipeline.append_missing(warehouse, day(today), RETAIL, land_returns=land)
    assert sorted(offered) == [FIRST + dt.timedelta(days=i) for i in range(4)]
    found = warehouse.read("fact_returns")
    assert rows(found, "date_id", "reason", "refund_amount") == [
        (20260105 + i, "Unknown", D("10.00")) for i in range(4)
    ]
    assert quality.reference_violations(warehouse.star()).filter("violations > 0").count() == 0


@pytest.mark.parametrize(
    ("bad", "rule"),
    [
        (refund(12345), "unknown order line"),
        (refund(None), "NULL in a required column"),
        (refund(None, return_date="2031-01-01"), "outside the calendar"),
    ],
)
def test_bad_rows_are_not_published(warehouse, frame, bad, rule):
    rows = frame(S.RAW_RETURNS, [bad], [BATCH_FIELD])
    warehouse.land("raw_returns", unnumbered(rows), delivery="desk")
    with pytest.raises(pipeline.DataQualityError, match=rule):
        pipeline.append_missing(warehouse, day("2026-01-06"), RETAIL)
    assert counts(warehouse)["fact_returns"] == 0
    assert counts(warehouse)["dim_date"] == 4


def test_missing_guest_row_is_an_error(frame):
    with pytest.raises(ValueError, match="no guest row"):
        pipeline.guest_id(frame(S.DIM_CUSTOMERS, []), RETAIL)


def test_first_append_starts_at_since(spark, warehouse):
    warehouse.replace("dim_date", warehouse.empty("dim_date"))
    assert pipeline.append_missing(warehouse, SEEDED, RETAIL) == []
    days = pipeline.append_missing(warehouse, SEEDED, RETAIL, since=FIRST)
    assert days == [FIRST + dt.timedelta(days=i) for i in range(3)]


def test_landing_keeps_text_and_numbers_rows(warehouse, frame, rows):
    raw = warehouse.read("raw_sales_export")
    assert raw.filter("category = 'electronics'").count() == 6
    assert raw.filter("loaded_at is null").count() == 0
    ids = [r[0] for r in raw.select("raw_id").collect()]
    assert len(set(ids)) == len(ids)
    # ids grow with the landing day; a delivery replaces itself, another one adds to the day
    per_day = raw.groupBy(BATCH).agg(F.min("raw_id"), F.max("raw_id")).orderBy(BATCH).collect()
    assert all(a[2] < b[1] for a, b in zip(per_day, per_day[1:]))
    land_sales(warehouse, frame, [sale("2026-01-04", 40)])
    again = warehouse.read("raw_sales_export")
    assert rows(again.filter(F.col(BATCH) == SEEDED), "order_id") == [(40,)]
    assert again.count() == 5
    land_sales(warehouse, frame, [sale("2026-01-04", 41), sale("2026-01-04", 42)], "afternoon")
    both = warehouse.read("raw_sales_export").filter(F.col(BATCH) == SEEDED)
    assert rows(both, "order_id", "delivery") == [(40, "shop"), (41, "afternoon"), (42, "afternoon")]
    assert both.select("raw_id").distinct().count() == 3


def test_ids_follow_the_input_order(spark):
    given = spark.range(0, 1000, 1, 8).withColumn(BATCH, F.lit(FIRST))
    ids = [r["raw_id"] for r in stamp(given, F.col(BATCH)).orderBy("id").collect()]
    assert ids == sorted(ids) and len(set(ids)) == 1000
    assert ids[-1] - ids[0] == 999
    early = spark.range(1).withColumn(BATCH, F.lit(day("1969-12-31")))
    assert stamp(early, F.col(BATCH)).first()["raw_id"] < 0 <= ids[0]
    many = spark.range(0, 300_000, 1, 1 << 12).withColumn(BATCH, F.lit(FIRST))
    found = stamp(many, F.col(BATCH), taken=7).agg(F.min("raw_id"), F.max("raw_id")).first()
    assert found[1] - found[0] == 299_999 and found[0] == ids[0] + 7


def test_offsets_are_a_running_sum_over_files(spark):
    counts = [(task, f"part-{task:05}-{name}.parquet", (task * 7 + len(name)) % 11)
              for task in range(0, 4500, 3) for name in ("a", "bb")]
    given = spark.createDataFrame([(f, n) for _, f, n in counts], "file string, count long")
    found = {r["file"]: r["before"] for r in _offsets(given.repartition(7)).collect()}
    total, want = 0, {}
    for _, file, n in sorted(counts):
        want[file] = total
        total += n
    assert found == want


def test_numbering_collects_and_broadcasts_nothing_by_force(spark):
    given = spark.range(0, 1000, 1, 8).withColumn(BATCH, F.lit(FIRST))
    stamped = stamp(given, F.col(BATCH))
    assert "broadcast" not in stamped._jdf.queryExecution().analyzed().toString().lower()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:  # offsets too large to broadcast
        ids = [r["raw_id"] for r in stamp(given, F.col(BATCH)).orderBy("id").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert ids == [r["raw_id"] for r in stamped.orderBy("id").collect()]


def test_a_day_without_room_is_an_error(spark):
    given = spark.range(2).withColumn(BATCH, F.lit(FIRST))
    assert stamp(given, F.col(BATCH), taken=(1 << 47) - 2).count() == 2
    with pytest.raises(Exception, match="a day has room for"):
        stamp(given, F.col(BATCH), taken=(1 << 47) - 1).collect()


def test_a_day_beyond_the_ids_is_an_error(spark):
    given = spark.range(1)
    last, next_ = (given.withColumn(BATCH, F.lit(day(d))) for d in ("2149-06-06", "2149-06-07"))
    assert stamp(last, F.col(BATCH)).first()["raw_id"] == 65535 << 47
    with pytest.raises(Exception, match="room for days up to 2149"):
        stamp(next_, F.col(BATCH)).collect()


def test_ids_of_rows_that_a_shuffle_deals(spark, tmp_path):
    """A job that reads fewer columns of a shuffle has fewer, larger tasks."""
    deals = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    before = {name: spark.conf.get(name) for name in deals}
    try:
        for name, value in deals.items():
            spark.conf.set(name, value)
        note = F.concat_ws("", *[F.sha2(F.concat("id", F.lit(f"/{i}")), 256) for i in range(4)])
        given = spark.range(20_000).withColumn("reason", note).repartition("id").withColumn(BATCH, F.lit(FIRST))
        ids = [r["raw_id"] for r in stamp(given, F.col(BATCH)).select("raw_id", "reason").collect()]
        w = Warehouse(spark, str(tmp_path / "warehouse"))
        w.land("raw_returns", given.selectExpr("id as order_line_id", "reason", BATCH).select(
            *[F.col(f.name) if f.name in ("order_line_id", "reason") else F.lit(None).cast(f.dataType).alias(f.name)
              for f in S.RAW_RETURNS.fields if f.name not in ("raw_id", "loaded_at")], BATCH), delivery="desk")
        landed = [r["raw_id"] for r in w.read("raw_returns").collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    for found in (ids, landed):
        assert len(found) == len(set(found)) == 20_000 == max(found) - min(found) + 1


def test_failed_run_stays_out_of_sight(warehouse, frame, rows):
    before = {k: sorted(map(str, v.collect())) for k, v in views.views(warehouse.star()).items()}
    land_sales(warehouse, frame, [sale("2026-01-05", 50)])
    bad = frame(S.RAW_RETURNS, [refund(12345)], [BATCH_FIELD])
    warehouse.land("raw_returns", unnumbered(bad), delivery="desk")
    with pytest.raises(pipeline.DataQualityError):
        pipeline.append_missing(warehouse, day("2026-01-06"), RETAIL)
    assert warehouse.read("fact_orders").count() == 5
    after = {k: sorted(map(str, v.collect())) for k, v in views.views(warehouse.star()).items()}
    assert after == before


def test_spend_beyond_eight_digits(warehouse, frame, rows):
    spend = [
        {BATCH: day("2026-01-05"), "spend_date": "2026-01-05", "channel": c, "spend": 10**12 + i}
        for i, c in enumerate(("EMAIL", "email"))
    ]
    warehouse.land(
        "raw_marketing_spend", unnumbered(frame(S.RAW_MARKETING, spend, [BATCH_FIELD])), delivery="b"
    )
    pipeline.append_missing(warehouse, day("2026-01-06"), RETAIL)
    found = warehouse.star()["fact_marketing_spend"].filter("date_id = 20260105")
    assert rows(found, "spend") == [(D(2 * 10**12 + 6),)]  # with the 5 that delivery a has


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    """One day holds nearly all rows; rebalancing must not leave it to a single task."""
    w = Warehouse(spark, str(tmp_path))
    rows = spark.range(0, 200_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 100 == 0, F.lit(SEEDED)).otherwise(F.lit(FIRST)).alias(BATCH),
        F.md5(F.col("id").cast("string")).alias("reason"),
        F.col("id").alias("order_line_id"),
        F.lit("x").alias("category"),
        F.lit("2026-01-01").alias("return_date"),
        F.lit(1).alias("refund_amount"),
    )
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        w.land("raw_returns", rows.drop("id"), delivery="desk")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = [f for f in w.read("raw_returns").inputFiles() if str(FIRST) in f]
    assert len(files) > 1
    assert w.read("raw_returns").count() == 200_000


def test_shared_folder_follows_the_session(spark):
    folder = shared_folder(spark, "x")
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert folder != shared_folder(spark, "x")
    assert root is None or folder.startswith(root)


def test_csv_export_keeps_values(spark, frame, tmp_path, rows):
    awkward = frame(
        S.RAW_SALES,
        [
            {"raw_id": 1, "customer_name": 'He said "hi", then\nleft', "region": "Café 東京"},
            {"raw_id": 2, "customer_email": "", "category": None, "unit_price": 1.5},
            {"raw_id": 3, "customer_name": "  padded\\ ", "loaded_at": dt.datetime(2026, 1, 1, 2, 3, 4)},
        ],
    )
    written = export_csv({"raw": awkward}, str(tmp_path))
    assert rows(read_csv(spark, written["raw"], awkward)) == rows(awkward)
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "raw").glob("*.csv"))
    assert text.startswith("raw_id,order_id,order_date,")
    assert '"He said ""hi"", then\nleft"' in text


def test_export_covers_tables_and_views(warehouse, spark, tmp_path):
    relations = {**warehouse.star(), **warehouse.raw()}
    relations |= views.views(warehouse.star())
    written = export_csv(relations, str(tmp_path / "csv"))
    assert len(written) == 16
    assert row_counts(
        {n: read_csv(spark, p, relations[n]) for n, p in written.items()}
    ).exceptAll(row_counts(relations)).count() == 0


def test_calendar_of_the_star_has_the_declared_types(warehouse):
    loaded = warehouse.read("dim_date")
    assert loaded.dtypes == cal.calendar(loaded.select("date")).dtypes


def test_rules_are_counted_while_rows_are_staged(warehouse, frame, spark):
    """Planted faults: good rows whose facts break a rule, beside rejected ones, which may."""
    fields = "raw_id long, order_id long, customer_id long, product_id long, order_day date"
    fields += ", quantity int, unit_price decimal(10,2), discount decimal(4,3), reject_reason string"
    first, late = FIRST, day("2030-01-01")
    labelled = spark.createDataFrame(
        [
            (1, 1, 2, 9, first, 1, D("1.00"), None, None),
            (2, 1, None, 9, first, 1, D("1.00"), None, None),
            (3, 1, 2, 9, late, 1, D("1.00"), None, None),
            (4, 1, 2, 9, first, 0, D("1.00"), None, None),
            (5, 1, 2, 9, first, 1, D("-1.00"), D("0.5"), None),
            (6, None, None, None, None, -1, None, None, "unparseable_date"),
        ],
        fields,
    )
    dates = warehouse.star()["dim_date"]
    rules = pipeline._rules(pipeline.SALES)
    watched, seen = pipeline._watched(labelled, pipeline.SALES, rules, dates)
    staged = warehouse.stage("watched", watched)
    assert staged.exceptAll(labelled).count() == 0 and staged.count() == 6
    counts = {rule: seen.get[f"rule_{i}"] for i, rule in enumerate(rules)}
    assert list(counts.values()) == [1, 1, 2]
    with pytest.raises(pipeline.DataQualityError, match="1 outside the calendar, 2 with an invalid"):
        pipeline._check(warehouse, pipeline.SALES, staged, counts)
    assert quality.bad_orders(pipeline.SALES.facts(staged, [])).first()[0] == 2


def test_checksums_are_of_contents(frame, spark, tmp_path, rows):
    given = [
        {"raw_id": i, "category": c, "reason": r, "return_date": "2026-01-01", "refund_amount": a}
        for i, c, r, a in [(1, "x", "y", 10), (2, None, "", 2.5), (3, "a\x1f=b", "c", None), (3, "\\", "~", 0)]
    ]
    table = frame(S.RAW_RETURNS, given)
    (known,) = checksums({"t": table}).collect()
    assert known["rows"] == 4
    again = [table.repartition(3).orderBy(F.desc("raw_id")), table.withColumn("loaded_at", F.current_timestamp().cast("timestamp_ntz"))]
    for same in again:
        assert tuple(checksums({"t": same}).first()) == tuple(known)
    swapped = table.select(
        *[F.col({"category": "reason", "reason": "category"}.get(c, c)).alias(c) for c in table.columns]
    )
    others = [
        swapped,
        table.unionAll(table.filter("raw_id = 1")),
        table.withColumn("refund_amount", F.when(F.col("raw_id") != 1, F.col("refund_amount"))),
        table.withColumn("reason", F.nullif("reason", F.lit(""))),
        table.withColumn("refund_amount", (F.col("refund_amount") + F.lit(D("0.01"))).cast("decimal(10,2)")),
    ]
    for other in others:
        found = checksums({"t": other})
        assert found.first()["hash_a"] != known["hash_a"] and found.first()["hash_b"] != known["hash_b"]
        assert rows(unchanged(checksums({"t": table}), found)) == [("t", False)]
    assert tuple(checksums({"t": table.limit(0)}).first()) == ("t", 0, None, None)
    written = export_csv({"t": table}, str(tmp_path))
    kept = read_csv(spark, written["t"], table)
    assert rows(unchanged(checksums({"t": table}), checksums({"t": kept}))) == [("t", True)]


def test_few_days_are_written_without_a_shuffle(spark, tmp_path):
    days = [FIRST + dt.timedelta(days=i) for i in range(20)]
    w = Warehouse(spark, str(tmp_path))

    def deal(count):
        day = F.element_at(F.array(*map(F.lit, days[:count])), F.expr(f"cast(id % {count} as int) + 1"))
        rows = spark.range(0, 400, 1, 4).select(day.alias(BATCH), F.col("id").alias("raw_id"))
        for f in S.RAW_RETURNS.fields:
            if f.name not in ("raw_id", "loaded_at"):
                rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
        return rows

    def files(name):
        return [f for f in w.read("raw_returns").inputFiles() if f"delivery={name}" in f]

    w.land("raw_returns", deal(2), delivery="few", few_days=True)
    w.land("raw_returns", deal(20), delivery="many")
    assert len(files("few")) == 8  # 4 tasks, 2 days each
    assert len(files("many")) == 20
    assert w.read("raw_returns").count() == 800
    assert w.has_few_days("raw_returns", None, days[15]) and w.has_few_days("raw_returns", days[4], days[-1])
    assert not w.has_few_days("raw_returns", None, days[-1])
    assert w.has_few_days("raw_marketing_spend", None, days[-1])


def test_compressed_export_reads_back(spark, tmp_path, rows):
    table = spark.createDataFrame([(i, "a\nb" if i % 2 else "") for i in range(500)], "a int, b string")
    written = export_csv({"t": table}, str(tmp_path), compression="gzip")
    assert list((tmp_path / "t").glob("*.csv.gz"))
    assert rows(read_csv(spark, written["t"], table)) == rows(table)


def test_sales_export_shuffles_no_lines_to_people(spark, tmp_path):
    from tillmetrics.sources.market import GIVEN, Market

    for name, schema in GIVEN.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    plan = Market(spark, str(tmp_path)).raw_sales_export._jdf.queryExecution().optimizedPlan()
    lines = [x for x in plan.toString().splitlines() if "Join" in x]
    assert "order_id" in lines[1] or "product_id" in lines[0]  # people join below both
    assert not any("account_id" in x for x in lines[:2])
