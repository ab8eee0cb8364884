import datetime
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from patronscope.operators import cleaning
from patronscope.sources import tables, transactions
from patronscope.streaming import refresh

SCHEMA = "invoice string, stock_code string, description string, quantity int, invoice_date timestamp_ntz, unit_price double, customer_id string, country string"


def line(i, day, code="P00001", customer="7"):
    return (str(i), code, "lamp", 2, datetime.datetime(2023, 1, 1) + datetime.timedelta(days=day, hours=9), 1.5, customer, "France")


def test_three_naming_styles_conform(spark):
    df = spark.createDataFrame([("1", "2", 3.0)], "`Customer ID` string, InvoiceNo string, TotalAmount double")
    assert transactions.conform_columns(df).columns == ["customer_id", "invoice", "total_amount"]


def test_ids_stay_text_in_csv(spark, tmp_path):
    (tmp_path / "in.csv").write_text("invoice,stock_code,description,quantity,invoice_date,unit_price,customer_id,country\n"
                                     "C0012,00012,x,1,2023-01-01 10:00:00,1.5,0017,France\n")
    row = transactions.read_transactions(spark, str(tmp_path / "in.csv"), "csv").first()
    assert (row["invoice"], row["stock_code"], row["customer_id"]) == ("C0012", "00012", "0017")


def test_unreadable_dates_are_dropped(spark):
    df = spark.createDataFrame([("1", "2023-01-01 10:00:00"), ("2", "soon"), (None, "2023-01-01")], "customer_id string, invoice_date string")
    rows = transactions.normalise_dates(df).collect()
    assert [(r["customer_id"], r["invoice_date_text"]) for r in rows] == [("1", "2023-01-01 10:00:00")]


def test_partition_refresh_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "p string, v long")
    tables.overwrite_partitions(df, path, ["p"])
    for _ in range(2):
        tables.overwrite_partitions(spark.createDataFrame([("b", 9)], "p string, v long"), path, ["p"])
    assert sorted((r["p"], r["v"]) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 9)]


def test_first_existing_stage_wins(spark, tmp_path):
    tables.stage_table(spark.range(3), str(tmp_path / "b"))
    assert tables.read_intermediate(spark, str(tmp_path / "a"), str(tmp_path / "b")).count() == 3
    with pytest.raises(FileNotFoundError):
        tables.read_intermediate(spark, str(tmp_path / "a"))


def drop_file(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_stream_cleans_and_drops_repeats_over_restarts(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    drop_file(spark, source, [line(1, 0), line(1, 0), line(2, 0, code="POST"), line(3, 1)])
    refresh.refresh_lines(refresh.raw_stream(spark, source), out, mark)
    assert spark.read.parquet(out).count() == 2
    drop_file(spark, source, [line(3, 1), line(4, 2), line(5, 2, customer=None)])
    refresh.refresh_lines(refresh.raw_stream(spark, source), out, mark)
    got = sorted(r["invoice"] for r in spark.read.parquet(out).collect())
    assert got == ["1", "3", "4"]


def parquet_files(folder):
    return {str(p.relative_to(folder)) for p in Path(folder).rglob("*.parquet")}


def test_stream_keeps_lines_of_any_lateness(spark, tmp_path):
    """Files arrive in reverse order of their dates, over several batches; no line is dropped, no repeat is kept."""
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for i, day in enumerate((900, 400, 100, 0)):
        drop_file(spark, source, [line(10 * i, day), line(10 * i + 1, day), line(10 * i, day), line(0, 900)])
        time.sleep(0.02)  # the source takes files by age
    refresh.refresh_lines(refresh.raw_stream(spark, source, 1), out, mark)
    assert sorted(int(r["invoice"]) for r in spark.read.parquet(out).collect()) == [0, 1, 10, 11, 20, 21, 30, 31]
    before = parquet_files(out)
    drop_file(spark, source, [line(11, 400), line(99, 400), line(0, 900)])
    refresh.refresh_lines(refresh.raw_stream(spark, source, 1), out, mark)
    added = parquet_files(out) - before
    assert before <= parquet_files(out) and {f.split("/")[0] for f in added} == {"day=2024-02-05"}
    assert spark.read.parquet(out).count() == 9
    refresh.merge_lines(spark.read.schema(transactions.RAW_SCHEMA).parquet(source), out)  # the same lines again
    assert spark.read.parquet(out).count() == 9


def test_a_refresh_writes_a_day_once_for_all_its_batches(spark, tmp_path):
    """Each batch has lines of every day; a sink that is read and written batch by batch costs the square of their number."""
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for i in range(5):
        drop_file(spark, source, [line(i, 0), line(i, 1), line(99, 1)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else tasks this small become one
    try:
        refresh.refresh_lines(refresh.raw_stream(spark, source, 1), out, mark)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list(Path(mark, "commits").glob("[0-9]*"))) == 5
    assert sorted(f.split("/")[0] for f in parquet_files(out)) == ["day=2023-01-01", "day=2023-01-02"]
    assert spark.read.parquet(out).count() == 11 and not parquet_files(Path(mark))


def test_a_refresh_that_failed_is_made_good_by_the_next(spark, tmp_path, monkeypatch):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    run = lambda: refresh.refresh_lines(refresh.raw_stream(spark, source, 1), out, mark)
    invoices = lambda: sorted(r["invoice"] for r in spark.read.parquet(out).collect())
    Path(source).mkdir()
    run()  # nothing has arrived
    assert not Path(out).exists()
    drop_file(spark, source, [line(1, 0), line(2, 1)])
    with monkeypatch.context() as m:
        m.setattr(refresh, "_add_lines", lambda lines, path: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    drop_file(spark, source, [line(1, 0), line(3, 1)])
    with monkeypatch.context() as m:
        m.setattr(refresh, "remove", lambda spark, path: None)
        run()
    assert invoices() == ["1", "2", "3"]
    run()  # what was put aside is there still, and is in the sink already
    assert invoices() == ["1", "2", "3"] and not parquet_files(Path(mark))


def test_days_and_lines_of_very_many_copies_go_to_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(refresh, "DAY_LINES", 10)
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    blank = (*line(70, 0)[:2], None, *line(70, 0)[3:7], None)
    undated = (*line(80, 0)[:4], None, *line(80, 0)[5:])
    drop_file(spark, source, [*(line(i, 0) for i in range(60)), *[line(99, 1)] * 50, line(3, 2), blank, blank, undated, undated])
    wanted = [*map(str, range(60)), "70", "80", "99", "3"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else tasks this small become one
    try:
        refresh.refresh_lines(refresh.raw_stream(spark, source, 1), out, mark)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["invoice"] for r in spark.read.parquet(out).collect()) == sorted(wanted)
    files = lambda day: len([f for f in parquet_files(out) if f"day={day}/" in f])
    assert files("2023-01-01") > 1 and [files(d) for d in ("2023-01-02", "2023-01-03", "none")] == [1, 1, 1]
    drop_file(spark, source, [line(100, 0), line(3, 2), blank, undated])
    refresh.refresh_lines(refresh.raw_stream(spark, source, 1), out, mark)
    assert sorted(r["invoice"] for r in spark.read.parquet(out).collect()) == sorted([*wanted, "100"])


def test_stream_revenue_touches_arriving_months_only(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    rows = lambda: {r["day"]: (r["lines"], r["revenue"]) for r in refresh.daily_revenue(spark, out).collect()}
    drop_file(spark, source, [line(1, 0), line(2, 0), line(2, 0), line(3, 40), line(9, 3, code="POST")])
    refresh.refresh_revenue(refresh.raw_stream(spark, source), out, mark)
    assert rows() == {"2023-01-01": (3, 9.0), "2023-02-10": (1, 3.0)}
    before = parquet_files(out)
    late = [line(4, 0), line(5, 80)]  # the first of them for a day that is written
    drop_file(spark, source, late)
    refresh.refresh_revenue(refresh.raw_stream(spark, source), out, mark)
    wanted = {"2023-01-01": (4, 12.0), "2023-02-10": (1, 3.0), "2023-03-22": (1, 3.0)}
    assert rows() == wanted
    assert {f.split("/")[0] for f in before & parquet_files(out)} == {"month=2023-02"}  # not rewritten
    # A batch that is tried again: one of its days was replaced before the failure, the other was not.
    again = spark.createDataFrame(late, SCHEMA)
    refresh.merge_revenue(again.where("invoice = '4'"), 7, out)
    refresh.merge_revenue(again, 7, out)
    refresh.merge_revenue(again, 7, out)
    assert rows() == wanted | {"2023-01-01": (5, 15.0), "2023-03-22": (2, 6.0)}


def test_a_refresh_reads_the_arriving_days_only(spark, tmp_path):
    sink = spark.createDataFrame([(i, f"2023-01-{i + 1:02d}") for i in range(20)], "v long, day string")
    sink.write.partitionBy("day").parquet(str(tmp_path / "s"))
    touched = refresh._touched(spark.read.schema("v long, day string").parquet(str(tmp_path / "s")), sink.where("v = 4 OR v = 9"), "day")
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day" in plan and sorted(r["v"] for r in touched.collect()) == [4, 9]
    assert {Path(f).parent.name for f in (r[0] for r in touched.select(F.input_file_name()).collect())} == {"day=2023-01-05", "day=2023-01-10"}


def test_csv_export_is_read_back_with_the_options_it_was_written_with(spark, tmp_path):
    from types import SimpleNamespace

    from patronscope.plans import catalog

    customers = spark.createDataFrame([(1, 'a"b,c'), (2, ""), (3, None), (4, " x ")], "customer_id long, country string")
    space = SimpleNamespace(spark=spark, customers=customers, stage=tables.Stage(spark, str(tmp_path)))
    got = catalog.QUERIES["write_tables_csv"](space).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, customers.collect()))


def test_csv_keeps_blanks_quotes_and_nulls(spark, tmp_path):
    from patronscope.sources import tables, transactions

    rows = [(" a ", 1), ("  ", 2), ("", 3), (None, 4), ('say "hi", twice', 5)]
    tables.write_tables({"t": spark.createDataFrame(rows, "s string, i int")}, str(tmp_path / "c"), "csv")
    back = spark.read.schema("s string, i int").options(**transactions.CSV_READ).csv(str(tmp_path / "c/t"))
    assert sorted(map(tuple, back.collect()), key=lambda r: r[1]) == rows


def test_pushdown_and_pruning_reach_the_scan(w):
    df = w.transactions.where("quantity > 10").select("customer_id", "total_amount")
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PushedFilters" in plan and "LessThanOrEqual(total_amount" in plan
    schema = plan.split("ReadSchema:")[1]
    assert "description" not in schema and "country" not in schema


def test_shared_aggregates_have_no_customer_window(w):
    for df in (cleaning.customers_dim(w.valid), cleaning.products_dim(w.lines)):
        assert "Window" not in df._jdf.queryExecution().executedPlan().toString()
    assert w.summary.where(F.col("total_orders") < 1).count() == 0


def test_a_second_stage_leaves_the_files_of_the_first(spark):
    from patronscope.sources.tables import Stage

    first, second = Stage(spark, "twice"), Stage(spark, "twice")
    kept = first.table("rows", lambda: spark.range(3).toDF("n"))
    assert second.table("rows", lambda: spark.range(5).toDF("n")).count() == 5 and kept.count() == 3
    path = second.path("rows")
    del second
    assert Stage(spark, "twice").path("rows") == path
