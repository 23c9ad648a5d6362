"""Steps that must not follow the size of a group, a file or a whole table:
their plans, what they write and what they leave behind."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from spark_ledger.operators import identity, projection, rules, upsert
from spark_ledger.operators.versions import TableStore
from spark_ledger.session import checkpoint_dir, written
from spark_ledger.sources import files, fixtures, sinks
from spark_ledger.streaming.incremental import TRANSACTIONS, load_batch


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def folders(spark) -> set[str]:
    return {os.path.join(d, x) for d, dirs, _ in os.walk(checkpoint_dir(spark)) for x in dirs}


def test_a_load_leaves_no_tables_between_its_steps(spark, tmp_path):
    raw = tmp_path / "raw" / "bank" / "a"
    raw.mkdir(parents=True)
    (raw / "f.csv").write_text("Date,Description,Amount\n2024-01-01,tea,1\n2024-01-01,tea,1\n2024-02-01,coffee,2\n")
    written(spark.range(1))                                            # the folder of such tables is there
    before = folders(spark)
    store = TableStore(spark, str(tmp_path / "tables"))
    load_batch(files.raw_lines(spark, str(tmp_path / "raw")), store)
    assert folders(spark) == before
    assert sorted(r.description for r in store.read(TRANSACTIONS).collect()) == ["coffee", "tea"]


def test_lines_of_one_range_are_not_brought_together(spark, tmp_path):
    (tmp_path / "f.csv").write_text("n,t\n" + "".join(f"{i},x\n" for i in range(50)))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = files.parsed_lines(spark, str(tmp_path))
        assert "SortMergeJoin" not in plan(rows) and rows.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_partitioned_csv_without_sort(spark, tmp_path):
    df = spark.range(0, 4000, 1, 4).select((F.col("id") % 100).cast("string").alias("route"), "id")      # more values than open files
    key = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(key, None)
    root = str(tmp_path / "out")
    sinks.write_partitioned_csv(df, root, ["route"], fresh=True)
    assert spark.conf.get(key, None) == old
    assert spark.read.option("header", True).csv(root).select(F.col("id").cast("long")).distinct().count() == 4000
    assert all(len([f for f in os.listdir(f"{root}/route={i}") if f.endswith(".csv")]) == 1 for i in range(100))
    with pytest.raises(Exception, match="(?i)already.exists"):
        sinks.write_partitioned_csv(df, root, ["route"], fresh=True)


def test_latest_positions_are_aggregated(spark):
    d = dt.date
    pe = spark.createDataFrame([("A", "x", d(2024, 1, 1), 1.0), ("A", "x", d(2024, 3, 1), 3.0), ("A", "x", None, 9.0), ("A", "y", None, 5.0),
                                (None, "x", d(2024, 1, 1), 7.0), ("B", "x", d(2024, 1, 1), 2.0), ("B", "x", d(2024, 2, 1), None)],
                               "account_id string, symbol string, as_of_date date, value double")
    got = projection.latest_positions(pe)
    assert {(r.account_id, r.symbol): (r.as_of_date, r.value) for r in got.collect()} == {
        ("A", "x"): (d(2024, 3, 1), 3.0), ("A", "y"): (None, 5.0), (None, "x"): (d(2024, 1, 1), 7.0), ("B", "x"): (d(2024, 2, 1), None)}
    assert "Window" not in plan(got) and "SortAggregate" not in plan(got)
    dim = spark.createDataFrame([("A", "n", "g", "t", True), ("A", "n", "g", "t", None), ("A", "m", "g", "t", True), ("B", "n", "g", "t", False)],
                                "account_id string, account_name string, acct_group string, tax_bucket string, include_networth boolean")
    held = projection.acct_holdings(pe, dim)
    assert sorted(tuple(r) for r in held.collect()) == [("A", "m", "g", "t", "x", 3.0), ("A", "m", "g", "t", "y", 5.0),
                                                        ("A", "n", "g", "t", "x", 6.0), ("A", "n", "g", "t", "y", 10.0)]


def test_upsert_carries_staged_rows_once(spark):
    target = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    staging = spark.createDataFrame([("a", 5, 1), ("a", 6, 2), ("c", 7, 1), (None, 8, 1)], "k string, v int, row_idx int")
    got = upsert.upsert(target, staging, ["k"])
    assert plan(got).count("Window [row_number()") == 1                # looked at before it runs: a run adds the final plan
    assert sorted((tuple(r) for r in got.collect()), key=str) == [("a", 6), ("b", 3), ("c", 7), (None, 4), (None, 8)]


def test_sequences_without_hot_groups_write_nothing(spark, monkeypatch):
    df = spark.range(0, 3000, 1, 4).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"), (-F.col("id")).alias("o"))
    want = {}
    for r in df.orderBy("o").collect():
        want.setdefault(r.k, []).append(r.o)

    def check(rows):
        for r in rows:
            assert want[r.k][r.n - 5] == r.o
    before = folders(spark)
    got = identity.sequence_within(df, ["k"], "o", "n", base=5)
    check(got.collect())
    assert folders(spark) == before and dict(got.dtypes)["n"] == "bigint"
    monkeypatch.setattr(identity, "HOT_ROWS", 500)                     # the null group holds a third of the rows
    got = identity.sequence_within(df, ["k"], "o", "n", base=5).collect()
    assert folders(spark) != before and len(got) == 3000
    check(got)


def test_rules_by_join_take_texts_from_the_rows_before_the_dedupe(spark):
    t = spark.createDataFrame([("1", "Red bolt", 100), ("2", "red bolt", 100), ("3", "tea", 300), ("4", None, 400)],
                              "txn_id string, description string, amount_cents long").withColumn("date", F.lit("2024-01-01").cast("date"))
    r = spark.createDataFrame([("contains", "bolt", "Hardware", 1), ("regex", "^tea$", "Food", 2)],
                              "match_type string, pattern string, category string, priority int")
    kept = identity.dedupe_transactions(t)
    a, b = rules.categorize(kept, r, method="join"), rules.categorize(kept, r, method="join", texts_of=t)
    assert plan(b).count("Window [row_number()") == 1
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.columns == b.columns


def test_positions_are_dealt_once_into_tasks_that_grow_with_the_scan(spark, tmp_path):
    d = dt.datetime
    lines = [(1, 1, 2.0, 10.0, d(1995, 1, 3)), (1, 1, 3.0, 20.0, d(1995, 1, 30)), (1, 1, 1.0, 5.0, d(1995, 2, 1)), (2, 1, 1.0, 7.0, None),
             (None, 1, 1.0, 8.0, d(1995, 1, 3)), (2, None, 4.0, None, d(1995, 1, 3)), (2, 1, 1.0, 7.0, None)]
    spark.createDataFrame(lines, "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz") \
        .coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = fixtures.Tables(spark, str(tmp_path)).positions
    want = fixtures.fixture(spark, str(tmp_path), "positions")
    assert got.schema == want.schema and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    splits = spark.read.parquet(f"{tmp_path}/lineitem.parquet").rdd.getNumPartitions()
    held = plan(projection.latest_positions(got.withColumnRenamed("market_value", "value")))
    assert held.count("Exchange ") == 1 and f", {fixtures.POSITION_TASKS * splits}), REPARTITION_BY_NUM" in held


def test_selections_read_one_dedupe_of_narrow_rows(spark, tmp_path, monkeypatch):
    """filter_propagation: one dedupe, whose texts and ids go before its result is written."""
    from spark_ledger.plans import queries_context as Q
    kept, put = [], Q.written
    monkeypatch.setattr(Q, "written", lambda df: kept.append(df) or put(df))
    spark.range(1, 60).selectExpr("id AS l_orderkey", "id % 5 AS l_partkey", "id % 3 AS l_suppkey", "int(id % 4) AS l_linenumber", "double(id) AS l_extendedprice",
                                  "'N' AS l_returnflag", "timestamp'1997-03-05 00:00:00' AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(5).selectExpr("id AS p_partkey", "'hot ring' AS p_name", "'Brand#12' AS p_brand", "'ECONOMY' AS p_type").write.parquet(f"{tmp_path}/part.parquet")
    df = Q.q_filter_propagation(spark, str(tmp_path))
    assert [k.columns for k in kept] == [["date", "category", "amount_cents"]]
    assert "WindowGroupLimit" not in df._jdf.queryExecution().executedPlan().toString()
    plan = kept[0]._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(__key" in x]
    assert len(dealt) == 1 and "description" not in plan.split(dealt[0])[0] and df.count() > 0


def test_small_files_share_tasks(spark, tmp_path):
    from spark_ledger.sources import files
    for i in range(200):
        (tmp_path / f"f{i:03}.csv").write_text(f"a,b\n{i},x\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    try:
        lines = files.ordered_lines(files.raw_lines(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    # by Spark's own count of 4 MB a file, 16 MB would hold four files: 50 tasks
    assert len(lines.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism < 50 and lines.count() == 400
    assert spark.conf.get("spark.sql.files.openCostInBytes") in ("4MB", "4194304", "4194304b")


def test_amounts_of_positions_are_parsed_once_for_all_layouts(spark, tmp_path, monkeypatch):
    from spark_ledger.sources import vendors
    for vendor, text in (("chase", "Ticker,Quantity,Price,Value,Description\nP1,2,$3.00,\"1,006.00\",Fund\n"),
                         ("alight", "Fund Name,Units Held,Unit Price,Closing Balance\nBig Fund,,,(7.50)\n"),
                         ("fidelity", "Symbol,Description,Quantity,Last Price,Current Value\n,My fund,2,4,\n")):
        (tmp_path / "raw" / vendor / "r").mkdir(parents=True)
        (tmp_path / "raw" / vendor / "r" / "2024-01-31-positions.csv").write_text(text)
    calls, parse = [], vendors.parse_money
    monkeypatch.setattr(vendors, "parse_money", lambda c: calls.append(1) or parse(c))
    got = vendors.normalize_positions(spark, str(tmp_path / "raw"))
    assert len(calls) == 3
    assert {(r["vendor"], r["symbol"], r["shares"], r["market_value"]) for r in got.collect()} == {
        ("chase", "P1", 2.0, 1006.0), ("alight", "BIG_FUND", -7.5, -7.5), ("fidelity", "MY_FUND", 2.0, 8.0)}


def test_tables_on_the_way_to_a_result_go_once_it_is_written(spark, tmp_path):
    import os

    from spark_ledger.session import only_result, scratch, written
    folder = lambda df: os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    seen = []

    def make():
        seen.append(folder(a := written(spark.range(5))))
        return a.selectExpr("id + 1 AS id")
    with scratch(spark):
        out = only_result(spark, make)
        assert not os.path.exists(seen[0]) and sorted(r[0] for r in out.collect()) == [1, 2, 3, 4, 5]
        seen.append(folder(out))
        assert os.path.exists(seen[1])
    assert not os.path.exists(seen[1])
