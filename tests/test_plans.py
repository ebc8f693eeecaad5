"""Plans have to stay the ones that hold at scale."""

import pytest
from pyspark.sql import functions as F

from ledgerspark.jobs.rebuild import DIMENSIONS, FACTS
from ledgerspark.operators.dedup import exact_dedup, keep_first
from ledgerspark.plans import facts, profile, queries, views
from ledgerspark.sources.tables import replace_partitions, write_table
from verification.ledger_data import AS_OF, LedgerData
from verification.registry import queries_by_name


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def data(spark, sf_dir):
    return LedgerData(spark, sf_dir)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def stored(spark, data, tmp_path):
    """Warehouse read from files, as reports see it in production."""
    from ledgerspark.plans.warehouse import Warehouse

    built = data.warehouse()
    for name in (*DIMENSIONS, *FACTS):
        by = [] if name == "dim_date" else ["source_folder"]
        built.table(name).write.partitionBy(*by).parquet(str(tmp_path / name))
    return Warehouse(spark, lambda name: spark.read.parquet(str(tmp_path / name)).select(*built.table(name).columns))


@pytest.mark.parametrize("name", sorted(queries_by_name()))
def test_no_query_has_a_cross_join_or_an_unpartitioned_window(spark, sf_dir, name):
    if name in ("read_write_table", "incremental_rebuild"):  # these write when called
        return
    text = plan(queries_by_name()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "SinglePartition" not in text or "Window" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_reports_do_not_shuffle_lines_to_join_customers(spark, data, tmp_path, no_broadcast):
    """With size-based broadcasts off, only the bounded internal keys are broadcast, and
    lines are aggregated before anything is joined to them."""
    wh = stored(spark, data, tmp_path)
    for view in (views.sales_summary, views.today_sales, views.company_overview, views.customer_ltv):
        text = plan(view(wh))
        lines = text.splitlines()
        scan = next(i for i, row in enumerate(lines) if "FileScan" in row and "line_amount" in row)
        above = [row for row in lines[:scan] if "Exchange hashpartitioning" in row or "HashAggregate" in row]
        assert "HashAggregate" in above[-1], text


def test_top_k_is_taken_before_names_are_joined(spark, data, tmp_path, no_broadcast):
    wh = stored(spark, data, tmp_path)
    for query in (queries.top_customers, queries.top_products, queries.customer_ltv):
        text = plan(query(wh))
        assert text.count("TakeOrderedAndProject") == 2
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_unused_lookups_disappear(spark, data):
    products = plan(views.top_products(data.warehouse()))
    assert "c_custkey" not in products  # no customer attribute is needed to rank products


def test_scans_read_only_what_they_need(spark, data):
    text = plan(views.cash_flow(data.warehouse()))
    assert "props" not in text.split("ReadSchema: ")[1].split(">")[0]


def test_hot_keys_are_split_by_the_skew_join(spark, data, no_broadcast):
    """One customer holds most lines: the join that meets it must split that partition."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        wh = data.warehouse()
        hot = data.sales2().repartition(8).withColumn("cuscode", F.when(F.col("invno") % 3 > 0, "7").otherwise(F.col("cuscode")))
        hot = hot.withColumn("_source_folder", F.when(F.col("cuscode") == "7", "ZF2526").otherwise(F.col("_source_folder")))
        fact = facts.fact_sales(hot, data.sales1(), wh.dim_customer, wh.dim_product)
        fact = fact.select("customer_key", "line_amount")
        assert len(fact.collect()) >= data.sales2().count()
        text = plan(fact)
        assert "SortMergeJoin(skew=true)" in text[: text.index("Initial Plan")], text
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_deduplication_combines_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("_seq"), F.lit("x").alias("v"))
    for text in (plan(keep_first(df, ["k"], "_seq")), plan(exact_dedup(df, ["k", "v"], "_seq"))):
        assert "partial_min" in text and text.index("Exchange") < text.index("partial_min")


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([("A", 1), ("B", 2)], "f string, v int"), path, ["f"])
    replace_partitions(spark.createDataFrame([("B", 3)], "f string, v int"), path, ["f"])
    assert sorted((r.f, r.v) for r in spark.read.parquet(path).collect()) == [("A", 1), ("B", 3)]


def test_slow_moving_aggregates_sales_before_the_join(spark, data, tmp_path, no_broadcast):
    text = plan(views.slow_moving(stored(spark, data, tmp_path), AS_OF))
    assert text.index("Join") < text.index("HashAggregate")


def test_samples_are_a_top_k_of_each_folder(spark, data):
    text = plan(profile.sample_rows(data.trans()))
    assert text.count("TakeOrderedAndProject") == 3 and "Sort [" not in text and "Window" not in text


def test_dimensions_sort_no_rows(spark, data):
    for table in (data.warehouse().dim_customer, data.warehouse().dim_product):
        text = plan(table)
        assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_transactions_rank_once_and_shuffle_no_dimension(spark, data, tmp_path, no_broadcast):
    text = plan(queries.transactions(stored(spark, data, tmp_path)))
    assert text.count("TakeOrderedAndProject") == 2 and "SortMergeJoin" not in text
    assert len([row for row in text.splitlines() if "FileScan" in row and "voucher_no" in row]) == 1
    assert "Exchange hashpartitioning" not in text


def test_a_lookup_reads_few_rows_of_a_sorted_file(spark, tmp_path):
    lines = spark.range(300_000).selectExpr("'F' AS f", "CAST((id * 7919) % 300000 AS STRING) AS invoice_no", "id AS v")
    read = {}
    for name, sort in (("sorted", ["invoice_no"]), ("as_is", [])):
        write_table(lines, str(tmp_path / name), ["f"], sort_by=sort)
        found = spark.read.parquet(str(tmp_path / name)).filter("invoice_no = '77777'")
        assert found.count() == 1
        done = found._jdf.queryExecution().executedPlan()
        found._jdf.collectAsList()
        metrics = [m for m in _scans(done)]
        read[name] = sum(metrics)
    assert read["sorted"] <= 40_000 < 250_000 < read["as_is"]


def _scans(node):
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from _scans(node.executedPlan())
    elif name.startswith("Scan parquet"):
        yield node.metrics().apply("numOutputRows").value()
    else:
        children = node.children()
        for i in range(children.size()):
            yield from _scans(children.apply(i))


def test_a_heavy_number_is_dealt_to_many_tasks(spark, data):
    """A number with 300 headers and lines, some others with several, one without lines."""
    headers = spark.range(300).selectExpr("'A' AS F", "7 AS n", "CAST(id AS INT) AS h").union(spark.range(40).selectExpr("'A'", "id % 20", "CAST(id AS INT)"))
    headers = headers.union(spark.range(3).selectExpr("'B'", "7", "CAST(id AS INT)"))
    headers = headers.selectExpr("F AS _source_folder", "CAST(n AS DECIMAL(18,0)) AS invnoebg", "'SI' AS invtypebg", "date_add(DATE'2025-01-01', h) AS invdatebg")
    raw = data.sales2().limit(1).drop("invno", "_source_folder", "amount")
    numbers = spark.range(300).selectExpr("'A' AS _source_folder", "CAST(7 AS DECIMAL(18,0)) AS invno", "CAST(id AS DECIMAL(18,2)) AS amount")
    numbers = numbers.union(spark.range(60).selectExpr("'A'", "CAST(id % 30 AS DECIMAL(18,0))", "CAST(id AS DECIMAL(18,2))")).union(spark.range(5).selectExpr("'B'", "CAST(7 AS DECIMAL(18,0))", "CAST(id AS DECIMAL(18,2))"))
    lines, wh = numbers.crossJoin(raw), data.warehouse()
    heavy = facts.heavy_numbers(lines, headers, rows=1000)
    assert [tuple(r) for r in heavy.collect()] == [("A", 7, 92)]
    load = {(r._source_folder, int(r.invno)): r.n_rows for r in facts.header_load(lines, headers).collect()}
    assert load["A", 7] == 302 * 302 and load["B", 7] == 15 and ("A", 25) not in load
    fixed = spark.createDataFrame(heavy.collect(), heavy.schema)
    plain = facts.fact_sales(lines, headers, wh.dim_customer, wh.dim_product)
    spread = facts.fact_sales(lines, headers, wh.dim_customer, wh.dim_product, heavy=fixed)
    pick = ["source_folder", "invoice_no", "invoice_date", "line_amount"]
    assert plain.schema == spread.schema and plain.count() == spread.count()
    assert plain.select(*pick).exceptAll(spread.select(*pick)).isEmpty()
    held = spread.filter("source_folder = 'A' AND invoice_no = '7'").groupBy(F.spark_partition_id()).count().collect()
    assert len(held) > 1 and max(r["count"] for r in held) < 60_000


def _placed_sales(spark, **options):
    """Lines joined by their number: with and without headers, of other folders and types, with codes that no dimension has or none."""
    lines = spark.createDataFrame(
        [(1, "A", "c1", "i1", 10), (1, "A", "c1", "zz", 11), (1, "B", "c1", "i1", 12), (2, "A", None, "i1", 13), (2, "A", "zz", None, 14), (3, "A", "c2", "i2", 15), (9, "A", "c1", "i1", 16), (9, "A", "c1", "i1", 16)],
        "n bigint, f string, cuscode string, itemcode string, amount int",
    )
    amounts = lines.select(F.col("n").cast("decimal(18,0)").alias("invno"), "itemcode", F.col("cuscode").alias("c"), "amount", F.lit("SI").alias("invtype"))
    owners = lines.select(F.col("n").cast("decimal(18,0)").alias("o"), F.col("f").alias("_source_folder"), F.col("cuscode").alias("cuscode"), F.col("amount").alias("a")).distinct()
    joined = amounts.join(owners.hint("shuffle_hash"), F.col("invno") == F.col("o")).filter("a = amount").drop("o", "a", "c")
    headers = spark.createDataFrame(
        [("A", 1, "SI", "2025-01-01"), ("A", 1, "SI", "2025-01-02"), ("A", 1, "CN", "2025-01-03"), ("B", 2, "SI", "2025-01-04"), ("A", 3, None, "2025-01-05"), ("A", None, "SI", "2025-01-06")],
        "_source_folder string, n int, invtypebg string, d string",
    ).select("_source_folder", F.col("n").cast("decimal(18,0)").alias("invnoebg"), "invtypebg", F.col("d").cast("date").alias("invdatebg"))
    customers = spark.createDataFrame([("A|c1", "A", "c1"), ("A|c2", "A", "c2")], "customer_key string, source_folder string, ledger_code string")
    items = spark.createDataFrame([("A|i1", "A", "i1"), ("B|i1", "B", "i1"), ("A|i2", "A", "i2")], "product_key string, source_folder string, item_code string")
    return facts.fact_sales(joined, headers, customers, items, **options)


@pytest.mark.parametrize("match_type", [False, True])
def test_lines_that_stay_in_place_find_the_same(spark, match_type, no_broadcast):
    """Headers and absent codes that come to the lines give the rows of the plain joins."""
    plain = _placed_sales(spark, match_type=match_type)
    rows = sorted(plain.collect(), key=str)
    assert len(rows) == (10 if match_type else 12)
    for whole in (False, True):
        placed = _placed_sales(spark, match_type=match_type, placed=True, whole=whole)
        assert placed.schema.simpleString() == plain.schema.simpleString()
        assert sorted(placed.collect(), key=str) == rows


def test_whole_sales_are_shuffled_once(spark, sf_dir, no_broadcast):
    """Above the scan of the lines there is one exchange, that of their first join."""
    for name in ("fact_sales", "fact_sales_match_type"):
        rows = plan(queries_by_name()[name](spark, sf_dir)).splitlines()
        scan = next(i for i, row in enumerate(rows) if "FileScan" in row and "l_quantity" in row)
        assert len([row for row in rows[:scan] if "Exchange" in row]) == 1, "\n".join(rows[:scan])


def test_narrow_sales_meet_their_headers_in_place(spark, sf_dir, no_broadcast):
    """The lines are shuffled for their own join and for the products, not for the headers."""
    rows = plan(queries_by_name()["slow_moving"](spark, sf_dir)).splitlines()
    scan = next(i for i, row in enumerate(rows) if "FileScan" in row and "l_partkey" in row)
    joins = [row for row in rows[:scan] if "Join [invno" in row]
    assert len(joins) == 2 and all("ShuffledHashJoin" in row for row in joins)
    below = rows[next(i for i, row in enumerate(rows) if "Join [invno" in row) : scan]
    assert len([row for row in below if "Exchange" in row]) == 1
