"""Fact builders: raw tables of all folders, left-joined to headers and dimensions.

The joins carry no hints. Dimension sides are cut to their key columns, so a dimension
that is small by its real size is broadcast by the planner; beyond that the join is a
sort-merge join, and a customer, item or invoice that holds a large share of the lines
is split by the adaptive skew join, which may split the left side of a left join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspark.functions.flags import natural_key, rounded_int
from ledgerspark.operators.dedup import keep_first
from ledgerspark.schemas import (
    FACT_FINANCE,
    FACT_RECEIVABLES,
    FACT_SALES,
    FACT_SALES_HEADER,
    conform,
)

# Rows of one number's join that a task may make; numbers beyond that are dealt into shares.
HEAVY_ROWS = 1_000_000
# Heavy numbers handled so at most (the worst; a broadcast), and shares of one number.
MOST_HEAVY, MOST_SHARES = 10_000, 4_096


def _keyed(raw: DataFrame, dim: DataFrame, raw_code: str, dim_code: str, dim_key: str, out: str) -> DataFrame:
    """Add the dimension key of ``raw_code`` as ``out``, NULL where the dimension lacks it.

    The lookup is an aggregate over the key's parts, of which a dimension has each once. It
    tells the planner that a row matches once, so that a lookup nobody reads is removed.
    Comparing the key as well as its parts is redundant for the result: the aggregate's
    partitioning then no longer fits the join, which puts a shuffle right below each side,
    and only such a join can have a hot key split.
    """
    lookup = dim.groupBy(F.col("source_folder").alias("_dim_folder"), F.col(dim_code).alias("_dim_code")).agg(F.min(dim_key).alias(out))
    matches = (
        (F.col("_source_folder") == F.col("_dim_folder"))
        & (F.col(raw_code) == F.col("_dim_code"))
        & (natural_key("_source_folder", raw_code) == F.col(out))
    )
    return raw.join(lookup, matches, "left").drop("_dim_folder", "_dim_code")


def _keyed_in_place(raw: DataFrame, lines: DataFrame, dim: DataFrame, raw_code: str, dim_code: str, dim_key: str, out: str) -> DataFrame:
    """As :func:`_keyed`, for rows that lie by ``invno``: they stay, and codes move.

    What a row needs to know is whether the dimension lacks its code, as the key is made of
    folder and code. So the rows' numbers and codes alone meet the dimension's, and only codes
    that it lacks come back to the rows, gathered by number.
    """

    def pair(folder: str, code: str) -> Column:
        return F.struct(F.col(folder).alias("folder"), F.col(code).alias("code"))

    used = lines.filter(F.col(raw_code).isNotNull()).select(F.col("invno").alias("_number"), F.col("_source_folder").alias("_used_folder"), F.col(raw_code).alias("_used_code"))
    known = dim.filter(natural_key("source_folder", dim_code) == F.col(dim_key)).select(F.col("source_folder").alias("_dim_folder"), F.col(dim_code).alias("_dim_code"))
    lacked = used.join(known, (F.col("_used_folder") == F.col("_dim_folder")) & (F.col("_used_code") == F.col("_dim_code")), "left_anti")
    absent = lacked.groupBy("_number").agg(F.collect_set(pair("_used_folder", "_used_code")).alias("_absent"))
    found = raw.join(absent.hint("shuffle_hash"), F.col("invno") == F.col("_number"), "left")
    lacks = F.coalesce(F.array_contains("_absent", pair("_source_folder", raw_code)), F.lit(False))
    return found.withColumn(out, F.when(~lacks, natural_key("_source_folder", raw_code))).drop("_absent", "_number")


def _with_customer(raw: DataFrame, dim_customer: DataFrame, code: str, out: str = "customer_key") -> DataFrame:
    return _keyed(raw, dim_customer, code, "ledger_code", "customer_key", out)


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _line_keys(match_type: bool) -> dict[str, str]:
    """Line columns that a header has to match, and the header's columns."""
    return {"_source_folder": "_source_folder", "invno": "invnoebg"} | ({"invtype": "invtypebg"} if match_type else {})


def header_load(lines: DataFrame, headers: DataFrame, match_type: bool = False) -> DataFrame:
    """Numbers with several headers that lines use: ``_source_folder``, ``invno`` (``invtype``),
    ``n_headers``, ``n_lines`` and ``n_rows``, the rows that their join makes.

    Two aggregates over keys, and only the lines of such numbers enter the second.
    """
    keys = _line_keys(match_type)
    several = headers.groupBy(*[F.col(h).alias(k) for k, h in keys.items()]).agg(F.count("*").alias("n_headers")).filter("n_headers > 1")
    used = lines.join(several, list(keys), "left_semi").groupBy(*keys).agg(F.count("*").alias("n_lines"))
    return used.join(several, list(keys)).select(*keys, "n_headers", "n_lines", (F.col("n_headers") * F.col("n_lines")).alias("n_rows"))


def heavy_numbers(lines: DataFrame, headers: DataFrame, match_type: bool = False, rows: int = HEAVY_ROWS, most: int = MOST_HEAVY) -> DataFrame:
    """The numbers, at most ``most``, whose lines and headers make more than ``rows`` rows, and
    into how many shares (``shares``) their lines have to be dealt to make about that many each."""
    load = header_load(lines, headers, match_type).filter(F.col("n_rows") > rows)
    shares = F.least(F.ceil(F.col("n_rows") / rows), F.col("n_lines"), F.lit(MOST_SHARES)).cast("int")
    worst = load.orderBy(F.desc("n_rows"), *_line_keys(match_type)).limit(most)
    return worst.select(*_line_keys(match_type), shares.alias("shares"))


def _dealt(lines: DataFrame, header: DataFrame, keys: list[str], heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines of heavy numbers dealt into shares, and their headers copied for each share."""
    heavy = F.broadcast(heavy)  # at most MOST_HEAVY rows
    share = F.when(F.col("shares").isNull(), 0).otherwise(F.pmod(F.xxhash64(*lines.columns), F.col("shares")))
    parted = lines.join(heavy, keys, "left").withColumn("_share", share.cast("int")).drop("shares")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("shares"), F.lit(1)) - 1))
    named = heavy.select(*[F.col(k).alias(f"_heavy{i}") for i, k in enumerate(keys)], "shares")
    same = [F.col(f"_head{k}") == F.col(f"_heavy{i}") for i, k in enumerate(keys)]
    copied = header.join(named, same, "left").withColumn("_head_share", copies).drop("shares", *[f"_heavy{i}" for i in range(len(keys))])
    return parted, copied


def fact_sales(
    lines: DataFrame,
    headers: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    match_type: bool = False,
    heavy: DataFrame | None = None,
    placed: bool = False,
    whole: bool = False,
) -> DataFrame:
    """One row per invoice line and matching header.

    A line matches headers by folder and number alone, so a number used by several
    headers repeats the line; ``match_type`` also compares the invoice type. ``heavy``, from
    :func:`heavy_numbers`, spreads numbers with very many lines and headers over tasks: the
    skew join splits partitions by what they read, not by the rows that they make.

    ``placed`` says that a shuffled join by ``invno`` alone has made the lines, so none is
    without a number. The headers are then brought to them, a number's few rows that are
    hashed, and the lines are not shuffled again; a number's rows have come together before,
    so there is no skew left to split. With ``whole`` the lookups leave the lines where they
    are, too. That pays if all columns are read: codes make a second, narrow pass.
    """
    keys = _line_keys(match_type)
    header = headers.select(*[F.col(h).alias(f"_head{k}") for k, h in keys.items()], F.col("invdatebg").alias("_head_date"))
    matches = [F.col(k) == F.col(f"_head{k}") for k in keys]
    placed = placed and heavy is None
    if heavy is not None:
        lines, header = _dealt(lines, header, list(keys), heavy)
        matches.append(F.col("_share") == F.col("_head_share"))
    elif placed:
        # The planner leaves rows where they lie only if the number is the one equality.
        header = header.repartition("_headinvno").hint("shuffle_hash")
        matches = [F.col(k) == F.col(f"_head{k}") if k == "invno" else F.col(k).between(F.col(f"_head{k}"), F.col(f"_head{k}")) for k in keys]
    dated = lines.join(header, matches, "left")
    lookups = [(dim_customer, "cuscode", "ledger_code", "customer_key"), (dim_product, "itemcode", "item_code", "product_key")]
    keyed = dated
    for dim, code, dim_code, key in lookups:
        if placed and whole:
            keyed = _keyed_in_place(keyed, lines, dim, code, dim_code, key, key)
        else:
            keyed = _keyed(keyed, dim, code, dim_code, key, key)
    return conform(
        keyed,
        FACT_SALES,
        {
            "source_folder": "_source_folder",
            "invoice_no": _text("invno"),
            "invoice_date": "_head_date",
            "invoice_type": "invtype",
            "rep_code": "repcode",
            "quantity": "qty",
            "rate": "itemrate",
            "discount_pct": "discount",
            "discount_amt": "disamt",
            "line_amount": "amount",
            "batch_no": "batchno",
        },
    )


def fact_sales_header(headers: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """One row per (folder, number, type), the first in source order; headers without a
    number or type are all kept."""
    first = keep_first(headers, ["_source_folder", "invnoebg", "invtypebg"], "_seq", distinct_nulls=True)
    return conform(
        _with_customer(first, dim_customer, "cuscodebg"),
        FACT_SALES_HEADER,
        {
            "source_folder": "_source_folder",
            "invoice_no": _text("invnoebg"),
            "invoice_date": "invdatebg",
            "invoice_type": "invtypebg",
            "bill_amount": "billamtg",
            "tax_amount": "taxamtng",
            "round_off": "roundoffg",
            "total_amount": "totaliong",
            "transport": "transportg",
            "due_days": rounded_int(F.col("duedaysg")),
        },
    )


def fact_finance(vouchers: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return conform(
        _with_customer(vouchers, dim_customer, "codee", "ledger_key"),
        FACT_FINANCE,
        {
            "source_folder": "_source_folder",
            "voucher_no": _text("vounoe"),
            "voucher_date": "voudate",
            "narration": "naration",
            "debit_credit": "drcrate",
            "amount": "vou_amt",
            "rep_code": "repcode",
        },
    )


def fact_receivables(adjustments: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return conform(
        _with_customer(adjustments, dim_customer, "cuscode"),
        FACT_RECEIVABLES,
        {
            "source_folder": "_source_folder",
            "voucher_no": _text("vouno"),
            "voucher_date": "voudate",
            "voucher_amount": "vou_amt",
            "bill_adjusted": "billadj",
            "bill_amount": "billamt",
            "ref_invoice_no": _text("invno"),
        },
    )
