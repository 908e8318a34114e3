"""Invoice lines from an order schema (lineitem, orders, customer, part).

The supplied tables hold no invoices, so order lines stand in for them. All amounts are whole and all rates are
multiples of a power of two: their sums are exact in double arithmetic, so results cannot depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.sources.readers import with_file_order

# How market segments and order priorities map to payers and visit groups. Two segments and three
# priorities keep their own names, so that known and unknown payers both occur.
PAYER_BY_SEGMENT = {"AUTOMOBILE": "Aetna", "BUILDING": "Medicare", "MACHINERY": "Cigna"}
GROUP_BY_PRIORITY = {"1-URGENT": "New E/M Code", "2-HIGH": "Existing E/M Code"}


def _mapped(c, mapping):
    out = c
    for value, name in mapping.items():
        out = F.when(c == value, name).otherwise(out)
    return out


def _steps(c, n):
    """Round down to a multiple of 1/n."""
    return F.floor(c * n).cast("double") / n


def invoice_lines(spark: SparkSession, folder: str, row_id: bool = False) -> DataFrame:
    """One row per order line. ``row_id=True`` adds the line's position in its file."""
    item = spark.read.parquet(f"{folder}/lineitem.parquet")
    if row_id:
        item = with_file_order(item)
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    part = spark.read.parquet(f"{folder}/part.parquet")
    # Orders meet customers first, so that the long table takes part in two joins rather than three. That with orders
    # is the last, which leaves the lines of an invoice in one task: sums per invoice then combine before they are sent.
    # A line whose order, customer or part is absent stays, without their values.
    headers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    rows = item.join(part, F.col("l_partkey") == F.col("p_partkey"), "left").join(
        headers, F.col("l_orderkey") == F.col("o_orderkey"), "left"
    )
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    rows = rows.withColumns(
        {
            "_charge": F.when(order % 211 == 0, 0.0).otherwise(
                F.floor(F.col("l_extendedprice") * (1 + F.col("l_tax"))).cast("double")
            ),
            "_paid": F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("double"),
        }
    )
    rows = rows.withColumns(
        {
            "_pay": F.when(F.col("l_returnflag") == "R", 0.0).otherwise(F.col("_paid")),
            "_expected": F.when(order % 83 != 0, F.floor(F.col("_charge") * 0.85).cast("double")),
        }
    )
    charge, paid, pay, expected = F.col("_charge"), F.col("_paid"), F.col("_pay"), F.col("_expected")
    balance = charge - pay
    return rows.select(
        *(["row_id"] if row_id else []),
        F.expr("cast(extract(YEAROFWEEK FROM o_orderdate) AS int)").alias("year"),
        F.weekofyear("o_orderdate").alias("week"),
        F.when(order % 97 != 0, _mapped(F.col("c_mktsegment"), PAYER_BY_SEGMENT)).alias("payer"),
        _mapped(F.col("o_orderpriority"), GROUP_BY_PRIORITY).alias("group_em"),
        F.col("o_orderstatus").alias("group_em2"),
        order.cast("string").alias("invoice_number"),
        F.col("p_type").alias("cpt_code"),
        charge.alias("charge_amount"),
        pay.alias("payment_amount"),
        expected.alias("expected_85em"),
        balance.alias("charge_billed_balance"),
        F.when(line % 3 == 0, -balance).otherwise(balance * 0.5).alias("zero_balance_collection_star_charges"),
        (paid * 0.5).alias("nrv_zero_balance"),
        _steps(F.try_divide(paid, charge), 4096).alias("zero_balance_collection_rate"),
        _steps(1 - F.col("l_discount"), 1024).alias("collection_rate"),
        _steps(F.col("l_discount"), 1024).alias("denial_pct"),
        (pay - expected).alias("nrv_gap_dollar"),
        _steps(F.col("l_discount") - F.col("l_tax"), 1024).alias("nrv_gap_pct"),
        (charge - expected).alias("nrv_gap_sum_dollar"),
        _steps(F.try_divide(balance, charge), 1024).alias("remaining_charges_pct"),
        (F.col("l_quantity") / 16).alias("avg_charge_em_weight"),
        F.when(order % 89 != 0, F.col("l_quantity") % 4).alias("labs_per_visit"),
        line.cast("double").alias("procedure_per_visit"),
        (F.col("p_size") % 5).cast("double").alias("radiology_count"),
        (F.col("l_linestatus") == "O").cast("double").alias("open_invoice_count"),
        (expected - pay).alias("sp_balance"),
        (pay - expected).alias("insurance_balance"),
        paid.alias("payment_per_visit"),
        charge.alias("fee_schedule_expected"),
        F.when(line % 4 != 0, F.floor(paid * 0.75).cast("double")).alias("benchmark_payment_invoice_level"),
    )


def raw_report(spark: SparkSession, folder: str) -> DataFrame:
    """The same lines as an uncleaned text report: block headers, blanks, odd numbers and total rows."""
    lines = invoice_lines(spark, folder, row_id=True)
    r = F.col("row_id")
    head = r % 4 == 0
    number = F.col("charge_amount").cast("bigint").cast("string")
    return lines.select(
        "row_id",
        F.when(head, F.concat(F.col("year").cast("string"), F.lit(".0")))
        .when(r % 4 == 1, "  ")
        .alias("Year of Visit Service Date"),
        F.when(head, F.concat(F.lit("Week "), F.lpad(F.col("week").cast("string"), 2, "0"))).alias(
            "ISO Week of Visit Service Date"
        ),
        F.when(head, F.when(r % 1000 == 0, " Grand  Total ").otherwise(F.col("payer")))
        .when(r % 4 == 2, "")
        .alias("Primary Financial Class"),
        F.when(head, F.col("group_em")).alias("Chart E/M Code Grouping"),
        F.when(head, F.col("group_em2")).alias("Chart E/M Code Second Layer"),
        F.when(r % 3 == 0, F.col("invoice_number")).alias("Charge Invoice Number"),
        F.when(r % 51 == 7, None)
        .when(r % 777 == 5, "total")
        .otherwise(F.concat(F.lit(" "), F.col("cpt_code")))
        .alias("Charge CPT Code"),
        F.when(r % 7 == 0, F.concat(F.lit(" "), number, F.lit(".5")))
        .when(r % 7 == 1, "abc")
        .when(r % 7 == 2, "   ")
        .when(r % 7 == 3, F.concat(F.lit("1,"), F.lpad(number, 6, "0")))
        .when(r % 7 == 4, F.concat(number, F.lit("%")))
        .when(r % 7 == 5, F.concat(number, F.lit("d")))
        .otherwise(F.concat(F.lit("-"), number, F.lit("e-2")))
        .alias("Charge Amount"),
        F.col("payment_amount").cast("bigint").cast("string").alias("Payment Amount*"),
        F.concat((F.col("denial_pct") * 1024).cast("bigint").cast("string"), F.lit("%")).alias("Denial %"),
        F.col("labs_per_visit").cast("bigint").cast("string").alias("Lab per Visit (copy)"),
        r.cast("string").alias("Unnamed: 0"),
    )
