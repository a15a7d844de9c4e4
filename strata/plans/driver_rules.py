"""Rule families and validation operators on the driver tables.

Orders, line items, customers, suppliers and parts play the submission
domains: each gets a rule list built from ``operators.rules`` families and is
validated by the same ``operators.validate`` code the telecom pack uses.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import period_of, period_start, previous_period
from ..operators import rules as R
from ..operators import upsert
from ..operators.validate import CODES, DimLookup, counts, validate
from .registry import query
from .tables import customers, money, nations, table

# Fixed analog parameters of the driver-table rule packs.
AS_OF = "2000-06-15"
OLDEST = "1996-01-01"
ORDER_STATUSES_CLOSED = ("F", "O")
URGENT_PRIORITIES = ("1-URGENT", "2-HIGH")
MARKET_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
RETURN_FLAGS = ("A", "N", "R")
PRIORITY_PATTERN = r"^[1-5]-[A-Z]+( [A-Z]+)*\z"


def _codes_out(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(
        *keep,
        R.codes_text(CODES).alias("rejection_codes"),
        F.size(CODES).alias("n_codes"),
        F.when(F.size(CODES) > 0, R.rejection_message(CODES)).alias("rejection_reason"),
    )


def _sql_codes(cases: list[str]) -> str:
    arr = ",\n      ".join(cases)
    return f"list_filter([\n      {arr}\n    ], lambda x: x IS NOT NULL)"


def _sql_codes_out(codes_expr: str) -> str:
    return (
        f"array_to_string({codes_expr}, ', ') AS rejection_codes, "
        f"CAST(len({codes_expr}) AS INTEGER) AS n_codes, "
        f"CASE WHEN len({codes_expr}) > 0 THEN 'Validation failed: ' || array_to_string({codes_expr}, ', ') END "
        f"AS rejection_reason"
    )


_PERIOD_RE = r"^\d{4}-(0[1-9]|1[0-2])$"


def _sql_period_cases(p: str) -> list[str]:
    return [
        f"CASE WHEN {p} IS NULL THEN 'missing_report_period' END",
        f"CASE WHEN {p} IS NOT NULL AND NOT regexp_full_match({p}, '\\d{{4}}-(0[1-9]|1[0-2])') THEN 'invalid_period_format' END",
        f"CASE WHEN regexp_full_match({p}, '\\d{{4}}-(0[1-9]|1[0-2])') AND CAST({p} || '-01' AS DATE) < DATE '{OLDEST}' "
        f"THEN 'period_too_old' END",
        f"CASE WHEN regexp_full_match({p}, '\\d{{4}}-(0[1-9]|1[0-2])') "
        f"AND CAST({p} || '-01' AS DATE) > DATE '{AS_OF}' + INTERVAL 1 MONTH THEN 'period_in_future' END",
    ]


# --- orders ----------------------------------------------------------------------


def line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum(money("l_extendedprice")).alias("line_sum")
    )


def order_rules() -> list[R.Rule]:
    p = "report_period"
    return [
        R.missing("missing_custkey", "o_custkey"),
        R.unknown_reference("unknown_customer", "dim_c_custkey"),
        R.missing("missing_report_period", p),
        R.invalid_period("invalid_period_format", p),
        R.period_older_than("period_too_old", p, OLDEST),
        R.period_after("period_in_future", p, AS_OF),
        R.bad_format("invalid_priority_format", "o_orderpriority", PRIORITY_PATTERN),
        R.not_in("unknown_order_status", "o_orderstatus", ORDER_STATUSES_CLOSED),
        R.conditional_not_in("priority_mismatch_finished", "o_orderstatus", "F", "o_orderpriority", URGENT_PRIORITIES),
        R.negative("negative_totalprice", "o_totalprice"),
        R.out_of_range("totalprice_out_of_range", "o_totalprice", 1000, 450000),
        R.exceeds_ratio("total_exceeds_lines", "o_totalprice", "line_sum", "1.05"),
        R.required_when("finished_without_lines", F.col("o_orderstatus") == "F", "line_count"),
    ]


def validated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", money("o_totalprice").alias("o_totalprice"), "o_orderdate", "o_orderpriority"
    )
    o = o.withColumn("report_period", period_of("o_orderdate"))
    lt = line_totals(spark, sf_dir)
    o = o.join(lt, o.o_orderkey == lt.l_orderkey, "left").drop("l_orderkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey")
    # the customer side grows with the data: the lookup broadcasts it only under the row bound
    return validate(o, order_rules(), [DimLookup(cust, "o_custkey", "c_custkey")])


_ORDER_CASES = [
    "CASE WHEN o.o_custkey IS NULL THEN 'missing_custkey' END",
    "CASE WHEN c.c_custkey IS NULL THEN 'unknown_customer' END",
    *_sql_period_cases("o.report_period"),
    "CASE WHEN o.o_orderpriority IS NOT NULL AND NOT regexp_full_match(o.o_orderpriority, '[1-5]-[A-Z]+( [A-Z]+)*') "
    "THEN 'invalid_priority_format' END",
    "CASE WHEN o.o_orderstatus IS NOT NULL AND o.o_orderstatus NOT IN ('F', 'O') THEN 'unknown_order_status' END",
    "CASE WHEN o.o_orderstatus = 'F' AND o.o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN 'priority_mismatch_finished' END",
    "CASE WHEN o.o_totalprice < 0 THEN 'negative_totalprice' END",
    "CASE WHEN o.o_totalprice < 1000 OR o.o_totalprice > 450000 THEN 'totalprice_out_of_range' END",
    "CASE WHEN o.o_totalprice IS NOT NULL AND lt.line_sum IS NOT NULL AND o.o_totalprice > lt.line_sum * 1.05 "
    "THEN 'total_exceeds_lines' END",
    "CASE WHEN o.o_orderstatus = 'F' AND lt.line_count IS NULL THEN 'finished_without_lines' END",
]

_VALIDATED_ORDERS_SQL = f"""
  SELECT o.o_orderkey, o.report_period, {_sql_codes(_ORDER_CASES)} AS codes
  FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, strftime(o_orderdate, '%Y-%m') AS report_period
        FROM orders) o
  LEFT JOIN (SELECT l_orderkey, COUNT(*) AS line_count, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS line_sum
             FROM lineitem GROUP BY l_orderkey) lt ON o.o_orderkey = lt.l_orderkey
  LEFT JOIN (SELECT DISTINCT c_custkey FROM customer) c ON o.o_custkey = c.c_custkey
"""


@query(
    "validate_orders",
    f"""
SELECT o_orderkey, report_period, {_sql_codes_out('codes')}
FROM ({_VALIDATED_ORDERS_SQL}) v
""",
)
def validate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rules (V01-V12) compiled to one code array; codes joined as text."""
    return _codes_out(validated_orders(spark, sf_dir), "o_orderkey", "report_period")


@query(
    "rejection_breakdown",
    f"""
SELECT report_period, code, COUNT(*) AS rejected_rows
FROM (SELECT report_period, unnest(codes) AS code FROM ({_VALIDATED_ORDERS_SQL}) v WHERE len(codes) > 0) x
GROUP BY report_period, code
""",
)
def rejection_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected orders exploded to one row per code, counted by (period, code)."""
    v = validated_orders(spark, sf_dir).filter(F.size(CODES) > 0)
    return (
        v.select("report_period", F.explode(CODES).alias("code"))
        .groupBy("report_period", "code")
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
    )


# --- line items --------------------------------------------------------------------


def lineitem_rules() -> list[R.Rule]:
    return [
        R.not_in("unknown_return_flag", "l_returnflag", RETURN_FLAGS),
        R.negative("negative_quantity", "l_quantity"),
        R.out_of_range("discount_out_of_range", "l_discount", 0, "0.08"),
        R.out_of_range("tax_out_of_range", "l_tax", 0, "0.06"),
        R.exceeds_ratio("tax_exceeds_discount", "l_tax", "l_discount", "1.05"),
        R.ratio_above("discount_share_high", F.col("l_discount") * F.col("l_extendedprice"), "l_extendedprice", "0.09"),
    ]


def lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast("bigint").alias("l_quantity"),
        money("l_extendedprice").alias("l_extendedprice"),
        money("l_discount").alias("l_discount"),
        money("l_tax").alias("l_tax"),
        "l_returnflag",
    )


_LINE_CASES = [
    "CASE WHEN l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'N', 'R') THEN 'unknown_return_flag' END",
    "CASE WHEN l_quantity < 0 THEN 'negative_quantity' END",
    "CASE WHEN l_discount < 0 OR l_discount > 0.08 THEN 'discount_out_of_range' END",
    "CASE WHEN l_tax < 0 OR l_tax > 0.06 THEN 'tax_out_of_range' END",
    "CASE WHEN l_tax IS NOT NULL AND l_discount IS NOT NULL AND l_tax > l_discount * 1.05 THEN 'tax_exceeds_discount' END",
    "CASE WHEN l_extendedprice > 0 AND l_discount * l_extendedprice > l_extendedprice * 0.09 THEN 'discount_share_high' END",
]
_LINES_SQL = """
  SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, CAST(l_discount AS DECIMAL(18,2)) AS l_discount,
         CAST(l_tax AS DECIMAL(18,2)) AS l_tax, l_returnflag
  FROM lineitem
"""


@query(
    "ratio_rules",
    f"""
SELECT l_orderkey, l_linenumber, {_sql_codes_out('codes')}
FROM (SELECT *, {_sql_codes(_LINE_CASES)} AS codes FROM ({_LINES_SQL}) l) v
""",
)
def ratio_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V10 range, V11 cross-column ratio, V19 guarded ratio on every line item."""
    v = validate(lineitems(spark, sf_dir), lineitem_rules())
    return _codes_out(v, "l_orderkey", "l_linenumber")


# --- customers: reference and licence rules ------------------------------------------


def licensed_segments(nation_key: F.Column) -> F.Column:
    """Segments a nation is licensed for, derived from its key (analog of the
    operator licence array): segment i is licensed unless (key + i) % 3 == 0."""
    segs = F.array(*[F.lit(s) for s in MARKET_SEGMENTS])
    return F.filter(segs, lambda s, i: (nation_key + i) % 3 != 0)


def customer_rules() -> list[R.Rule]:
    return [
        R.missing("missing_nation", "c_nationkey"),
        R.unknown_reference("unknown_nation", "dim_n_nationkey"),
        R.not_in("unknown_segment", "c_mktsegment", MARKET_SEGMENTS),
        R.not_licensed("segment_not_licensed", "dim_n_nationkey", "c_mktsegment", "dim_licensed_segments"),
        R.negative("negative_balance", "c_acctbal"),
    ]


def licence_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = nations(spark, sf_dir)
    return n.select("n_nationkey", "n_name", licensed_segments(F.col("n_nationkey")).alias("licensed_segments"))


def validated_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment", money("c_acctbal").alias("c_acctbal")
    )
    dim = DimLookup(licence_dim(spark, sf_dir), "c_nationkey", "n_nationkey", ("n_name", "licensed_segments"))
    return validate(c, customer_rules(), [dim])


_CUSTOMER_SQL = """
  SELECT c.c_custkey, c.c_nationkey, c.c_mktsegment, CAST(c.c_acctbal AS DECIMAL(18,2)) AS c_acctbal,
         n.n_nationkey, n.n_name,
         list_filter(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'],
                     lambda s, i: (n.n_nationkey + i - 1) % 3 != 0) AS licensed_segments
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""
_CUSTOMER_CASES = [
    "CASE WHEN c_nationkey IS NULL THEN 'missing_nation' END",
    "CASE WHEN n_nationkey IS NULL THEN 'unknown_nation' END",
    "CASE WHEN c_mktsegment IS NOT NULL AND c_mktsegment NOT IN "
    "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY') THEN 'unknown_segment' END",
    "CASE WHEN n_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL AND NOT list_contains(licensed_segments, c_mktsegment) "
    "THEN 'segment_not_licensed' END",
    "CASE WHEN c_acctbal < 0 THEN 'negative_balance' END",
]


@query(
    "reference_rules",
    f"""
SELECT c_custkey, n_name AS operator_id, {_sql_codes_out('codes')}
FROM (SELECT *, {_sql_codes(_CUSTOMER_CASES)} AS codes FROM ({_CUSTOMER_SQL}) c) v
""",
)
def reference_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V02 unknown reference, V06 enum, V07 array licence over a broadcast dimension."""
    v = validated_customers(spark, sf_dir)
    n = licence_dim(spark, sf_dir).select("n_nationkey", F.col("n_name").alias("operator_id"))
    return _codes_out(v.join(n, v.c_nationkey == n.n_nationkey, "left"), "c_custkey", "operator_id")


# --- suppliers and parts (for the run-all counts) -------------------------------------


def validated_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", money("s_acctbal").alias("s_acctbal"))
    rules = [
        R.unknown_reference("unknown_nation", "dim_n_nationkey"),
        R.negative("negative_balance", "s_acctbal"),
    ]
    return validate(s, rules, [DimLookup(nations(spark, sf_dir), "s_nationkey", "n_nationkey")])


def validated_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", money("p_retailprice").alias("p_retailprice"))
    rules = [
        R.out_of_range("size_out_of_range", "p_size", 1, 45),
        R.negative("negative_price", "p_retailprice"),
        R.exceeds_ratio("price_above_list", "p_retailprice", F.lit(950).cast("decimal(18,2)"), "1.05"),
    ]
    return validate(p, rules)


_COUNT_SQL = """
SELECT '{name}' AS domain, {i} AS domain_order, COUNT(*) AS rows_processed,
       COUNT(*) FILTER (WHERE len(codes) = 0) AS rows_validated,
       COUNT(*) FILTER (WHERE len(codes) > 0) AS rows_rejected
FROM ({body}) v
"""


@query(
    "validation_counts",
    "SELECT domain, rows_processed, rows_validated, rows_rejected FROM ("
    + " UNION ALL ".join(
        _COUNT_SQL.format(name=n, i=i, body=b)
        for i, (n, b) in enumerate(
            [
                ("orders", _VALIDATED_ORDERS_SQL),
                ("lineitem", f"SELECT {_sql_codes(_LINE_CASES)} AS codes FROM ({_LINES_SQL}) l"),
                ("customer", f"SELECT {_sql_codes(_CUSTOMER_CASES)} AS codes FROM ({_CUSTOMER_SQL}) c"),
                (
                    "supplier",
                    "SELECT list_filter([CASE WHEN n.n_nationkey IS NULL THEN 'unknown_nation' END, "
                    "CASE WHEN CAST(s.s_acctbal AS DECIMAL(18,2)) < 0 THEN 'negative_balance' END], lambda x: x IS NOT NULL) AS codes "
                    "FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey",
                ),
                (
                    "part",
                    "SELECT list_filter([CASE WHEN p_size < 1 OR p_size > 45 THEN 'size_out_of_range' END, "
                    "CASE WHEN CAST(p_retailprice AS DECIMAL(18,2)) < 0 THEN 'negative_price' END, "
                    "CASE WHEN CAST(p_retailprice AS DECIMAL(18,2)) > 950 * 1.05 THEN 'price_above_list' END], "
                    "lambda x: x IS NOT NULL) AS codes FROM part",
                ),
            ]
        )
    )
    + ") u",
)
def validation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """processed/validated/rejected per table in a fixed order (one agg each)."""
    frames = [
        ("orders", validated_orders(spark, sf_dir)),
        ("lineitem", validate(lineitems(spark, sf_dir), lineitem_rules())),
        ("customer", validated_customers(spark, sf_dir)),
        ("supplier", validated_suppliers(spark, sf_dir)),
        ("part", validated_parts(spark, sf_dir)),
    ]
    parts = [counts(v, name) for name, v in frames]
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- reconciliation, conditional columns, derived totals ----------------------------------


@query(
    "component_reconcile",
    """
WITH lt AS (
  SELECT l_orderkey,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS components_sum,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2))) AS tax_sum
  FROM lineitem GROUP BY l_orderkey
), o AS (
  SELECT o.o_orderkey, CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_xaf,
         CAST(COALESCE(lt.components_sum, 0) AS DECIMAL(38,2)) AS components_sum_xaf,
         CAST(COALESCE(lt.tax_sum, 0) AS DECIMAL(38,4)) AS tax_sum
  FROM orders o LEFT JOIN lt ON o.o_orderkey = lt.l_orderkey
)
SELECT o_orderkey, total_xaf, components_sum_xaf,
       CAST(total_xaf - components_sum_xaf AS DECIMAL(38,2)) AS sum_check_delta_xaf,
       CASE WHEN total_xaf > 0 THEN CAST(CAST(((2 * CAST(tax_sum * 10000 AS HUGEINT) * 1000 + CAST(total_xaf * 100 AS HUGEINT))
            // (2 * CAST(total_xaf * 100 AS HUGEINT))) AS DECIMAL(38,0)) / 1000 AS DECIMAL(9,3)) END AS tax_rate_pct,
       array_to_string(list_filter([
         CASE WHEN total_xaf = 0 AND components_sum_xaf > 0 THEN 'zero_total_with_components' END,
         CASE WHEN total_xaf > 0 AND abs(total_xaf - components_sum_xaf) > total_xaf * 1.0 / 100 THEN 'component_sum_mismatch' END,
         CASE WHEN total_xaf > 0 AND tax_sum > total_xaf * 0.05 THEN 'tax_rate_implausibly_high' END
       ], lambda x: x IS NOT NULL), ', ') AS rejection_codes
FROM o
""",
)
def component_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order total vs the sum of its line items, delta, rate, tolerance."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_tax")
    lt = li.groupBy("l_orderkey").agg(
        F.sum(money("l_extendedprice")).alias("components_sum"),
        F.sum(money("l_extendedprice") * money("l_tax")).alias("tax_sum"),
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", money("o_totalprice").alias("total_xaf"))
    j = o.join(lt, o.o_orderkey == lt.l_orderkey, "left").select(
        "o_orderkey",
        "total_xaf",
        F.coalesce("components_sum", F.lit(0)).cast("decimal(38,2)").alias("components_sum_xaf"),
        F.coalesce("tax_sum", F.lit(0)).cast("decimal(38,4)").alias("tax_sum"),
    )
    rules = [
        R.zero_total_with_parts("zero_total_with_components", "total_xaf", "components_sum_xaf"),
        R.sum_mismatch("component_sum_mismatch", "total_xaf", "components_sum_xaf", "1.0"),
        R.ratio_above("tax_rate_implausibly_high", "tax_sum", "total_xaf", "0.05"),
    ]
    tot = F.col("total_xaf")
    rate = F.round(F.col("tax_sum").cast("decimal(24,4)") * 100 / tot.cast("decimal(18,2)"), 3).cast("decimal(9,3)")
    return j.select(
        "o_orderkey",
        "total_xaf",
        "components_sum_xaf",
        (tot - F.col("components_sum_xaf")).cast("decimal(38,2)").alias("sum_check_delta_xaf"),
        F.when(tot > 0, rate).alias("tax_rate_pct"),
        R.codes_text(R.compile_codes(rules)).alias("rejection_codes"),
    )


def _pivot_quantity(spark: SparkSession, sf_dir: str, by: list[str], values: list[tuple[str, ...]]) -> DataFrame:
    """Conditional-aggregation pivot of integral quantity per order (one pass, partial agg)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_quantity").cast("bigint").alias("q"), *by)
    aggs = []
    for combo in values:
        cond = reduce(lambda a, b: a & b, [F.col(c) == v for c, v in zip(by, combo)])
        aggs.append(F.sum(F.when(cond, F.col("q"))).alias("qty_" + "_".join(v.lower() for v in combo)))
    return li.groupBy("l_orderkey").agg(*aggs)


@query(
    "conditional_columns",
    """
WITH p AS (
  SELECT l_orderkey,
         CAST(SUM(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS qty_a,
         CAST(SUM(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS qty_n,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS qty_r
  FROM lineitem GROUP BY l_orderkey
), j AS (
  SELECT o.o_orderkey, o.o_orderstatus, c.c_mktsegment AS service_segment, p.qty_a, p.qty_n, p.qty_r
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN p ON o.o_orderkey = p.l_orderkey
)
SELECT o_orderkey, service_segment, qty_a, qty_n, qty_r,
       array_to_string(list_filter([
         CASE WHEN service_segment = 'AUTOMOBILE' AND qty_r IS NULL THEN 'automobile_missing_returns' END,
         CASE WHEN service_segment = 'BUILDING' AND COALESCE(qty_a, 0) <> 0 THEN 'building_has_accepted_lines' END,
         CASE WHEN service_segment = 'FURNITURE' AND (qty_n IS NOT NULL) THEN 'furniture_has_open_lines' END,
         CASE WHEN service_segment = 'HOUSEHOLD' AND (COALESCE(qty_a, 0) = 0 OR COALESCE(qty_r, 0) = 0)
              THEN 'household_missing_components' END,
         CASE WHEN NOT (o_orderstatus = 'O') AND qty_n IS NOT NULL THEN 'open_lines_on_closed_order' END
       ], lambda x: x IS NOT NULL), ', ') AS rejection_codes
FROM j
""",
)
def conditional_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns required / forbidden / non-zero depending on the segment."""
    p = _pivot_quantity(spark, sf_dir, ["l_returnflag"], [(f,) for f in RETURN_FLAGS])
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = customers(spark, sf_dir).select("c_custkey", "service_segment")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner").join(p, o.o_orderkey == p.l_orderkey, "left")
    seg = F.col("service_segment")
    rules = [
        R.required_when("automobile_missing_returns", seg == "AUTOMOBILE", "qty_r"),
        R.forbidden_nonzero_when("building_has_accepted_lines", seg == "BUILDING", ["qty_a"]),
        R.forbidden_present_when("furniture_has_open_lines", seg == "FURNITURE", ["qty_n"]),
        R.required_nonzero_when("household_missing_components", seg == "HOUSEHOLD", ["qty_a", "qty_r"]),
        R.present_unless("open_lines_on_closed_order", F.col("o_orderstatus") == "O", "qty_n"),
    ]
    return j.select(
        "o_orderkey", "service_segment", "qty_a", "qty_n", "qty_r", R.codes_text(R.compile_codes(rules)).alias("rejection_codes")
    )


_COMBOS = [(f, s) for f in RETURN_FLAGS for s in ("F", "O")]


@query(
    "derived_totals",
    "SELECT l_orderkey, "
    + ", ".join(
        f"CAST(SUM(CASE WHEN l_returnflag = '{f}' AND l_linestatus = '{s}' THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) "
        f"AS qty_{f.lower()}_{s.lower()}"
        for f, s in _COMBOS
    )
    + ", "
    + ", ".join(
        f"CAST(COALESCE(SUM(CASE WHEN l_returnflag = '{f}' AND l_linestatus = '{s}' THEN CAST(l_quantity AS BIGINT) END), 0) AS BIGINT)"
        for f, s in _COMBOS
    ).replace(", CAST(COALESCE", " + CAST(COALESCE")
    + " AS total_quantity, "
    + " + ".join(
        f"CAST(COALESCE(SUM(CASE WHEN l_returnflag = '{f}' AND l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) END), 0) AS BIGINT)"
        for f in RETURN_FLAGS
    )
    + " AS open_quantity FROM lineitem GROUP BY l_orderkey",
)
def derived_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pivoted component columns and their coalesced sums."""
    p = _pivot_quantity(spark, sf_dir, ["l_returnflag", "l_linestatus"], _COMBOS)
    cols = [f"qty_{f.lower()}_{s.lower()}" for f, s in _COMBOS]
    return p.select(
        "l_orderkey",
        *cols,
        R.coalesced_sum(cols).cast("bigint").alias("total_quantity"),
        R.coalesced_sum([c for c in cols if c.endswith("_o")]).cast("bigint").alias("open_quantity"),
    )


# --- periods ----------------------------------------------------------------------------


@query(
    "period_rules",
    f"""
SELECT o_orderkey, period_text,
       array_to_string({_sql_codes(_sql_period_cases('period_text'))}, ', ') AS rejection_codes,
       CASE WHEN regexp_full_match(period_text, '\\d{{4}}-(0[1-9]|1[0-2])') THEN CAST(period_text || '-01' AS DATE) END
         AS period_start_date,
       strftime(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH, '%Y-%m') AS previous_period
FROM (SELECT o_orderkey, o_orderdate,
             CASE WHEN o_orderkey % 10 = 0 THEN strftime(o_orderdate, '%Y-%-m') ELSE strftime(o_orderdate, '%Y-%m') END
               AS period_text
      FROM orders) o
""",
)
def period_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V03-V05 period checks on text that is sometimes unpadded, V32 start date, M10."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    text = F.when(F.col("o_orderkey") % 10 == 0, F.date_format("o_orderdate", "yyyy-M")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM")
    )
    o = o.withColumn("period_text", text)
    rules = [
        R.missing("missing_report_period", "period_text"),
        R.invalid_period("invalid_period_format", "period_text"),
        R.period_older_than("period_too_old", "period_text", OLDEST),
        R.period_after("period_in_future", "period_text", AS_OF),
    ]
    return o.select(
        "o_orderkey",
        "period_text",
        R.codes_text(R.compile_codes(rules)).alias("rejection_codes"),
        period_start("period_text").alias("period_start_date"),
        previous_period("o_orderdate").alias("previous_period"),
    )


# --- upserts ------------------------------------------------------------------------------

_LINE_FULL_SQL = """
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS l_quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem
"""
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"]
SPLIT_DATE = "1998-01-01"


def line_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("bigint").alias("l_quantity"),
        money("l_extendedprice").alias("l_extendedprice"),
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    )


_ROWNUM = "ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY " + ", ".join(
    f"{c} DESC" for c in LINE_ORDER
) + ")"


@query(
    "upsert_latest",
    f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, {_ROWNUM} AS rn FROM ({_LINE_FULL_SQL}) l) x WHERE rn = 1
""",
)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last-wins per business key under a total order (skew-safe aggregate pick)."""
    return upsert.latest_per_key(line_batch(spark, sf_dir), LINE_KEY, LINE_ORDER)


@query(
    "upsert_merge",
    f"""
WITH b AS ({_LINE_FULL_SQL}),
existing AS (SELECT * FROM b WHERE l_shipdate < TIMESTAMP '{SPLIT_DATE}'),
incoming AS (SELECT * FROM (SELECT *, {_ROWNUM} AS rn FROM b WHERE l_shipdate >= TIMESTAMP '{SPLIT_DATE}') x WHERE rn = 1)
SELECT e.* FROM existing e ANTI JOIN incoming i ON e.l_orderkey = i.l_orderkey AND e.l_linenumber = i.l_linenumber
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus, l_shipdate
FROM incoming
""",
)
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows shipped before the split are the table, later rows the batch;
    the batch is de-duplicated last-wins and replaces matching keys."""
    b = line_batch(spark, sf_dir)
    existing = b.filter(F.col("l_shipdate") < F.lit(SPLIT_DATE).cast("timestamp_ntz"))
    incoming = b.filter(F.col("l_shipdate") >= F.lit(SPLIT_DATE).cast("timestamp_ntz"))
    return upsert.merge(existing, incoming, LINE_KEY, order=LINE_ORDER)
