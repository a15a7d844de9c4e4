"""The six rule packs against their SQL: every one of the 206 codes is met by at least one defect row."""

from __future__ import annotations

from decimal import Decimal

import duckdb
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_domain_rules import AS_OF, _schema, clean

from strata.domains import telecom as tc
from strata.operators.validate import CODES, validate_pack
from strata.plans import medallion, telecom_bronze
from strata.plans import telecom_sql as sql
from strata.sources import ingest as ing

TEXTS = {
    "operator_id": [None, "OPA99", "OPA01", "OPA03", "OPA04"],
    "report_period": [None, "", "2025-13", "2025-03\n", "2017-12", "2018-01", "2025-07", "2025-08", "0000-01"],
    "region_code": [None, "XXX"],
    "service_segment": [None, "mobile", "fixed_voice", "fixed_broadband", "satellite", "cable"],
    "service_category": [None, *tc.SERVICE_CATEGORIES, "fax"],
    "payment_type": [None, "barter"],
    "technology_generation": [None, "4G", "6G"],
    "measurement_methodology": [None, "guess"],
    "period_type": [None, "yearly"],
    "submitted_at": [None],
}
NUMBERS = {"bigint": [None, -1, 0, 1, 105, 106, 990, 1010, 1011], "int": [None, -1, 0, 5000, 5001]}


def defects(domain: str) -> list[dict]:
    """Clean rows of every segment, and each of them with one column changed at a time."""
    out = []
    for segment in tc.DOMAIN_SEGMENTS[domain]:
        good = clean(domain, segment)
        out.append(good)
        for c in good:
            kind = next((t for n, t in tc.DOMAIN_DEFS[domain].business if n == c), None)
            if c in TEXTS:
                values = TEXTS[c]
            elif isinstance(kind, T.DecimalType):
                values = [None, Decimal("-0.01"), Decimal("0"), Decimal("100"), Decimal("100.01")]
            else:
                values = NUMBERS[kind.simpleString()] if kind else []
            out += [{**good, c: v} for v in values]
    return [{**r, "bronze_id": f"{i:06d}"} for i, r in enumerate(out)]


@pytest.mark.parametrize("domain", tc.DOMAINS)
def test_every_code_fires_and_equals_the_sql(spark, domain, tmp_path):
    schema, rows = _schema(domain), defects(domain)
    df = spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)
    df.write.parquet(f"{tmp_path}/rows")
    judged = validate_pack(df, tc.pack(domain, tc.operators_df(spark), tc.regions_df(spark), AS_OF)).select("bronze_id", CODES)
    ours = {r.bronze_id: r[CODES] for r in judged.collect()}
    source = f"SELECT * FROM read_parquet('{tmp_path}/rows/*.parquet')"
    theirs = dict(duckdb.sql(f"SELECT bronze_id, codes FROM ({sql.judged(domain, AS_OF, source)})").fetchall())
    assert ours == theirs
    wanted = [r.code for r in tc.rules_for(domain, AS_OF)]
    assert [c for c, _ in sql.rules(domain, AS_OF)] == wanted
    assert set().union(*ours.values()) == set(wanted)


def test_a_drop_with_a_refused_row_goes_whole(spark):
    d = tc.DOMAIN_DEFS["traffic_sms"]
    names = d.required_csv_columns
    base = dict.fromkeys(names, "3") | {"report_period": "2025-03", "region_code": "BZV", "service_segment": "mobile", "submitted_at": "2025-04-05 14:23:11"}
    rows = [("a", "OPA01", '{"x": 1}'), ("b", "OPA01", "[]"), ("b", "OPA01", "{}"), ("c", "OPA02", "{}"), ("d", "OPA01", "{"), ("e", "OPA01", None)]
    full = [(drop, [{**base, "operator_id": op, "_raw_payload": p}[c] for c in names]) for drop, op, p in rows]
    df = spark.createDataFrame(full, "drop string, fields array<string>").select(
        "*", F.array(*[F.lit(i + 1) for i in range(len(names))]).alias("positions"), F.lit("OPA01").alias("k_operator_id"), F.lit("mobile").alias("k_service_segment"))
    assert sorted(r["drop"] for r in ing.refused_groups(df, d, ["drop"]).collect()) == ["b", "c", "d", "e"]


def test_lines_with_one_number_keep_their_own_ids(spark):
    rows = medallion.accepted(spark, SF_SMALL, "traffic_internet")
    values = F.struct("source_submission_id", "_source_file", *tc.DOMAIN_DEFS["traffic_internet"].business_names)
    n = rows.agg(F.countDistinct("source_submission_id").alias("numbers"), F.countDistinct("bronze_id").alias("ids"), F.countDistinct(values).alias("rows")).first()
    assert n.numbers < n.ids == n.rows


def test_accepted_rows_share_their_joins_and_are_not_shuffled(spark):
    facts = telecom_bronze.Facts(spark, SF_SMALL)
    rows = medallion.accepted(spark, SF_SMALL, "traffic_sms", facts=facts)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "lineitem" not in plan
    assert facts.lines().inputFiles() and facts.lines() is facts.lines()


def test_numbers_of_their_own_type_need_no_check(spark):
    d = tc.DOMAIN_DEFS["traffic_sms"]
    names = d.required_csv_columns
    base = dict.fromkeys(names) | {"operator_id": "OPA01", "report_period": "2025-03", "region_code": "BZV", "service_segment": "mobile", "_raw_payload": "{}"}
    rows = [("a", {}), ("b", {"operator_id": "OPA02"}), ("c", {names[5]: str(2**63)}), ("d", {names[5]: "-9223372036854775808"})]
    df = spark.createDataFrame([(k, [(base | more)[c] for c in names]) for k, more in rows], "drop string, fields array<string>").select(
        "*", F.array(*[F.lit(i + 1) for i in range(len(names))]).alias("positions"), F.lit("OPA01").alias("k_operator_id"), F.lit("mobile").alias("k_service_segment"))
    refused = lambda *sure: sorted(r["drop"] for r in ing.refused_groups(df, d, ["drop"], *sure).collect())
    assert refused() == ["b", "c"] and refused({names[5]}) == ["b"]


def test_rules_are_compiled_and_the_reference_tables_need_no_shuffle(spark, tmp_path):
    """Sizes of the reference tables are known before any row is shuffled; no rule is interpreted."""
    domain = "traffic_voice"
    rows = [tuple(clean(domain, "mobile").get(f.name) for f in _schema(domain).fields)]
    spark.createDataFrame(rows, _schema(domain)).write.parquet(f"{tmp_path}/rows")
    pack = tc.pack(domain, tc.operators_df(spark), tc.regions_df(spark), AS_OF)
    execution = validate_pack(spark.read.parquet(f"{tmp_path}/rows"), pack)._jdf.queryExecution()
    plan = execution.executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in plan and "filter(" not in plan
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
