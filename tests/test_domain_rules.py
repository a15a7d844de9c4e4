"""The six telecom rule packs: clean rows pass, each probed defect yields its codes."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from strata.domains import telecom as tc
from strata.operators.validate import CODES, validate_pack

AS_OF = "2025-06-15"
TS = dt.datetime(2025, 4, 5, 14, 23, 11)


def clean(domain: str, segment: str) -> dict:
    op = {"mobile": "OPA01", "fixed_voice": "OPA03", "fixed_broadband": "OPA04"}[segment]
    row = {"bronze_id": "b1", "source_submission_id": "s1", "operator_id": op, "report_period": "2025-03",
           "region_code": "BZV", "service_segment": segment, "submitted_at": TS}
    if domain == "subscribers":
        cat = {"mobile": "mobile_internet", "fixed_voice": "fixed_voice", "fixed_broadband": "fixed_broadband"}[segment]
        row.update(service_category=cat, payment_type="prepaid", technology_generation="4G" if cat == "mobile_internet" else None,
                   total_subscribers=100, active_subscribers_30d=90, new_activations=5, churn_count=2, arpu_xaf=Decimal("12.50"))
    elif domain == "traffic_voice":
        mob = segment == "mobile"
        for c in tc.VOICE_MOBILE:
            row[c] = 10 if mob else 0
        for c in tc.VOICE_FIXED:
            row[c] = 0 if mob else 10
    elif domain == "traffic_sms":
        for c in tc.SMS_COLS:
            row[c] = 3
    elif domain == "traffic_internet":
        mob = segment == "mobile"
        for c in tc.DATA_MOBILE:
            row[c] = Decimal("1.5") if mob else None
        for c in tc.DATA_FIXED:
            row[c] = None if mob else Decimal("2.5")
    elif domain == "qos":
        row.update(measurement_methodology="regulator_audit", period_type="monthly", qos_related_complaints=4)
        for c, _ in tc.DOMAIN_DEFS["qos"].business:
            row.setdefault(c, None)
        row["network_availability_pct"] = Decimal("99.5")
        if segment == "mobile":
            row.update(call_drop_rate_pct=Decimal("1.2"), call_setup_success_rate_pct=Decimal("98"),
                       avg_data_throughput_mbps_4g=Decimal("20"), avg_data_throughput_mbps_3g=Decimal("5"), avg_latency_ms=40)
        elif segment == "fixed_voice":
            row.update(fixed_service_repair_time_hours=Decimal("12"))
        else:
            row.update(avg_fixed_download_mbps=Decimal("50"), avg_fixed_upload_mbps=Decimal("10"), avg_latency_ms=20,
                       avg_packet_loss_pct=Decimal("0.5"), fixed_broadband_coverage_pct=Decimal("40"),
                       fixed_service_repair_time_hours=Decimal("24"))
    elif domain == "revenue":
        del row["region_code"]
        for c in tc.REV_COMPONENTS:
            row[c] = 0
        if segment == "mobile":
            row.update(revenue_internet_4g_xaf=600, revenue_voice_outgoing_onnet_xaf=400)
        elif segment == "fixed_voice":
            row.update(revenue_fixed_voice_subscription_xaf=600, revenue_fixed_voice_usage_xaf=400)
        else:
            row.update(revenue_fixed_broadband_subscription_xaf=600, revenue_fixed_broadband_usage_xaf=400)
        row.update(total_revenue_xaf=1000, usf_contribution_xaf=20)
    row["_source_file"], row["_source_line"], row["_loaded_at"], row["_loaded_by_run_id"], row["_raw_payload"] = (
        "f.csv", 2, TS, "r", "{}")
    return row


def _schema(domain):
    # all nullable so the missing-value rules can be probed
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in tc.DOMAIN_DEFS[domain].bronze_schema().fields])


def codes(spark, domain, rows):
    schema = _schema(domain)
    df = spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)
    pack = tc.pack(domain, tc.operators_df(spark), tc.regions_df(spark), AS_OF)
    return [r[CODES] for r in validate_pack(df, pack).orderBy("bronze_id").collect()]


def test_rule_counts(spark):
    n = {d: len(tc.rules_for(d, AS_OF)) for d in tc.DOMAINS}
    assert n == {"subscribers": 33, "traffic_voice": 34, "traffic_sms": 20, "traffic_internet": 27, "qos": 50, "revenue": 42}


@pytest.mark.parametrize("domain,segment", [(d, s) for d in tc.DOMAINS for s in tc.DOMAIN_SEGMENTS[d]])
def test_clean_rows_pass(spark, domain, segment):
    assert codes(spark, domain, [clean(domain, segment)]) == [[]]


def _with(domain, segment, **kw):
    r = clean(domain, segment)
    r.update(kw)
    return r


CASES = [
    ("subscribers", "mobile", {"operator_id": None}, ["missing_operator", "unknown_operator"]),
    ("subscribers", "mobile", {"service_segment": None}, ["missing_service_segment"]),
    ("subscribers", "mobile", {"report_period": "2025-03\n"}, ["invalid_period_format"]),
    ("subscribers", "mobile", {"report_period": "2017-12"}, ["period_too_old"]),
    ("subscribers", "mobile", {"report_period": "2025-09"}, ["period_in_future"]),
    ("subscribers", "mobile", {"operator_id": "OPA03"}, ["segment_not_licensed"]),
    ("subscribers", "mobile", {"active_subscribers_30d": 106}, ["active_exceeds_total"]),
    ("subscribers", "mobile", {"active_subscribers_30d": 105}, []),
    ("subscribers", "mobile", {"technology_generation": "6G"}, ["unknown_technology_generation"]),
    ("subscribers", "fixed_voice", {"technology_generation": "4G"}, ["tech_generation_on_non_internet"]),
    ("subscribers", "fixed_voice", {"service_category": "mobile_telephony"}, ["service_category_mismatch_fixed_voice"]),
    ("subscribers", "mobile", {"region_code": "XXX"}, ["unknown_region"]),
    ("traffic_voice", "mobile", {"voice_minutes_fixed_local": -5}, ["mobile_has_fixed_voice_minutes", "negative_fixed_local"]),
    ("traffic_voice", "fixed_voice", {"voice_minutes_fixed_local": None}, ["fixed_missing_local_minutes"]),
    ("traffic_sms", "mobile", {"sms_count_incoming_national": None}, ["missing_incoming_national"]),
    ("traffic_internet", "mobile", {"data_consumed_mb_fiber": Decimal("1")}, ["mobile_has_fixed_broadband_data"]),
    ("traffic_internet", "mobile", {"data_consumed_mb_5g": None}, []),
    ("qos", "mobile", {"avg_latency_ms": 5001}, ["latency_implausible"]),
    ("qos", "mobile", {"avg_packet_loss_pct": Decimal("1")}, ["mobile_has_fixed_qos_columns"]),
    ("qos", "fixed_voice", {"avg_latency_ms": 10}, ["fixed_voice_has_unrelated_qos_columns"]),
    ("qos", "mobile", {"measurement_methodology": "guess", "period_type": None}, ["unknown_methodology", "missing_period_type"]),
    ("revenue", "mobile", {"total_revenue_xaf": 1011}, ["component_sum_mismatch"]),
    ("revenue", "mobile", {"total_revenue_xaf": 1010}, []),
    ("revenue", "mobile", {"usf_contribution_xaf": 101}, ["usf_rate_implausibly_high"]),
    ("revenue", "mobile", {"total_revenue_xaf": 0}, ["zero_total_with_components"]),
    ("revenue", "fixed_voice", {"revenue_sms_incoming_xaf": -1, "total_revenue_xaf": 999},
     ["fixed_voice_has_unrelated_revenue", "negative_sms_incoming"]),
    ("revenue", "mobile", {"revenue_internet_4g_xaf": 0, "total_revenue_xaf": 400}, ["mobile_missing_4g_revenue"]),
]


@pytest.mark.parametrize("domain,segment,change,expected", CASES)
def test_defects(spark, domain, segment, change, expected):
    assert codes(spark, domain, [_with(domain, segment, **change)]) == [expected]


def test_derived_totals(spark):
    from strata.operators.validate import silver_rows, split

    schema = tc.DOMAIN_DEFS["revenue"].bronze_schema()
    row = _with("revenue", "mobile", usf_contribution_xaf=37)
    df = spark.createDataFrame([tuple(row.get(f.name) for f in schema.fields)], schema)
    pack = tc.pack("revenue", tc.operators_df(spark), tc.regions_df(spark), AS_OF)
    valid, _ = split(validate_pack(df, pack))
    s = silver_rows(valid, "r", pack.derived).first()
    assert s["components_sum_xaf"] == 1000 and s["sum_check_delta_xaf"] == 0
    assert s["usf_contribution_rate_pct"] == Decimal("3.700") and str(s["period_start_date"]) == "2025-03-01"
