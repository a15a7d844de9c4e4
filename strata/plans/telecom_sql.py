"""DuckDB SQL of the telecom flow: submissions, the six rule packs, silver, markers and marts.

A second, independent statement of what ``telecom_bronze``, the rule packs and
``medallion.process`` compute, for the SQL check. Rules are written here as
(code, predicate) in the order in which codes are reported; every factor is
integer arithmetic, so nothing depends on how an engine divides decimals.
"""

from __future__ import annotations

from ..domains import telecom as tc
from ..operators.events import METRIC_NAMES
from .registry import avg_sql, pct_sql

BAD_DROP = "k % 7919 = 11"  # such a row claims another operator than its drop, which goes whole

_text = lambda values: ", ".join(f"'{v}'" for v in values)
OPERATORS_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{i}', [{_text(segs)}])" for i, _, _, segs, *_ in tc.OPERATORS) + ") AS t(dim_operator_id, dim_service_segments)"
REGIONS_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{r[0]}', {i})" for i, r in enumerate(tc.REGIONS)) + ") AS t(dim_region_code, place)"

# --- submissions ---------------------------------------------------------------

_CUSTOMERS = f"""
  SELECT c_custkey, seg AS service_segment, dim_region_code AS region_code,
         CASE seg WHEN 'mobile' THEN 'OPA0' || (n % 2 + 1) WHEN 'fixed_voice' THEN 'OPA03' ELSE 'OPA0' || (n % 5 + 3) END AS operator_id
  FROM (SELECT c_custkey, c_nationkey AS n,
               CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'mobile' WHEN c_mktsegment = 'FURNITURE' THEN 'fixed_voice' ELSE 'fixed_broadband' END AS seg
        FROM customer) JOIN ({REGIONS_SQL}) ON place = c_custkey % {len(tc.REGIONS)}
"""
_month = lambda ts: f"strftime({ts} + INTERVAL 25 YEAR, '%Y-%m')"
_ORDERS = f"""
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, {_month('o_orderdate')} AS report_period,
         CAST(trunc(o_totalprice) AS BIGINT) AS base, CAST(trunc(o_totalprice / 10) AS BIGINT) AS tenth, operator_id, service_segment, region_code
  FROM orders JOIN ({_CUSTOMERS}) ON o_custkey = c_custkey
"""
_LINES = f"""
  SELECT l_orderkey * 8 + l_linenumber AS k, l_orderkey || '-' || l_linenumber AS number, CAST(trunc(l_quantity) AS BIGINT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,3)) AS mb, {_month('l_shipdate')} AS report_period, operator_id, service_segment, region_code,
         service_segment = 'mobile' AS mobile
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN ({_CUSTOMERS}) ON o_custkey = c_custkey
"""
_BASE = "k, operator_id, service_segment, region_code, report_period, TIMESTAMP '2000-01-01' AS submitted_at"

# percent of an order's price that each revenue component takes; the rest is 'other'
_MOBILE_PCT = (20, 10, 5, 5, 5, 2, 2, 2, 2, 3, 5, 25, 4, 0, 0, 0, 0, 0, 3)
_VOICE_PCT = (0,) * 13 + (50, 40, 0, 0, 5, 0)
_BROADBAND_PCT = (0,) * 15 + (60, 30, 5, 3)


def _revenue() -> str:
    cut = lambda p: f"base * {p} // 100"
    named = tc.REV_COMPONENTS[:-1]
    parts = {c: f"CASE service_segment WHEN 'mobile' THEN {cut(m)} WHEN 'fixed_voice' THEN {cut(v)} ELSE {cut(b)} END"
             for c, m, v, b in zip(named, _MOBILE_PCT, _VOICE_PCT, _BROADBAND_PCT, strict=True)}
    inner = ", ".join(f"{x} AS {c}" for c, x in parts.items())
    return f"""
      SELECT 'REV-' || k AS source_submission_id, k, operator_id, service_segment, report_period, TIMESTAMP '2000-01-01' AS submitted_at,
             {', '.join(named)}, base - ({' + '.join(named)}) AS {tc.REV_COMPONENTS[-1]},
             CASE WHEN k % 89 = 4 THEN base * 112 // 100 ELSE base END AS total_revenue_xaf,
             CASE WHEN k % 83 = 2 THEN base * 15 // 100 ELSE base * 2 // 100 END AS usf_contribution_xaf
      FROM (SELECT *, {inner} FROM ({_ORDERS}))"""


def _voice() -> str:
    first, *rest = tc.VOICE_MOBILE
    cols = [f"CASE WHEN mobile AND k % 71 = 9 THEN -quantity * 100 WHEN mobile THEN quantity * 100 ELSE 0 END AS {first}"]
    cols += [f"CASE WHEN mobile THEN quantity * {100 * i} ELSE 0 END AS {c}" for i, c in enumerate(rest, 2)]
    cols += [f"CASE WHEN NOT mobile THEN quantity * {100 * i} END AS {c}" for i, c in enumerate(tc.VOICE_FIXED, 2)]
    return f"SELECT 'VOI-' || number AS source_submission_id, {_BASE}, {', '.join(cols)} FROM ({_LINES}) WHERE service_segment IN ('mobile', 'fixed_voice')"


def _sms() -> str:
    cols = [f"quantity * {10 * i} AS {c}" for i, c in enumerate(tc.SMS_COLS[:3], 1)] + [f"CASE WHEN k % 67 <> 2 THEN quantity * 40 END AS {tc.SMS_COLS[3]}"]
    return f"SELECT 'SMS-' || number AS source_submission_id, {_BASE}, {', '.join(cols)} FROM ({_LINES}) WHERE mobile"


def _internet() -> str:
    cols = [f"CASE WHEN mobile THEN mb * {i} END AS {c}" for i, c in enumerate(tc.DATA_MOBILE, 1)]
    cols += [f"CASE WHEN NOT mobile THEN mb * {i} WHEN {i} = 1 AND k % 73 = 5 THEN mb ELSE 0 END AS {c}" for i, c in enumerate(tc.DATA_FIXED, 1)]
    return f"SELECT 'INT-' || number AS source_submission_id, {_BASE}, {', '.join(cols)} FROM ({_LINES}) WHERE service_segment IN ('mobile', 'fixed_broadband')"


def _qos() -> str:
    pct = lambda low, span: f"CAST(LEAST({low * 100} + cents % {span * 100}, 10000) AS DECIMAL(18,3)) / 100"
    mobile = {"call_drop_rate_pct": pct(0, 5), "call_setup_success_rate_pct": pct(90, 10), "avg_data_throughput_mbps_4g": "cents / 1000",
              "avg_data_throughput_mbps_3g": "(cents + 2) // 4 / 1000", "population_coverage_pct_4g": pct(50, 50), "population_coverage_pct_3g": pct(60, 40),
              "population_coverage_pct_2g": pct(70, 30)}
    broadband = {"avg_fixed_download_mbps": "cents / 500", "avg_fixed_upload_mbps": "(cents + 1) // 2 / 1000", "avg_packet_loss_pct": pct(0, 3),
                 "fixed_broadband_coverage_pct": pct(40, 60)}
    only = lambda seg, cols: [f"CASE WHEN service_segment = '{seg}' THEN CAST({x} AS DECIMAL(8,3)) END AS {c}" for c, x in cols.items()]
    methods = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(tc.QOS_METHODOLOGIES))
    return f"""
      SELECT 'QOS-' || k AS source_submission_id, {_BASE}, CASE k % 3 {methods} END AS measurement_methodology, 'monthly' AS period_type,
             CAST({pct(90, 10)} AS DECIMAL(6,3)) AS network_availability_pct, {', '.join(only('mobile', mobile) + only('fixed_broadband', broadband))},
             CASE WHEN service_segment = 'fixed_voice' THEN NULL WHEN k % 41 = 6 THEN 6000 ELSE k % 400 + 10 END AS avg_latency_ms,
             CASE WHEN service_segment <> 'mobile' THEN CAST((cents % 4800 + 100) / 100 AS DECIMAL(8,3)) END AS fixed_service_repair_time_hours,
             user_id % 50 AS qos_related_complaints
      FROM (SELECT event_id AS k, user_id, strftime(ts, '%Y-%m') AS report_period, CAST(round(value * 100) AS BIGINT) AS cents,
                   operator_id, service_segment, region_code FROM events JOIN ({_CUSTOMERS}) ON user_id = c_custkey)"""


def _subscribers() -> str:
    techs = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(tc.TECHNOLOGY_GENERATIONS))
    return f"""
      SELECT 'SUB-' || k AS source_submission_id, {_BASE}, category AS service_category,
             CASE WHEN o_orderstatus = 'F' THEN 'postpaid' ELSE 'prepaid' END AS payment_type,
             CASE WHEN k % 97 = 5 THEN '6G' WHEN category = 'mobile_internet' THEN CASE k % 4 {techs} END END AS technology_generation,
             tenth AS total_subscribers, CASE WHEN k % 101 = 7 THEN tenth * 2 ELSE tenth * 9 // 10 END AS active_subscribers_30d,
             k % 1000 AS new_activations, CASE WHEN k % 113 = 3 THEN -(o_custkey % 500) - 1 ELSE o_custkey % 500 END AS churn_count,
             CAST((CAST(round(o_totalprice * 100) AS BIGINT) + 50) // 100 / 100 AS DECIMAL(10,2)) AS arpu_xaf
      FROM (SELECT *, CASE WHEN service_segment <> 'mobile' THEN service_segment
                           WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'mobile_internet' ELSE 'mobile_telephony' END AS category FROM ({_ORDERS}))"""


SUBMISSIONS = {"subscribers": _subscribers(), "traffic_voice": _voice(), "traffic_sms": _sms(), "traffic_internet": _internet(), "qos": _qos(), "revenue": _revenue()}
# code and modulus, rest of the submission number of each domain's marked rows
MARKERS = {"subscribers": ("arpu_spike", 53, 1), "traffic_voice": ("voice_traffic_spike", 61, 1), "traffic_sms": ("sms_traffic_spike", 61, 2),
           "traffic_internet": ("internet_traffic_spike", 61, 3), "qos": ("complaint_spike", 47, 1), "revenue": ("revenue_spike", 59, 1)}
assert {c for c, _, _ in MARKERS.values()} <= {c for c, _ in METRIC_NAMES} | {"revenue_spike"}


def bronze(domain: str) -> str:
    """Rows of the domain's accepted drops, with an id of the drop and the row's values."""
    drop = "service_segment, operator_id, report_period"
    file = f"service_segment || '/' || operator_id || '/{domain}/' || report_period[1:4] || '/' || report_period[6:7]"
    values = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in tc.DOMAIN_DEFS[domain].business_names)
    return f"""SELECT *, sha256(concat_ws(':', '{domain}', source_submission_id, {file}, {values})) AS bronze_id
      FROM ({SUBMISSIONS[domain]}) ANTI JOIN (SELECT DISTINCT {drop} FROM ({SUBMISSIONS[domain]}) WHERE {BAD_DROP}) USING ({drop})"""


# --- rules -----------------------------------------------------------------------

MOB, FV, FBB = (f"service_segment = '{s}'" for s in ("mobile", "fixed_voice", "fixed_broadband"))


def _null(code: str, col: str, when: str = "TRUE") -> tuple[str, str]:
    return code, f"{when} AND {col} IS NULL"


def _unlisted(code: str, col: str, allowed: str, when: str = "TRUE") -> tuple[str, str]:
    """``allowed``: the accepted words, space-separated."""
    return code, f"{when} AND {col} NOT IN ({_text(allowed.split())})"


def _below_zero(code: str, col: str) -> tuple[str, str]:
    return code, f"{col} < 0"


def _outside(code: str, col: str, high: int = 100) -> tuple[str, str]:
    return code, f"{col} NOT BETWEEN 0 AND {high}"


def _some(code: str, when: str, prefix: str, names: str, test: str) -> tuple[str, str]:
    """Any of the columns ``prefix`` + name meets ``test``."""
    return code, f"{when} AND (" + " OR ".join(test.format(prefix + n) for n in names.split()) + ")"


NONZERO, ZERO, PRESENT = "COALESCE({0}, 0) <> 0", "COALESCE({0}, 0) = 0", "{0} IS NOT NULL"


def _head(as_of: str, region: bool = True) -> list[tuple[str, str]]:
    shaped = "regexp_full_match(report_period, '[0-9]{4}-(0[1-9]|1[0-2])')"
    out = [_null("missing_operator", "operator_id"), _null("unknown_operator", "dim_operator_id"), _null("missing_report_period", "report_period"),
           ("invalid_period_format", f"NOT {shaped}"), ("period_too_old", f"{shaped} AND report_period < '2018-01'"),
           ("period_in_future", f"{shaped} AND report_period || '-01' > strftime(DATE '{as_of}' + INTERVAL 1 MONTH, '%Y-%m-%d')")]
    if region:
        out += [_null("missing_region", "region_code"), _null("unknown_region", "dim_region_code")]
    return [*out, _null("missing_service_segment", "service_segment")]


_LICENCE = ("segment_not_licensed", "dim_operator_id IS NOT NULL AND NOT list_contains(dim_service_segments, service_segment)")
_SENT = _null("missing_submitted_at", "submitted_at")


def _subscriber_rules() -> list[tuple[str, str]]:
    internet = "service_category = 'mobile_internet'"
    out = [_unlisted("unknown_service_segment", "service_segment", "mobile fixed_voice fixed_broadband postal satellite"), _LICENCE,
           _null("missing_service_category", "service_category"),
           _unlisted("unknown_service_category", "service_category", "mobile_telephony mobile_internet fixed_voice fixed_broadband"),
           _unlisted("service_category_mismatch_mobile", "service_category", "mobile_telephony mobile_internet", MOB),
           _unlisted("service_category_mismatch_fixed_voice", "service_category", "fixed_voice", FV),
           _unlisted("service_category_mismatch_fixed_broadband", "service_category", "fixed_broadband", FBB),
           _null("missing_payment_type", "payment_type"), _unlisted("unknown_payment_type", "payment_type", "prepaid postpaid")]
    for col, missing, negative in (("total_subscribers", "total_subscribers", "subscribers"), ("active_subscribers_30d", "active_subscribers_30d", "active")):
        out += [_null(f"missing_{missing}", col), _below_zero(f"negative_{negative}", col)]
    out.append(("active_exceeds_total", "CAST(active_subscribers_30d AS HUGEINT) * 100 > CAST(total_subscribers AS HUGEINT) * 105"))
    for col, missing, negative in (("new_activations", "new_activations", "activations"), ("churn_count", "churn_count", "churn"), ("arpu_xaf", "arpu", "arpu")):
        out += [_null(f"missing_{missing}", col), _below_zero(f"negative_{negative}", col)]
    return out + [_null("missing_tech_generation_for_internet", "technology_generation", internet),
                  _unlisted("unknown_technology_generation", "technology_generation", "2G 3G 4G 5G", internet),
                  ("tech_generation_on_non_internet", "service_category <> 'mobile_internet' AND technology_generation IS NOT NULL")]


_MOBILE_MINUTES = "outgoing_onnet outgoing_offnet outgoing_international incoming_national incoming_international"
_FIXED_MINUTES = "fixed_local fixed_national fixed_international_outgoing fixed_incoming_national fixed_incoming_international"


def _voice_rules() -> list[tuple[str, str]]:
    vm = "voice_minutes_"
    absent_fixed = "local_minutes national_minutes international_outgoing incoming_national incoming_international"
    return [_unlisted("voice_unsupported_segment", "service_segment", "mobile fixed_voice"), _LICENCE,
            *[_null(f"mobile_missing_{n}", vm + n, MOB) for n in _MOBILE_MINUTES.split()],
            _some("mobile_has_fixed_voice_minutes", MOB, vm, _FIXED_MINUTES, NONZERO),
            *[_null(f"fixed_missing_{code}", vm + n, FV) for code, n in zip(absent_fixed.split(), _FIXED_MINUTES.split())],
            _some("fixed_has_mobile_voice_minutes", FV, vm, _MOBILE_MINUTES, NONZERO),
            *[_below_zero(f"negative_{n}", vm + n) for n in f"{_MOBILE_MINUTES} {_FIXED_MINUTES}".split()]]


def _sms_rules() -> list[tuple[str, str]]:
    names = "outgoing_onnet outgoing_offnet outgoing_international incoming_national".split()
    return [("sms_only_supported_for_mobile", "service_segment <> 'mobile'"), _LICENCE,
            *[_null(f"missing_{n}", f"sms_count_{n}") for n in names], *[_below_zero(f"negative_{n}", f"sms_count_{n}") for n in names]]


def _internet_rules() -> list[tuple[str, str]]:
    mb, fixed, cells = "data_consumed_mb_", "fiber adsl fixed_wireless", "2g 3g 4g 5g"
    return [_unlisted("internet_unsupported_segment", "service_segment", "mobile fixed_broadband"), _LICENCE,
            *[_null(f"mobile_missing_{n}_data", mb + n, MOB) for n in ("2g", "3g", "4g")],
            _some("mobile_has_fixed_broadband_data", MOB, mb, fixed, NONZERO),
            *[_null(f"fixed_broadband_missing_{n}_data", mb + n, FBB) for n in fixed.split()],
            _some("fixed_broadband_has_mobile_generation_data", FBB, mb, cells, NONZERO),
            *[_below_zero(f"negative_{n}_data", mb + n) for n in f"{cells} {fixed}".split()]]


def _qos_rules() -> list[tuple[str, str]]:
    cells = "population_coverage_pct_4g population_coverage_pct_3g population_coverage_pct_2g"
    calls = "call_drop_rate_pct call_setup_success_rate_pct avg_data_throughput_mbps_4g avg_data_throughput_mbps_3g"
    lines = "avg_fixed_download_mbps avg_fixed_upload_mbps avg_packet_loss_pct fixed_broadband_coverage_pct"
    return [_unlisted("qos_unsupported_segment", "service_segment", "mobile fixed_voice fixed_broadband"), _LICENCE,
            _null("missing_methodology", "measurement_methodology"),
            _unlisted("unknown_methodology", "measurement_methodology", "operator_self_reported regulator_audit independent_drive_test"),
            _null("missing_period_type", "period_type"), _unlisted("unknown_period_type", "period_type", "monthly weekly daily realtime"),
            _null("mobile_missing_availability", "network_availability_pct", MOB), _null("mobile_missing_drop_rate", "call_drop_rate_pct", MOB),
            _null("mobile_missing_setup_success", "call_setup_success_rate_pct", MOB), _null("mobile_missing_4g_throughput", "avg_data_throughput_mbps_4g", MOB),
            _null("mobile_missing_3g_throughput", "avg_data_throughput_mbps_3g", MOB), _null("mobile_missing_latency", "avg_latency_ms", MOB),
            _some("mobile_has_fixed_qos_columns", MOB, "", f"{lines} fixed_service_repair_time_hours", PRESENT),
            _null("fixed_voice_missing_availability", "network_availability_pct", FV), _null("fixed_voice_missing_repair_time", "fixed_service_repair_time_hours", FV),
            _some("fixed_voice_has_unrelated_qos_columns", FV, "", f"{calls} avg_latency_ms {cells} {lines}", PRESENT),
            _null("fixed_broadband_missing_availability", "network_availability_pct", FBB), _null("fixed_broadband_missing_download", "avg_fixed_download_mbps", FBB),
            _null("fixed_broadband_missing_upload", "avg_fixed_upload_mbps", FBB), _null("fixed_broadband_missing_latency", "avg_latency_ms", FBB),
            _null("fixed_broadband_missing_packet_loss", "avg_packet_loss_pct", FBB), _null("fixed_broadband_missing_coverage", "fixed_broadband_coverage_pct", FBB),
            _null("fixed_broadband_missing_repair_time", "fixed_service_repair_time_hours", FBB),
            _some("fixed_broadband_has_mobile_qos_columns", FBB, "", f"{calls} {cells}", PRESENT),
            _outside("availability_out_of_range", "network_availability_pct"), _outside("drop_rate_out_of_range", "call_drop_rate_pct"),
            _outside("setup_success_out_of_range", "call_setup_success_rate_pct"), _below_zero("negative_4g_throughput", "avg_data_throughput_mbps_4g"),
            _below_zero("negative_3g_throughput", "avg_data_throughput_mbps_3g"), _outside("latency_implausible", "avg_latency_ms", 5000),
            *[_outside(f"coverage_{g}_out_of_range", f"population_coverage_pct_{g}") for g in ("4g", "3g", "2g")],
            _below_zero("negative_fixed_download", "avg_fixed_download_mbps"), _below_zero("negative_fixed_upload", "avg_fixed_upload_mbps"),
            _outside("packet_loss_out_of_range", "avg_packet_loss_pct"), _outside("fixed_coverage_out_of_range", "fixed_broadband_coverage_pct"),
            _below_zero("negative_repair_time", "fixed_service_repair_time_hours"),
            _null("missing_complaints", "qos_related_complaints"), _below_zero("negative_complaints", "qos_related_complaints")]


def _revenue_rules() -> list[tuple[str, str]]:
    cells = ("voice_outgoing_onnet_xaf voice_outgoing_offnet_xaf voice_outgoing_international_xaf voice_incoming_national_xaf voice_incoming_international_xaf "
             "sms_outgoing_onnet_xaf sms_outgoing_offnet_xaf sms_outgoing_international_xaf sms_incoming_xaf internet_2g_xaf internet_3g_xaf internet_4g_xaf internet_5g_xaf")
    fv, fbb = "fixed_voice_subscription_xaf fixed_voice_usage_xaf", "fixed_broadband_subscription_xaf fixed_broadband_usage_xaf"
    all_parts = f"{cells} {fv} {fbb} equipment_rental_xaf value_added_services_xaf other_xaf".split()
    total = "CAST(total_revenue_xaf AS HUGEINT)"
    parts = "(" + " + ".join(f"COALESCE(CAST(revenue_{c} AS HUGEINT), 0)" for c in all_parts) + ")"
    # codes leave out the direction of calls and messages and the currency
    short = lambda c: c.removesuffix("_xaf").replace("_outgoing", "").replace("other", "other_revenue")
    return [_unlisted("revenue_unsupported_segment", "service_segment", "mobile fixed_voice fixed_broadband"), _LICENCE,
            _some("mobile_missing_4g_revenue", MOB, "revenue_", "internet_4g_xaf", ZERO),
            _some("mobile_has_fixed_revenue", MOB, "revenue_", f"{fv} {fbb} equipment_rental_xaf", NONZERO),
            _some("fixed_voice_missing_revenue_components", FV, "revenue_", fv, ZERO),
            _some("fixed_voice_has_unrelated_revenue", FV, "revenue_", f"{cells} {fbb} value_added_services_xaf", NONZERO),
            _some("fixed_broadband_missing_revenue_components", FBB, "revenue_", fbb, ZERO),
            _some("fixed_broadband_has_unrelated_revenue", FBB, "revenue_", f"{cells} {fv}", NONZERO),
            _null("missing_total_revenue", "total_revenue_xaf"), _below_zero("negative_total_revenue", "total_revenue_xaf"),
            ("zero_total_with_components", f"total_revenue_xaf = 0 AND {parts} > 0"),
            ("component_sum_mismatch", f"total_revenue_xaf > 0 AND abs({total} - {parts}) * 100 > {total}"),
            *[_below_zero(f"negative_{short(c)}", f"revenue_{c}") for c in all_parts],
            _below_zero("negative_usf_contribution", "usf_contribution_xaf"),
            ("usf_rate_implausibly_high", f"total_revenue_xaf > 0 AND CAST(usf_contribution_xaf AS HUGEINT) * 10 > {total}")]


_RULES = {"subscribers": _subscriber_rules, "traffic_voice": _voice_rules, "traffic_sms": _sms_rules, "traffic_internet": _internet_rules,
          "qos": _qos_rules, "revenue": _revenue_rules}


def rules(domain: str, as_of: str) -> list[tuple[str, str]]:
    return [*_head(as_of, domain != "revenue"), *_RULES[domain](), _SENT]


def judged(domain: str, as_of: str, rows: str | None = None) -> str:
    """Rows (the accepted ones unless given) with ``codes``, the failed rules in order."""
    found = ", ".join(f"CASE WHEN {p} THEN '{code}' END" for code, p in rules(domain, as_of))
    region = "" if domain == "revenue" else f"LEFT JOIN ({REGIONS_SQL}) ON region_code = dim_region_code"
    return f"""SELECT *, list_filter([{found}], lambda x: x IS NOT NULL) AS codes
      FROM ({rows or bronze(domain)}) LEFT JOIN ({OPERATORS_SQL}) ON operator_id = dim_operator_id {region}"""


# --- the five queries ----------------------------------------------------------------


def _union(select: str, as_of: str) -> str:
    """``select`` over every domain's judged rows; ``{d}`` is the domain, ``{rows}`` its rows."""
    return " UNION ALL ".join(select.format(d=d, rows=judged(d, as_of)) for d in tc.DOMAINS)


def validation(as_of: str) -> str:
    return _union("SELECT '{d}' AS domain, COUNT(*) AS rows_processed, COUNT(*) FILTER (WHERE len(codes) = 0) AS rows_validated, "
                  "COUNT(*) FILTER (WHERE len(codes) > 0) AS rows_rejected FROM ({rows})", as_of)


def rejections(as_of: str) -> str:
    found = _union("SELECT '{d}' AS domain, report_period, operator_id, unnest(codes) AS code FROM ({rows})", as_of)
    return f"SELECT domain, report_period, operator_id, code, COUNT(*) AS rejected_rows FROM ({found}) GROUP BY ALL"


def silver(domain: str, as_of: str) -> str:
    """One valid row per business key: all rows of a key come from one drop, so the greatest bronze id stays."""
    key = ", ".join(tc.DOMAIN_DEFS[domain].key)
    return f"""SELECT * FROM ({judged(domain, as_of)}) WHERE len(codes) = 0
      QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY bronze_id DESC) = 1"""


def events(as_of: str) -> str:
    """Marked rows that are in silver; none of their codes is a critical one, all are new and open."""
    return " UNION ALL ".join(
        f"SELECT report_period, '{d}' AS domain, 'warning' AS severity, operator_id, service_segment, '{code}' AS event_code FROM ({silver(d, as_of)}) WHERE k % {m} = {r}"
        for d, (code, m, r) in MARKERS.items())


def open_events(as_of: str) -> str:
    return f"SELECT *, COUNT(*) AS open_event_count FROM ({events(as_of)}) GROUP BY ALL"


def scorecard(as_of: str) -> str:
    stack = " UNION ALL BY NAME ".join([
        f"SELECT report_period, operator_id, service_segment, total_subscribers, active_subscribers_30d FROM ({silver('subscribers', as_of)})",
        f"SELECT report_period, operator_id, service_segment, total_revenue_xaf FROM ({silver('revenue', as_of)})",
        f"SELECT report_period, operator_id, service_segment, network_availability_pct, avg_latency_ms, qos_related_complaints FROM ({silver('qos', as_of)})",
        f"SELECT report_period, operator_id, service_segment, 1 AS event FROM ({events(as_of)})"])
    total = lambda c: f"CAST(COALESCE(SUM({c}), 0) AS BIGINT)"
    return f"""
WITH k AS (
  SELECT report_period, operator_id, service_segment, {total('total_subscribers')} AS total_subscribers,
         {total('active_subscribers_30d')} AS active_subscribers_30d, {total('total_revenue_xaf')} AS total_revenue_xaf,
         {avg_sql('network_availability_pct', 3, 7, 'DECIMAL(10,7)')} AS avg_network_availability_pct, AVG(avg_latency_ms) AS avg_latency_ms,
         {total('qos_related_complaints')} AS qos_related_complaints, {total('event')} AS open_quality_events, CAST(0 AS BIGINT) AS open_critical_quality_events
  FROM ({stack}) GROUP BY ALL),
t AS (SELECT report_period, service_segment, SUM(total_subscribers) AS subs, SUM(total_revenue_xaf) AS rev FROM k GROUP BY ALL)
SELECT k.*, {pct_sql('total_subscribers', 'subs')} AS subscriber_market_share_pct, {pct_sql('total_revenue_xaf', 'rev')} AS revenue_market_share_pct
FROM k JOIN t USING (report_period, service_segment)
"""


def run_health(as_of: str, at: str) -> str:
    """No event is critical, so no default threshold is reached and no alert counts."""
    seen = _union("SELECT report_period, len(codes) > 0 AS rejected FROM ({rows})", as_of)
    return f"""
WITH m AS (SELECT report_period, COUNT(*) AS n, COUNT(*) FILTER (WHERE rejected) AS bad FROM ({seen}) GROUP BY ALL),
e AS (SELECT report_period, COUNT(*) AS events FROM ({events(as_of)}) GROUP BY ALL)
SELECT report_period, TIMESTAMP '{at}' AS validation_started_at, TIMESTAMP '{at}' AS validation_window_start, n AS rows_ingested, n AS rows_processed,
       n - bad AS rows_validated, bad AS rows_rejected, COALESCE(events, 0) AS events_captured, CAST(0 AS BIGINT) AS alerts_triggered,
       CASE WHEN bad > 0 THEN 'attention' WHEN events > 0 THEN 'watch' ELSE 'healthy' END AS run_health
FROM m LEFT JOIN e USING (report_period)
"""


URBAN_MOBILE = f"""
SELECT CASE WHEN region_code IN ('BZV', 'PNR') THEN 'urban' ELSE 'south' END AS area, region_code, operator_id, COUNT(*) AS customers
FROM ({_CUSTOMERS}) WHERE operator_id IN ('OPA01', 'OPA02') AND region_code IN ('BZV', 'PNR', 'BOU', 'LEK', 'NIA') GROUP BY ALL
"""
