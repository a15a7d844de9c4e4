"""The telecom regulator domain pack: six submission domains as data.

Schemas, reference tables, licence matrix and the rule lists of every
domain. Nothing here executes; ``pack()`` returns a ``RulePack`` whose rules
are Column expressions evaluated by ``operators.validate``.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import rules as R
from ..operators.validate import DimLookup, RulePack
from ..session import small_table

# ---------------------------------------------------------------------------
# Fixed values (must equal the regulator's published reference data).
# ---------------------------------------------------------------------------
SERVICE_SEGMENTS = ("mobile", "fixed_voice", "fixed_broadband")
# The subscriber rule also accepts these two legacy segment names.
SUBSCRIBER_RULE_SEGMENTS = ("mobile", "fixed_voice", "fixed_broadband", "postal", "satellite")
SERVICE_CATEGORIES = ("mobile_telephony", "mobile_internet", "fixed_voice", "fixed_broadband")
PAYMENT_TYPES = ("prepaid", "postpaid")
TECHNOLOGY_GENERATIONS = ("2G", "3G", "4G", "5G")
QOS_METHODOLOGIES = ("operator_self_reported", "regulator_audit", "independent_drive_test")
QOS_PERIOD_TYPES = ("monthly", "weekly", "daily", "realtime")
DOMAINS = ("subscribers", "traffic_voice", "traffic_sms", "traffic_internet", "qos", "revenue")
# Which segments submit which domain.
DOMAIN_SEGMENTS = {
    "subscribers": ("mobile", "fixed_voice", "fixed_broadband"),
    "traffic_voice": ("mobile", "fixed_voice"),
    "traffic_sms": ("mobile",),
    "traffic_internet": ("mobile", "fixed_broadband"),
    "qos": ("mobile", "fixed_voice", "fixed_broadband"),
    "revenue": ("mobile", "fixed_voice", "fixed_broadband"),
}
# Licensed operators: id, name, type, licensed segments, licence date, state owned, MVNO.
OPERATORS = (
    ("OPA01", "Mokongo Mobile", "mobile", ("mobile",), "2005-04-15", False, False),
    ("OPA02", "Sangha Telecom", "mobile", ("mobile",), "2007-09-22", False, False),
    ("OPA03", "Congo Réseau", "fixed", ("fixed_voice", "fixed_broadband"), "2001-01-01", True, False),
    ("OPA04", "Avenir Net", "isp", ("fixed_broadband",), "2012-06-10", False, False),
    ("OPA05", "Likouala Connect", "isp", ("fixed_broadband",), "2014-02-28", False, False),
    ("OPA06", "Niari Web", "isp", ("fixed_broadband",), "2016-11-03", False, False),
    ("OPA07", "Plateaux Digital", "isp", ("fixed_broadband",), "2018-08-17", False, False),
)
# Regions: code, name, capital, population 2023, area km2, density per km2, zone, urban concentration.
REGIONS = (
    ("SAN", "Sangha", "Ouésso", 209701, 55800, "3.80", "North", False),
    ("LIK", "Likouala", "Impfondo", 325429, 61993, "5.24", "North", False),
    ("COB", "Congo-Oubangui", "Mossaka", 124100, 25536, "4.86", "North", False),
    ("CUV", "Cuvette", "Owando", 222640, 26765, "8.30", "North", False),
    ("CUO", "Cuvette-Ouest", "Ewo", 119328, 26600, "4.50", "North", False),
    ("NKA", "Nkéni-Alima", "Gamboma", 154230, 17406, "8.86", "North", False),
    ("PLA", "Plateaux", "Djambala", 129191, 20994, "6.15", "North", False),
    ("DJL", "Djoué-Léfini", "Odziba", 174761, 23560, "7.41", "Southeast", False),
    ("BZV", "Brazzaville", "Brazzaville", 2145783, 588, "3649.29", "Southeast", True),
    ("POO", "Pool", "Kinkala", 219771, 10395, "21.14", "Southeast", False),
    ("BOU", "Bouenza", "Madingou", 363850, 12265, "29.67", "South", False),
    ("LEK", "Lékoumou", "Sibiti", 100559, 20950, "4.80", "South", False),
    ("NIA", "Niari", "Dolisie", 334863, 25942, "12.91", "South", False),
    ("KOU", "Kouilou", "Loango", 119162, 13103, "9.09", "Southwest", False),
    ("PNR", "Pointe-Noire", "Pointe-Noire", 1398812, 288, "4857.00", "Southwest", True),
)
OLDEST_PERIOD = "2018-01-01"
ACTIVE_TO_TOTAL_LIMIT = "1.05"
DEFAULT_SUM_TOLERANCE_PCT = "1.0"
USF_RATE_LIMIT = "0.10"
LATENCY_MAX_MS = 5000

# Column names, in the order of the submissions.
VOICE_MOBILE = (
    "voice_minutes_outgoing_onnet",
    "voice_minutes_outgoing_offnet",
    "voice_minutes_outgoing_international",
    "voice_minutes_incoming_national",
    "voice_minutes_incoming_international",
)
VOICE_FIXED = (
    "voice_minutes_fixed_local",
    "voice_minutes_fixed_national",
    "voice_minutes_fixed_international_outgoing",
    "voice_minutes_fixed_incoming_national",
    "voice_minutes_fixed_incoming_international",
)
SMS_COLS = (
    "sms_count_outgoing_onnet",
    "sms_count_outgoing_offnet",
    "sms_count_outgoing_international",
    "sms_count_incoming_national",
)
DATA_MOBILE = ("data_consumed_mb_2g", "data_consumed_mb_3g", "data_consumed_mb_4g", "data_consumed_mb_5g")
DATA_FIXED = ("data_consumed_mb_fiber", "data_consumed_mb_adsl", "data_consumed_mb_fixed_wireless")
QOS_PCT = (
    "network_availability_pct",
    "call_drop_rate_pct",
    "call_setup_success_rate_pct",
    "population_coverage_pct_4g",
    "population_coverage_pct_3g",
    "population_coverage_pct_2g",
    "avg_packet_loss_pct",
    "fixed_broadband_coverage_pct",
)
QOS_RATE = (
    "avg_data_throughput_mbps_4g",
    "avg_data_throughput_mbps_3g",
    "avg_fixed_download_mbps",
    "avg_fixed_upload_mbps",
    "fixed_service_repair_time_hours",
)
REV_VOICE = (
    "revenue_voice_outgoing_onnet_xaf",
    "revenue_voice_outgoing_offnet_xaf",
    "revenue_voice_outgoing_international_xaf",
    "revenue_voice_incoming_national_xaf",
    "revenue_voice_incoming_international_xaf",
)
REV_SMS = (
    "revenue_sms_outgoing_onnet_xaf",
    "revenue_sms_outgoing_offnet_xaf",
    "revenue_sms_outgoing_international_xaf",
    "revenue_sms_incoming_xaf",
)
REV_INTERNET = ("revenue_internet_2g_xaf", "revenue_internet_3g_xaf", "revenue_internet_4g_xaf", "revenue_internet_5g_xaf")
REV_FIXED_VOICE = ("revenue_fixed_voice_subscription_xaf", "revenue_fixed_voice_usage_xaf")
REV_FIXED_BB = ("revenue_fixed_broadband_subscription_xaf", "revenue_fixed_broadband_usage_xaf")
REV_OTHER = ("revenue_equipment_rental_xaf", "revenue_value_added_services_xaf", "revenue_other_xaf")
REV_COMPONENTS = REV_VOICE + REV_SMS + REV_INTERNET + REV_FIXED_VOICE + REV_FIXED_BB + REV_OTHER
# End of the fixed values; the rule codes and their order in the rule lists below are fixed as well.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Domain:
    name: str
    business: tuple[tuple[str, T.DataType], ...]
    has_region: bool = True

    @property
    def key(self) -> tuple[str, ...]:
        if self.name == "subscribers":
            return (
                "operator_id",
                "report_period",
                "region_code",
                "service_segment",
                "service_category",
                "payment_type",
                "technology_generation",
            )
        if self.has_region:
            return ("operator_id", "report_period", "region_code", "service_segment")
        return ("operator_id", "report_period", "service_segment")

    @property
    def null_safe_key(self) -> bool:
        return self.name == "subscribers"

    @property
    def business_names(self) -> tuple[str, ...]:
        return tuple(n for n, _ in self.business)

    @property
    def required_csv_columns(self) -> tuple[str, ...]:
        """Header columns a landing CSV must carry (extra ones are ignored)."""
        base = ["source_submission_id", "operator_id", "report_period"]
        if self.has_region:
            base.append("region_code")
        base += ["service_segment", *self.business_names, "submitted_at", "_raw_payload"]
        return tuple(base)

    def bronze_schema(self) -> T.StructType:
        fields = [
            T.StructField("bronze_id", T.StringType(), False),
            T.StructField("source_submission_id", T.StringType()),
            T.StructField("operator_id", T.StringType()),
            T.StructField("report_period", T.StringType()),
        ]
        if self.has_region:
            fields.append(T.StructField("region_code", T.StringType()))
        fields.append(T.StructField("service_segment", T.StringType(), False))
        fields += [T.StructField(n, t) for n, t in self.business]
        fields += [
            T.StructField("submitted_at", T.TimestampType()),
            T.StructField("_source_file", T.StringType()),
            T.StructField("_source_line", T.IntegerType()),
            T.StructField("_loaded_at", T.TimestampType()),
            T.StructField("_loaded_by_run_id", T.StringType()),
            T.StructField("_raw_payload", T.StringType()),
        ]
        return T.StructType(fields)


_L, _I, _S = T.LongType(), T.IntegerType(), T.StringType()
_D63, _D83, _D183 = T.DecimalType(6, 3), T.DecimalType(8, 3), T.DecimalType(18, 3)

DOMAIN_DEFS: dict[str, Domain] = {
    "subscribers": Domain(
        "subscribers",
        (
            ("service_category", _S),
            ("payment_type", _S),
            ("technology_generation", _S),
            ("total_subscribers", _L),
            ("active_subscribers_30d", _L),
            ("new_activations", _L),
            ("churn_count", _L),
            ("arpu_xaf", T.DecimalType(10, 2)),
        ),
    ),
    "traffic_voice": Domain("traffic_voice", tuple((c, _L) for c in VOICE_MOBILE + VOICE_FIXED)),
    "traffic_sms": Domain("traffic_sms", tuple((c, _L) for c in SMS_COLS)),
    "traffic_internet": Domain("traffic_internet", tuple((c, _D183) for c in DATA_MOBILE + DATA_FIXED)),
    "qos": Domain(
        "qos",
        (
            ("measurement_methodology", _S),
            ("period_type", _S),
            ("network_availability_pct", _D63),
            ("call_drop_rate_pct", _D63),
            ("call_setup_success_rate_pct", _D63),
            ("avg_data_throughput_mbps_4g", _D83),
            ("avg_data_throughput_mbps_3g", _D83),
            ("avg_latency_ms", _I),
            ("population_coverage_pct_4g", _D63),
            ("population_coverage_pct_3g", _D63),
            ("population_coverage_pct_2g", _D63),
            ("avg_fixed_download_mbps", _D83),
            ("avg_fixed_upload_mbps", _D83),
            ("avg_packet_loss_pct", _D63),
            ("fixed_broadband_coverage_pct", _D63),
            ("fixed_service_repair_time_hours", _D83),
            ("qos_related_complaints", _I),
        ),
    ),
    "revenue": Domain(
        "revenue",
        tuple((c, _L) for c in REV_COMPONENTS) + (("total_revenue_xaf", _L), ("usf_contribution_xaf", _L)),
        has_region=False,
    ),
}


# --- reference tables -------------------------------------------------------


def operators_df(spark: SparkSession) -> DataFrame:
    schema = (
        "operator_id string, operator_name string, operator_type string, service_segments array<string>, "
        "license_status string, license_issued_date date, is_state_owned boolean, is_mvno boolean"
    )
    rows = [
        (i, n, t, list(segs), "active", _dt.date.fromisoformat(d), so, mvno) for i, n, t, segs, d, so, mvno in OPERATORS
    ]
    return small_table(spark, rows, schema)


def regions_df(spark: SparkSession) -> DataFrame:
    from decimal import Decimal

    schema = (
        "region_code string, region_name string, region_capital string, population_2023 int, area_km2 int, "
        "density_per_km2 decimal(10,2), zone string, is_urban_concentration boolean"
    )
    rows = [(c, n, cap, p, a, Decimal(d), z, u) for c, n, cap, p, a, d, z, u in REGIONS]
    return small_table(spark, rows, schema)


def licence_matrix_df(spark: SparkSession) -> DataFrame:
    """(domain, service_segment) pairs that may be submitted."""
    rows = [(d, s) for d in DOMAINS for s in DOMAIN_SEGMENTS[d]]
    return small_table(spark, rows, "domain string, service_segment string")


# --- rules ------------------------------------------------------------------


def _seg(s: str) -> F.Column:
    return F.col("service_segment") == F.lit(s)


def _common_head(as_of: str, has_region: bool) -> list[R.Rule]:
    out = [
        R.missing("missing_operator", "operator_id"),
        R.unknown_reference("unknown_operator", "dim_operator_id"),
        R.missing("missing_report_period", "report_period"),
        R.invalid_period("invalid_period_format", "report_period"),
        R.period_older_than("period_too_old", "report_period", OLDEST_PERIOD),
        R.period_after("period_in_future", "report_period", as_of),
    ]
    if has_region:
        out += [
            R.missing("missing_region", "region_code"),
            R.unknown_reference("unknown_region", "dim_region_code"),
        ]
    out.append(R.missing("missing_service_segment", "service_segment"))
    return out


def _licensed() -> R.Rule:
    return R.not_licensed("segment_not_licensed", "dim_operator_id", "service_segment", "dim_service_segments")


def _tail() -> R.Rule:
    return R.missing("missing_submitted_at", "submitted_at")


def subscriber_rules(as_of: str) -> list[R.Rule]:
    cat = F.col("service_category")
    tech = F.col("technology_generation")
    return [
        *_common_head(as_of, True),
        R.not_in("unknown_service_segment", "service_segment", SUBSCRIBER_RULE_SEGMENTS),
        _licensed(),
        R.missing("missing_service_category", "service_category"),
        R.not_in("unknown_service_category", "service_category", SERVICE_CATEGORIES),
        R.conditional_not_in(
            "service_category_mismatch_mobile", "service_segment", "mobile", "service_category", ("mobile_telephony", "mobile_internet")
        ),
        R.conditional_not_in(
            "service_category_mismatch_fixed_voice", "service_segment", "fixed_voice", "service_category", ("fixed_voice",)
        ),
        R.conditional_not_in(
            "service_category_mismatch_fixed_broadband",
            "service_segment",
            "fixed_broadband",
            "service_category",
            ("fixed_broadband",),
        ),
        R.missing("missing_payment_type", "payment_type"),
        R.not_in("unknown_payment_type", "payment_type", PAYMENT_TYPES),
        R.missing("missing_total_subscribers", "total_subscribers"),
        R.negative("negative_subscribers", "total_subscribers"),
        R.missing("missing_active_subscribers_30d", "active_subscribers_30d"),
        R.negative("negative_active", "active_subscribers_30d"),
        R.exceeds_ratio("active_exceeds_total", "active_subscribers_30d", "total_subscribers", ACTIVE_TO_TOTAL_LIMIT),
        R.missing("missing_new_activations", "new_activations"),
        R.negative("negative_activations", "new_activations"),
        R.missing("missing_churn_count", "churn_count"),
        R.negative("negative_churn", "churn_count"),
        R.missing("missing_arpu", "arpu_xaf"),
        R.negative("negative_arpu", "arpu_xaf"),
        R.required_when("missing_tech_generation_for_internet", cat == "mobile_internet", "technology_generation"),
        R.Rule(
            "unknown_technology_generation",
            (cat == "mobile_internet") & tech.isNotNull() & ~tech.isin(*TECHNOLOGY_GENERATIONS),
            "conditional_enum",
        ),
        R.Rule(
            "tech_generation_on_non_internet",
            cat.isNotNull() & (cat != "mobile_internet") & tech.isNotNull(),
            "required_iff",
        ),
        _tail(),
    ]


def voice_rules(as_of: str) -> list[R.Rule]:
    mob, fix = _seg("mobile"), _seg("fixed_voice")
    short = {
        "voice_minutes_outgoing_onnet": "outgoing_onnet",
        "voice_minutes_outgoing_offnet": "outgoing_offnet",
        "voice_minutes_outgoing_international": "outgoing_international",
        "voice_minutes_incoming_national": "incoming_national",
        "voice_minutes_incoming_international": "incoming_international",
        "voice_minutes_fixed_local": "fixed_local",
        "voice_minutes_fixed_national": "fixed_national",
        "voice_minutes_fixed_international_outgoing": "fixed_international_outgoing",
        "voice_minutes_fixed_incoming_national": "fixed_incoming_national",
        "voice_minutes_fixed_incoming_international": "fixed_incoming_international",
    }
    fixed_codes = {
        "voice_minutes_fixed_local": "fixed_missing_local_minutes",
        "voice_minutes_fixed_national": "fixed_missing_national_minutes",
        "voice_minutes_fixed_international_outgoing": "fixed_missing_international_outgoing",
        "voice_minutes_fixed_incoming_national": "fixed_missing_incoming_national",
        "voice_minutes_fixed_incoming_international": "fixed_missing_incoming_international",
    }
    return [
        *_common_head(as_of, True),
        R.not_in("voice_unsupported_segment", "service_segment", DOMAIN_SEGMENTS["traffic_voice"]),
        _licensed(),
        *[R.required_when(f"mobile_missing_{short[c]}", mob, c) for c in VOICE_MOBILE],
        R.forbidden_nonzero_when("mobile_has_fixed_voice_minutes", mob, VOICE_FIXED),
        *[R.required_when(fixed_codes[c], fix, c) for c in VOICE_FIXED],
        R.forbidden_nonzero_when("fixed_has_mobile_voice_minutes", fix, VOICE_MOBILE),
        *[R.negative(f"negative_{short[c]}", c) for c in VOICE_MOBILE + VOICE_FIXED],
        _tail(),
    ]


def sms_rules(as_of: str) -> list[R.Rule]:
    short = [c.replace("sms_count_", "") for c in SMS_COLS]
    return [
        *_common_head(as_of, True),
        R.not_equal("sms_only_supported_for_mobile", "service_segment", "mobile"),
        _licensed(),
        *[R.missing(f"missing_{s}", c) for s, c in zip(short, SMS_COLS)],
        *[R.negative(f"negative_{s}", c) for s, c in zip(short, SMS_COLS)],
        _tail(),
    ]


def internet_rules(as_of: str) -> list[R.Rule]:
    mob, fbb = _seg("mobile"), _seg("fixed_broadband")
    return [
        *_common_head(as_of, True),
        R.not_in("internet_unsupported_segment", "service_segment", DOMAIN_SEGMENTS["traffic_internet"]),
        _licensed(),
        R.required_when("mobile_missing_2g_data", mob, "data_consumed_mb_2g"),
        R.required_when("mobile_missing_3g_data", mob, "data_consumed_mb_3g"),
        R.required_when("mobile_missing_4g_data", mob, "data_consumed_mb_4g"),
        R.forbidden_nonzero_when("mobile_has_fixed_broadband_data", mob, DATA_FIXED),
        R.required_when("fixed_broadband_missing_fiber_data", fbb, "data_consumed_mb_fiber"),
        R.required_when("fixed_broadband_missing_adsl_data", fbb, "data_consumed_mb_adsl"),
        R.required_when("fixed_broadband_missing_fixed_wireless_data", fbb, "data_consumed_mb_fixed_wireless"),
        R.forbidden_nonzero_when("fixed_broadband_has_mobile_generation_data", fbb, DATA_MOBILE),
        *[R.negative(f"negative_{c.replace('data_consumed_mb_', '')}_data", c) for c in DATA_MOBILE + DATA_FIXED],
        _tail(),
    ]


def qos_rules(as_of: str) -> list[R.Rule]:
    mob, fv, fbb = _seg("mobile"), _seg("fixed_voice"), _seg("fixed_broadband")
    return [
        *_common_head(as_of, True),
        R.not_in("qos_unsupported_segment", "service_segment", DOMAIN_SEGMENTS["qos"]),
        _licensed(),
        R.missing("missing_methodology", "measurement_methodology"),
        R.not_in("unknown_methodology", "measurement_methodology", QOS_METHODOLOGIES),
        R.missing("missing_period_type", "period_type"),
        R.not_in("unknown_period_type", "period_type", QOS_PERIOD_TYPES),
        R.required_when("mobile_missing_availability", mob, "network_availability_pct"),
        R.required_when("mobile_missing_drop_rate", mob, "call_drop_rate_pct"),
        R.required_when("mobile_missing_setup_success", mob, "call_setup_success_rate_pct"),
        R.required_when("mobile_missing_4g_throughput", mob, "avg_data_throughput_mbps_4g"),
        R.required_when("mobile_missing_3g_throughput", mob, "avg_data_throughput_mbps_3g"),
        R.required_when("mobile_missing_latency", mob, "avg_latency_ms"),
        R.forbidden_present_when(
            "mobile_has_fixed_qos_columns",
            mob,
            (
                "avg_fixed_download_mbps",
                "avg_fixed_upload_mbps",
                "avg_packet_loss_pct",
                "fixed_broadband_coverage_pct",
                "fixed_service_repair_time_hours",
            ),
        ),
        R.required_when("fixed_voice_missing_availability", fv, "network_availability_pct"),
        R.required_when("fixed_voice_missing_repair_time", fv, "fixed_service_repair_time_hours"),
        R.forbidden_present_when(
            "fixed_voice_has_unrelated_qos_columns",
            fv,
            (
                "call_drop_rate_pct",
                "call_setup_success_rate_pct",
                "avg_data_throughput_mbps_4g",
                "avg_data_throughput_mbps_3g",
                "avg_latency_ms",
                "population_coverage_pct_4g",
                "population_coverage_pct_3g",
                "population_coverage_pct_2g",
                "avg_fixed_download_mbps",
                "avg_fixed_upload_mbps",
                "avg_packet_loss_pct",
                "fixed_broadband_coverage_pct",
            ),
        ),
        R.required_when("fixed_broadband_missing_availability", fbb, "network_availability_pct"),
        R.required_when("fixed_broadband_missing_download", fbb, "avg_fixed_download_mbps"),
        R.required_when("fixed_broadband_missing_upload", fbb, "avg_fixed_upload_mbps"),
        R.required_when("fixed_broadband_missing_latency", fbb, "avg_latency_ms"),
        R.required_when("fixed_broadband_missing_packet_loss", fbb, "avg_packet_loss_pct"),
        R.required_when("fixed_broadband_missing_coverage", fbb, "fixed_broadband_coverage_pct"),
        R.required_when("fixed_broadband_missing_repair_time", fbb, "fixed_service_repair_time_hours"),
        R.forbidden_present_when(
            "fixed_broadband_has_mobile_qos_columns",
            fbb,
            (
                "call_drop_rate_pct",
                "call_setup_success_rate_pct",
                "avg_data_throughput_mbps_4g",
                "avg_data_throughput_mbps_3g",
                "population_coverage_pct_4g",
                "population_coverage_pct_3g",
                "population_coverage_pct_2g",
            ),
        ),
        R.out_of_range("availability_out_of_range", "network_availability_pct", 0, 100),
        R.out_of_range("drop_rate_out_of_range", "call_drop_rate_pct", 0, 100),
        R.out_of_range("setup_success_out_of_range", "call_setup_success_rate_pct", 0, 100),
        R.negative("negative_4g_throughput", "avg_data_throughput_mbps_4g"),
        R.negative("negative_3g_throughput", "avg_data_throughput_mbps_3g"),
        R.out_of_range("latency_implausible", "avg_latency_ms", 0, LATENCY_MAX_MS),
        R.out_of_range("coverage_4g_out_of_range", "population_coverage_pct_4g", 0, 100),
        R.out_of_range("coverage_3g_out_of_range", "population_coverage_pct_3g", 0, 100),
        R.out_of_range("coverage_2g_out_of_range", "population_coverage_pct_2g", 0, 100),
        R.negative("negative_fixed_download", "avg_fixed_download_mbps"),
        R.negative("negative_fixed_upload", "avg_fixed_upload_mbps"),
        R.out_of_range("packet_loss_out_of_range", "avg_packet_loss_pct", 0, 100),
        R.out_of_range("fixed_coverage_out_of_range", "fixed_broadband_coverage_pct", 0, 100),
        R.negative("negative_repair_time", "fixed_service_repair_time_hours"),
        R.missing("missing_complaints", "qos_related_complaints"),
        R.negative("negative_complaints", "qos_related_complaints"),
        _tail(),
    ]


_REV_NEG_CODES = (
    "negative_voice_onnet",
    "negative_voice_offnet",
    "negative_voice_international",
    "negative_voice_incoming_national",
    "negative_voice_incoming_international",
    "negative_sms_onnet",
    "negative_sms_offnet",
    "negative_sms_international",
    "negative_sms_incoming",
    "negative_internet_2g",
    "negative_internet_3g",
    "negative_internet_4g",
    "negative_internet_5g",
    "negative_fixed_voice_subscription",
    "negative_fixed_voice_usage",
    "negative_fixed_broadband_subscription",
    "negative_fixed_broadband_usage",
    "negative_equipment_rental",
    "negative_value_added_services",
    "negative_other_revenue",
)


def revenue_rules(as_of: str, sum_tolerance_pct: str = DEFAULT_SUM_TOLERANCE_PCT) -> list[R.Rule]:
    mob, fv, fbb = _seg("mobile"), _seg("fixed_voice"), _seg("fixed_broadband")
    total, parts = "total_revenue_xaf", "components_sum_xaf"
    usf = F.col("usf_contribution_xaf")
    return [
        *_common_head(as_of, False),
        R.not_in("revenue_unsupported_segment", "service_segment", DOMAIN_SEGMENTS["revenue"]),
        _licensed(),
        R.required_nonzero_when("mobile_missing_4g_revenue", mob, ("revenue_internet_4g_xaf",)),
        R.forbidden_nonzero_when("mobile_has_fixed_revenue", mob, REV_FIXED_VOICE + REV_FIXED_BB + ("revenue_equipment_rental_xaf",)),
        R.required_nonzero_when("fixed_voice_missing_revenue_components", fv, REV_FIXED_VOICE),
        R.forbidden_nonzero_when(
            "fixed_voice_has_unrelated_revenue",
            fv,
            REV_VOICE + REV_SMS + REV_INTERNET + REV_FIXED_BB + ("revenue_value_added_services_xaf",),
        ),
        R.required_nonzero_when("fixed_broadband_missing_revenue_components", fbb, REV_FIXED_BB),
        R.forbidden_nonzero_when(
            "fixed_broadband_has_unrelated_revenue", fbb, REV_VOICE + REV_SMS + REV_INTERNET + REV_FIXED_VOICE
        ),
        R.missing("missing_total_revenue", total),
        R.negative("negative_total_revenue", total),
        R.zero_total_with_parts("zero_total_with_components", total, parts),
        R.sum_mismatch("component_sum_mismatch", total, parts, sum_tolerance_pct),
        *[R.negative(code, c) for code, c in zip(_REV_NEG_CODES, REV_COMPONENTS)],
        R.negative("negative_usf_contribution", "usf_contribution_xaf"),
        R.Rule(
            "usf_rate_implausibly_high",
            usf.isNotNull() & R.ratio_above("", usf, total, USF_RATE_LIMIT).predicate,
            "ratio_limit",
        ),
        _tail(),
    ]


# --- derived silver columns ----------------------------------------------------


def derived_columns(domain: str) -> dict[str, F.Column]:
    if domain == "traffic_voice":
        return {
            "total_outgoing_minutes": R.coalesced_sum(VOICE_MOBILE[:3] + VOICE_FIXED[:3]),
            "total_incoming_minutes": R.coalesced_sum(VOICE_MOBILE[3:] + VOICE_FIXED[3:]),
        }
    if domain == "traffic_sms":
        return {"total_outgoing_sms": R.coalesced_sum(SMS_COLS[:3])}
    if domain == "traffic_internet":
        return {"total_data_consumed_mb": R.coalesced_sum(DATA_MOBILE + DATA_FIXED).cast("decimal(20,3)")}
    if domain == "revenue":
        tot, usf = F.col("total_revenue_xaf"), F.col("usf_contribution_xaf")
        rate = F.round(usf.cast("decimal(20,0)") * 100 / tot.cast("decimal(20,0)"), 3).cast("decimal(6,3)")
        return {"usf_contribution_rate_pct": F.when((tot > 0) & usf.isNotNull(), rate)}
    return {}


def pre_columns(domain: str) -> dict[str, F.Column]:
    """Columns computed before the rules (the rules read them)."""
    if domain == "revenue":
        parts = R.coalesced_sum(REV_COMPONENTS)
        return {"components_sum_xaf": parts, "sum_check_delta_xaf": F.col("total_revenue_xaf") - parts}
    return {}


def rules_for(domain: str, as_of: str, sum_tolerance_pct: str = DEFAULT_SUM_TOLERANCE_PCT) -> list[R.Rule]:
    return {
        "subscribers": subscriber_rules,
        "traffic_voice": voice_rules,
        "traffic_sms": sms_rules,
        "traffic_internet": internet_rules,
        "qos": qos_rules,
        "revenue": lambda a: revenue_rules(a, sum_tolerance_pct),
    }[domain](as_of)


def pack(
    domain: str,
    operators: DataFrame,
    regions: DataFrame,
    as_of: str | _dt.date,
    sum_tolerance_pct: str = DEFAULT_SUM_TOLERANCE_PCT,
) -> RulePack:
    """RulePack for one domain: operator (and region) lookups, rules, derived columns."""
    d = DOMAIN_DEFS[domain]
    lookups = [DimLookup(operators, "operator_id", "operator_id", ("service_segments",))]
    if d.has_region:
        lookups.append(DimLookup(regions, "region_code", "region_code"))
    return RulePack(
        name=domain,
        rules=rules_for(domain, str(as_of), sum_tolerance_pct),
        lookups=lookups,
        derived=derived_columns(domain),
        key=d.key,
        null_safe_key=d.null_safe_key,
        pre=pre_columns(domain),
    )
