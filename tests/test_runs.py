"""Two runs of the flow: overlapping loads, a watermark, an event resolved in between."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.domains import telecom as tc
from strata.operators import events
from strata.plans import medallion

from conftest import SF_SMALL


def test_second_run_upserts(spark, scratch):
    all_rows = {d: medallion.accepted(spark, SF_SMALL, d) for d in tc.DOMAINS}
    for d, rows in all_rows.items():
        rows.where("pmod(xxhash64(bronze_id), 40) = 0").write.parquet(f"{scratch}/bronze/{d}")
    part = {d: spark.read.parquet(f"{scratch}/bronze/{d}") for d in tc.DOMAINS}
    stamp = F.when(F.pmod(F.xxhash64("bronze_id", F.lit(1)), F.lit(3)) == 0, F.lit("2026-12-07 00:00:00")).otherwise(F.lit("2026-12-05 00:00:00"))
    both = {d: b.withColumn("_loaded_at", stamp.cast("timestamp")) for d, b in part.items()}
    early = {d: b.where("_loaded_at < '2026-12-06'") for d, b in both.items()}

    def kept(run, name, root):
        run[name].write.parquet(f"{root}/{name}")
        return spark.read.schema(run[name].schema).parquet(f"{root}/{name}")

    names = [*[f"{k}_{d}" for d in tc.DOMAINS for k in ("silver", "rejections")], "data_quality_events", "run_metrics"]
    first = medallion.process(spark, early, "r1", "2026-12-06 00:00:00")
    first = {n: kept(first, n, f"{scratch}/r1") for n in names}
    one = first["data_quality_events"].orderBy("event_fingerprint").limit(1)
    resolved = events.resolve(first["data_quality_events"], one, "looked at", "2026-12-06 12:00:00")
    previous = dict(first) | {"data_quality_events": resolved}
    second = medallion.process(spark, both, "r2", "2026-12-08 00:00:00", previous=previous, loaded_after="2026-12-07 00:00:00")
    clean = medallion.process(spark, both, "r3", "2026-12-08 00:00:00")

    for d in tc.DOMAINS:
        key = list(tc.DOMAIN_DEFS[d].key)
        rows = lambda run, name, cols: sorted(map(str, run[name].select(*cols).collect()))  # noqa: E731, B023
        assert rows(second, f"silver_{d}", key) == rows(clean, f"silver_{d}", key), d
        assert rows(second, f"rejections_{d}", ["bronze_id", "rejection_reason"]) == rows(clean, f"rejections_{d}", ["bronze_id", "rejection_reason"])
        assert second[f"validated_{d}"].where("_loaded_at < '2026-12-07'").isEmpty()
    status = {r.event_fingerprint: r.status for r in second["data_quality_events"].collect()}
    assert set(status) >= {r.event_fingerprint for r in clean["data_quality_events"].collect()}
    assert status[one.first().event_fingerprint] == "resolved"  # not seen again: it stays so
    metrics = {r.report_period: r for r in second["run_metrics"].collect()}
    old = {r.report_period: r for r in first["run_metrics"].collect()}
    both_periods = set(metrics) & set(old)
    assert both_periods and all(metrics[p].created_at == old[p].created_at for p in both_periods)
