"""Benchmark: the layered pipeline and every registered query at one scale factor.

Prints ONE JSON line:
  {"metric": "tierline_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Stages mirror the published estimates (ingest, clean, enrich, register); the
flight CSVs are produced from the test tables first (setup, not timed).  Each
registered query then runs end to end from the parquet test tables and is
executed completely through the ``noop`` sink (no collect).

Before timing, the whole run (pipeline and every query) is done once, untimed,
on the smallest test scale (``BENCH_WARMUP_DIR``, default
/root/testdata/sf0.001; set it empty to skip) so that the timings measure the
steady state rather than JVM start-up and code generation warm-up.  Broadcast
size verdicts are keyed by input files, so nothing carries over between scales.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_WARMUP_DIR.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def _sf(sf_dir: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", sf_dir)
    return float(m.group(1)) if m else sf_dir


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    from pyspark.sql import SparkSession

    from tierline.session import DEFAULT_CONF, ensure_checkpoint_dir

    b = SparkSession.builder.master(f"local[{cpus}]").appName("tierline-bench")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = (
        b.config("spark.sql.shuffle.partitions", str(max(8, cpus * 2)))
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)

    from tierline.plans.queries import QUERIES  # the training-data queries are measured by the check tool
    from tierline.plans import pipeline as P
    from tierline.sources import testview as V
    from tierline.sources.catalog import register_layers

    def csv_sources(data_dir: str, work: str) -> dict[str, str]:
        src = {}
        for name, df in [("airlines", V.airlines(spark, data_dir)), ("airports", V.airports(spark, data_dir)),
                         ("flights", V.flights_raw(spark, data_dir))]:
            path = f"{work}/csv/{name}"
            df.write.option("header", "true").csv(path)
            src[name] = path
        return src

    quiet = lambda s: None
    tmp_root = os.environ.get("BENCH_TMP", "/tmp")
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    warmed = bool(warm_dir) and os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir)
    if warmed:
        warm = tempfile.mkdtemp(prefix="run-bench-warm-", dir=tmp_root)
        P.run_all(spark, f"file:{warm}/lake", csv_sources(warm_dir, warm), log=quiet)
        for q in QUERIES.values():
            q(spark, warm_dir).write.format("noop").mode("overwrite").save()

    work = tempfile.mkdtemp(prefix="run-bench-", dir=tmp_root)
    base = f"file:{work}/lake"
    src = csv_sources(sf_dir, work)

    timings: dict[str, float] = {}
    errors: dict[str, str] = {}

    def timed(key, fn):
        """Time one item; a failure is recorded and the run goes on, so one JSON line always prints."""
        t0 = time.perf_counter()
        try:
            out = fn()
        except Exception as exc:  # noqa: BLE001
            errors[key] = f"{type(exc).__name__}: {str(exc)[:300]}"
            return None
        timings[key] = round(time.perf_counter() - t0, 3)
        return out

    bronze = timed("ingest", lambda: P.run_bronze(spark, base, src, log=quiet))
    silver = timed("clean", lambda: P.run_silver(spark, base, log=quiet))
    gold = timed("enrich", lambda: P.run_gold(spark, base, log=quiet))
    timed("register", lambda: register_layers(spark, base))
    pipeline_total = sum(timings.get(k, 0.0) for k in ("ingest", "clean", "enrich", "register"))

    for key, q in QUERIES.items():
        timed(key, lambda q=q: q(spark, sf_dir).write.format("noop").mode("overwrite").save())
    query_total = sum(v for k, v in timings.items() if k not in ("ingest", "clean", "enrich", "register"))

    # The dashboard's reports over the registered layer tables (what a user
    # runs daily); reported separately, not part of ``value``.
    from tierline.functions.filters import FactFilter
    from tierline.operators import reports as R
    from tierline.plans import queries as Qs

    table = spark.table
    flt = FactFilter(Qs.TREND_AIRLINES, Qs.TREND_AIRPORTS, Qs.TREND_FROM, Qs.TREND_TO)
    fact_t, airlines_t, airports_t = "gold.fact_flights_delay", "bronze.airlines", "bronze.airports"
    layer_reports = {
        "kpis": lambda: R.kpis(table(fact_t)),
        "worst_airline": lambda: R.worst_airline(table(fact_t), table(airlines_t)),
        "top10_airlines": lambda: R.top_n(R.airline_leaderboard(table(fact_t), table(airlines_t)), 10),
        "trend_filtered": lambda: R.trend(table(fact_t), flt),
        "delay_cause_shares": lambda: R.cause_totals(table("bronze.flights"), shares=True),
        "top10_airports": lambda: R.top10_airports(table(fact_t), table(airports_t)),
        "airport_map": lambda: R.map_points(table(fact_t), table(airports_t)),
        "date_bounds": lambda: R.date_bounds(table(fact_t)),
        "dim_airlines": lambda: R.dim_airlines(table(airlines_t)),
    }
    report_times = {}
    for key, build in layer_reports.items():
        t0 = time.perf_counter()
        try:
            build().write.format("noop").mode("overwrite").save()
        except Exception as exc:  # noqa: BLE001
            errors[f"layer_report:{key}"] = f"{type(exc).__name__}: {str(exc)[:300]}"
            continue
        report_times[key] = round(time.perf_counter() - t0, 3)
    report_times["total"] = round(sum(report_times.values()), 3)

    rates = {}
    if bronze and silver and gold:
        flights = next(b["rows_written"] for b in bronze if b["dataset"] == "flights")
        rates = {
            "flight_rows": flights,
            "ingest_rows_per_sec": round(flights / timings["ingest"]),
            "clean_rows_per_sec": round(silver["rows"] / timings["clean"]),
            "enrich_rows_per_sec": round(gold["rows"] / timings["enrich"]),
        }
    print(json.dumps({
        "metric": "tierline_total_sec",
        "value": round(pipeline_total + query_total, 3),
        "unit": "sec",
        "queries": timings,
        "pipeline_total": round(pipeline_total, 3),
        "queries_total": round(query_total, 3),
        "rates": rates,
        "layer_reports": report_times,
        "sf": _sf(sf_dir),
        "cpus": cpus,
        "warmup": warm_dir if warmed else None,
        "errors": errors,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
