"""The daily job: landed files -> raw -> refined + metrics -> alert hits.

Stage hand-over is through tables in a root folder on shared storage:

    {root}/raw                     insert-only, partitioned by date
    {root}/quarantine              lines that could not become bars
    {root}/metrics/v=<run>         full rewrite per run, partitioned by date
    {root}/refined/v=<run>         projection of the same run's metrics
    {root}/commits                 which folders make up the tables

Every rewrite goes to a new folder, and one row in ``commits`` names the
folders of all tables at once (see ``sources.commits``), so a reader never sees
half a run and a failed run leaves the previous tables in place.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession

from barlake.config import DEFAULT_ALERTS, DEFAULT_EXCHANGE, DEFAULT_REARM, alert_rules
from barlake.operators.alerts import firing_days, rearm, rule_hits
from barlake.operators.ingest import high_water_mark, ingest_plan
from barlake.operators.metrics import compute_metrics, compute_metrics_long
from barlake.operators.refine import refine_prices
from barlake.operators.segmented import refine_prices_long
from barlake.schema import BARS_SCHEMA
from barlake.sources.commits import commit
from barlake.sources.tables import overwrite, scan
from barlake.streaming.landing_stream import run_once


def refresh_tables(spark: SparkSession, raw: DataFrame, root: str, run_id: str,
                   alerts=DEFAULT_ALERTS, strategy: str = "key",
                   block_rows: int = 1_000_000) -> tuple[str, str]:
    """Refined + metrics for one run from the raw rows; returns both paths.

    ``strategy="key"``: one lineage, one shuffle on the ticker (a ticker's
    history is bounded by its trading days).  ``strategy="long"``: the
    segmented operators, so no task holds more than a block of one ticker;
    refined is written first and metrics are computed from the written table.
    """
    version = f"v={run_id}"
    metrics_path = f"{root}/metrics/{version}"
    refined_path = f"{root}/refined/{version}"
    if strategy == "key":
        overwrite(compute_metrics(refine_prices(raw), alerts), metrics_path, ["date"])
        written = scan(spark, metrics_path)
        overwrite(written.select(*BARS_SCHEMA.fieldNames()), refined_path, ["date"])
    elif strategy == "long":
        overwrite(refine_prices_long(raw, block_rows=block_rows), refined_path, ["date"])
        refined = scan(spark, refined_path, BARS_SCHEMA)
        overwrite(compute_metrics_long(refined, alerts, block_rows=block_rows), metrics_path, ["date"])
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    commit(spark, root, time.time_ns(), metrics=[metrics_path], refined=[refined_path])
    return refined_path, metrics_path


def load_plan(spark: SparkSession, root: str, universe: DataFrame, as_of=None) -> DataFrame:
    """What the next delivery should hold: the symbols of ``universe`` not yet
    loaded up to ``as_of`` and the dates they lack."""
    from barlake.sources.tables import initialize_table

    initialize_table(spark, f"{root}/raw", BARS_SCHEMA, ["date"])
    return ingest_plan(high_water_mark(universe, scan(spark, f"{root}/raw", BARS_SCHEMA)), as_of)


def notices(metrics: DataFrame, rules: DataFrame, gap_days: int = DEFAULT_REARM) -> DataFrame:
    """(rule_id, date) of the firings that are sent: at least ``gap_days``
    after the rule's last one."""
    return rearm(firing_days(rule_hits(metrics, rules, latest_only=False)), gap_days)


def run_daily(spark: SparkSession, landing_dir: str, root: str, run_id: str | None = None,
              alerts=DEFAULT_ALERTS, strategy: str = "key", mode: str = "incremental",
              exchange: str = DEFAULT_EXCHANGE, universe: DataFrame | None = None,
              loader: str = "text", on_match: str = "ignore") -> DataFrame:
    """One scheduled run; returns the alert hits of the latest day.

    ``mode="incremental"`` (the default): the ingest stream appends the new
    landed rows to raw, the metrics stream turns exactly those rows into
    metrics rows from the carry/tail state, and the alerts read the latest
    date partition of the metrics table.  ``mode="full"``: rewrite refined
    and metrics from the whole raw table (the reference's behaviour) into
    new folders.  ``root`` holds one exchange; its universe and its alert rules
    are arguments.  ``loader`` names the reader of landed files, and
    ``on_match="update"`` lets a landed row correct a loaded one.
    """
    from barlake.streaming.metrics_stream import metrics_table, run_metrics_once

    run_id = run_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    raw_path = f"{root}/raw"
    run_once(spark, landing_dir, raw_path, f"{root}/quarantine", f"{root}/_checkpoints/ingest",
             exchange=exchange, universe=universe, loader=loader, on_match=on_match)
    if mode == "incremental":
        run_metrics_once(spark, raw_path, f"{root}/incremental", f"{root}/_checkpoints/metrics",
                         alerts, strategy)
        metrics = metrics_table(spark, f"{root}/incremental")
    elif mode == "full":
        raw = scan(spark, raw_path, BARS_SCHEMA)
        metrics = scan(spark, refresh_tables(spark, raw, root, run_id, alerts, strategy)[1])
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return rule_hits(metrics, alert_rules(spark, alerts))


def main(argv=None) -> None:
    """``python -m barlake.plans.pipeline --landing DIR --root DIR``: one
    scheduled run (load plan, ingest, metrics, alerts); prints the plan, the
    alert state and today's notices after rearm."""
    import argparse

    from barlake.config import DEFAULT_TICKERS
    from barlake.config import universe as configured
    from barlake.operators.alerts import alert_state
    from barlake.session import get_session
    from barlake.streaming.metrics_stream import metrics_table

    ap = argparse.ArgumentParser(description=main.__doc__)
    ap.add_argument("--landing", required=True, help="folder of landed {SYMBOL}.{EXCHANGE}.csv files")
    ap.add_argument("--root", required=True, help="folder of the raw / metrics / state tables of one exchange")
    ap.add_argument("--strategy", default="key", choices=["key", "long"])
    ap.add_argument("--exchange", default=DEFAULT_EXCHANGE)
    ap.add_argument("--tickers", default=",".join(DEFAULT_TICKERS), help="comma-separated universe of the exchange")
    ap.add_argument("--as-of", default=None, help="load date, yyyy-mm-dd; today unless given")
    ap.add_argument("--loader", default="text", help="reader of landed files, by name")
    ap.add_argument("--on-match", default="ignore", choices=["ignore", "update"], help="what a landed row does to a loaded row of its day")
    ap.add_argument("--rearm", type=int, default=DEFAULT_REARM, help="days between two notices of a rule")
    ap.add_argument("--run-id", default=None)
    args = ap.parse_args(argv)
    spark = get_session()
    tickers = configured(spark, args.tickers.split(","), args.exchange)
    load_plan(spark, args.root, tickers, args.as_of).show(truncate=False)
    hits = run_daily(spark, args.landing, args.root, args.run_id, strategy=args.strategy,
                     exchange=args.exchange, universe=tickers, loader=args.loader, on_match=args.on_match)
    alert_state(alert_rules(spark), hits, args.exchange).show(truncate=False)
    notices(metrics_table(spark, f"{args.root}/incremental"), alert_rules(spark), args.rearm).show(truncate=False)


if __name__ == "__main__":
    main()
