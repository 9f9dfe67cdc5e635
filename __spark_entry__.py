"""

``queries()`` maps a name to ``(spark, sf_dir) -> DataFrame``; every query
reads the driver's tables in ``sf_dir`` (or data Spark derives from them).
``oracle_sql()`` gives DuckDB SQL computing the same rows and columns over the
same tables.  Window means (SMA columns) are reported as
``round(x + 1e-8, 6)`` on both sides because the two engines add the frame in
a different order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake import oracle as O
from barlake.config import DEFAULT_ALERTS, DEFAULT_REARM, alert_rules
from barlake.functions.exprs import rounded, to_decimal_10_3
from barlake.functions.text import sma_text
from barlake.operators import alerts as A
from barlake.operators import corrections as CO
from barlake.operators import exact as EX
from barlake.operators import incremental as INC
from barlake.operators import ingest as I
from barlake.operators import metrics as M
from barlake.operators import refine as R
from barlake.operators import rule_index as RX
from barlake.operators import segmented as SG
from barlake.operators.rearm import rearm_long
from barlake.plans import chains
from barlake.schema import BARS_SCHEMA, LANDING_FIELDS, QUARANTINE_SCHEMA
from barlake.session import scratch_dir
from barlake.sources import fixtures as FX
from barlake.sources import footers
from barlake.sources.landing import STUB_LINE, landing_lines, read_landing, read_landing_source, split_symbol, symbol_of_path, union_landing
from barlake.sources.layout import write_clustered
from barlake.sources.merge import upsert_table
from barlake.sources.catalog import save_bucketed
from barlake.sources.tables import overwrite, read_table, scan
from barlake.streaming.landing_stream import run_once

try:
    from barlake.llm import queries as LLM
except ImportError:  # the package also works without that subpackage
    LLM = None
try:
    import corpus_pipeline as PIPELINE
except ImportError:
    PIPELINE = None

SMOKE_DIR = "/root/testdata/sf0.001"
REARM_GAP_DAYS = 3


def _round_cols(df: DataFrame, cols) -> DataFrame:
    cols = set(cols)
    return df.select(*[rounded(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


# --- fixtures ---------------------------------------------------------------

def q_bars_user(spark, d):
    return FX.bars(spark, d, "user")


def q_bars_brand(spark, d):
    return FX.bars(spark, d, "brand")


def q_bars_event_type(spark, d):
    return FX.bars(spark, d, "event_type")


def q_dirty_bars(spark, d):
    return FX.dirty_bars(spark, d, "user")


# --- refine -----------------------------------------------------------------

def q_null_nonpositive(spark, d):
    return R.null_nonpositive(FX.dirty_bars(spark, d, "user"))


def q_forward_fill(spark, d):
    return R.forward_fill(R.null_nonpositive(FX.dirty_bars(spark, d, "user")))


def q_refine_prices(spark, d):
    return chains.refined(spark, d, "user")


def q_refine_prices_brand(spark, d):
    return chains.refined(spark, d, "brand")


# --- metrics ----------------------------------------------------------------

def q_previous_close(spark, d):
    df, name = M.previous_value(chains.refined(spark, d, "user"), "close")
    return df.select("ticker", "date", "close", name)


def q_pct_change(spark, d):
    df, name = M.add_change_column(chains.refined(spark, d, "user"), "close")
    return df.select("ticker", "date", name)


def _sma(spark, d, periods, **kw):
    df, name = M.simple_moving_average(chains.refined(spark, d, "brand"), "close", periods, **kw)
    return _round_cols(df.select("ticker", "date", name), [name])


def q_sma_20(spark, d):
    return _sma(spark, d, 20)


def q_sma_200(spark, d):
    return _sma(spark, d, 200)


def q_sma_exact(spark, d):
    return _sma(spark, d, 20, exact=True)


def q_sma_cents(spark, d):
    return _sma(spark, d, 200, cents=True)


def _crossover(spark, d, periods):
    df, name = M.add_crossover_column(chains.refined(spark, d, "brand"), "close", periods)
    return df.select("ticker", "date", name)


def q_sma_exact_double(spark, d):
    """Both SMAs as exact quotients of exact sums."""
    out = EX.compute_metrics_exact(chains.refined(spark, d, "brand"), [("sma_crossover", 20), ("sma_crossover", 200)])
    return _round_cols(out.select("ticker", "date", "close_sma_20", "close_sma_200"), ["close_sma_20", "close_sma_200"])


def q_crossover_exact_double(spark, d):
    """Crossovers decided by integers: no rounding makes or hides one."""
    out = EX.compute_metrics_exact(chains.refined(spark, d, "brand"), [("sma_crossover", 20), ("sma_crossover", 200)])
    return out.select("ticker", "date", "close_sma_20_co", "close_sma_200_co")


def q_metrics_ticks_exact(spark, d):
    """Every event as a tick of its type's series, exact, in blocks."""
    out = EX.compute_metrics_exact_long(_ticks(spark, d), order="ts")
    return _round_cols(out, ["close_sma_20", "close_sma_200"])


def q_crossover_20(spark, d):
    return _crossover(spark, d, 20)


def q_crossover_200(spark, d):
    return _crossover(spark, d, 200)


def q_metrics_all(spark, d):
    return _round_cols(chains.metrics(spark, d, "user"), ["close_sma_20", "close_sma_200"])


def q_metrics_brand(spark, d):
    return _round_cols(chains.metrics(spark, d, "brand"), ["close_sma_20", "close_sma_200"])


# Long-series (skew-safe) variants; small blocks so the brand series (about
# 1,500 days each at sf0.01) span many segments and blocks.
LONG_BLOCK_ROWS = 2048


def q_forward_fill_long(spark, d):
    p1 = R.null_nonpositive(FX.dirty_bars(spark, d, "brand"))
    return SG.forward_fill_long(p1, block_rows=LONG_BLOCK_ROWS)


def q_refine_prices_long(spark, d):
    return SG.refine_prices_long(FX.dirty_bars(spark, d, "brand"), block_rows=LONG_BLOCK_ROWS)


def q_metrics_long(spark, d):
    refined = SG.refine_prices_long(FX.dirty_bars(spark, d, "brand"), block_rows=LONG_BLOCK_ROWS, keep_segments=True)
    out = M.compute_metrics_long(refined, block_rows=LONG_BLOCK_ROWS)
    return _round_cols(out, ["close_sma_20", "close_sma_200"])


def q_metrics_incremental(spark, d):
    """Full run over the days up to the sink cut, then one incremental run
    for the later days; the union equals a full recompute (metrics_all)."""
    raw = FX.dirty_bars(spark, d, "user")
    cut = F.col("date") <= F.lit(FX.SINK_CUT).cast("date")
    old_raw, new_raw = raw.where(cut), raw.where(~cut)
    # The first run's metrics are a written table in real use; checkpoint them
    # so the union, the carry and the tails read them instead of recomputing.
    old = SG.materialize(M.compute_metrics(R.refine_prices(old_raw)))
    carry, tails = INC.initial_state(old_raw, old)
    new = INC.incremental_metrics(new_raw, carry, tails)
    return _round_cols(old.unionByName(new), ["close_sma_20", "close_sma_200"])


def q_metrics_corrected(spark, d):
    """Metrics of all days but one week, that week's bars then delivered late:
    only the rows they reach are recomputed; equal to a full run."""
    raw = FX.dirty_bars(spark, d, "user")
    late = F.col("date").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date"))
    stored = SG.materialize(M.compute_metrics(R.refine_prices(raw.where(~late))))
    rows, gone = CO.corrected_metrics(stored, SG.materialize(raw), raw.where(late).select("ticker", "date"))
    return _round_cols(CO.apply_corrections(stored, rows, gone), ["close_sma_20", "close_sma_200"])


# Hot keys: every event as a tick of its event type's series (5 keys, each
# about a fifth of all rows), ordered by its unique timestamp.
TICK_BLOCK_ROWS = 1024


def _ticks(spark, d):
    ev = read_table(spark, d, "events")
    return ev.select(F.col("event_type").alias("ticker"), "ts", F.col("value").alias("close"))


def q_metrics_ticks(spark, d):
    """Metrics per event-type tick series, in blocks of the production size."""
    out = M.compute_metrics_long(_ticks(spark, d), order="ts")
    return _round_cols(out, ["close_sma_20", "close_sma_200"])


def q_metrics_ticks_long(spark, d):
    """The same in small blocks: no task holds more than a block (plus
    look-back) of a hot key."""
    out = M.compute_metrics_long(_ticks(spark, d), order="ts", block_rows=TICK_BLOCK_ROWS)
    return _round_cols(out, ["close_sma_20", "close_sma_200"])


# --- alerts -----------------------------------------------------------------
# Latest-day alerts read the written metrics table: the chain runs once and
# the newest date is one partition of it.

def _metrics_table(spark, d) -> str:
    """The user metrics written as a date-partitioned parquet table."""
    path = scratch_dir(spark, "metrics")
    overwrite(chains.metrics(spark, d, "user"), path, ["date"])
    return path


def _written_metrics(spark, d) -> DataFrame:
    return scan(spark, _metrics_table(spark, d), chains.metrics(spark, d, "user").schema)


def q_alert_price_5(spark, d):
    return A.price_change_alert(_written_metrics(spark, d), 5)


def q_alert_price_10(spark, d):
    return A.price_change_alert(_written_metrics(spark, d), 10)


def q_alert_sma_20(spark, d):
    return A.sma_cross_alert(_written_metrics(spark, d), 20)


def q_alert_sma_200(spark, d):
    return A.sma_cross_alert(_written_metrics(spark, d), 200)


def q_latest_per_ticker(spark, d):
    """Q4 variant: each ticker's own latest row and its change."""
    m = chains.metrics(spark, d, "user")
    return A.latest_day_per_key(m).select("ticker", "date", "close_change")


def q_alert_hits(spark, d):
    return A.rule_hits(_written_metrics(spark, d), alert_rules(spark))


def q_rules_many(spark, d):
    """As many change rules as there are parts: thresholds from ``part``."""
    return A.rule_hits(_written_metrics(spark, d), _part_rules(spark, d))


def q_alert_state(spark, d):
    rules = alert_rules(spark)
    return A.alert_state(rules, A.rule_hits(_written_metrics(spark, d), rules))


def q_alert_messages(spark, d):
    rules = alert_rules(spark)
    return A.alert_messages(rules, A.rule_hits(_written_metrics(spark, d), rules))


def q_alert_history(spark, d):
    hits = A.rule_hits(chains.metrics(spark, d, "user"), alert_rules(spark), latest_only=False)
    return A.firing_days(hits)


def q_alert_rearm(spark, d):
    hits = A.rule_hits(chains.metrics(spark, d, "user"), alert_rules(spark), latest_only=False)
    return A.rearm(A.firing_days(hits), REARM_GAP_DAYS)


def q_alert_rearm_100(spark, d):
    """R5 with the configured gap, over the longer brand series."""
    hits = A.rule_hits(chains.metrics(spark, d, "brand"), alert_rules(spark), latest_only=False)
    return A.rearm(A.firing_days(hits), DEFAULT_REARM)


def q_alert_rearm_long(spark, d):
    """R5 without a list per rule: successors and pointer doubling."""
    hits = A.rule_hits(chains.metrics(spark, d, "brand"), alert_rules(spark), latest_only=False)
    return rearm_long(A.firing_days(hits), DEFAULT_REARM)


def q_alert_rearm_events(spark, d):
    """The same for a rule that every event fires, rearmed after six hours."""
    ev = read_table(spark, d, "events").select(F.lit("any_event").alias("rule_id"), "ts")
    return rearm_long(ev, 0.25, order="ts")


def _part_rules(spark, d) -> DataFrame:
    part = read_table(spark, d, "part")
    return part.select(F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("rule_id"),
                       F.lit("close_change").alias("metric"), (F.col("p_retailprice").cast("double") / 100).alias("threshold"))


def q_rules_ranked(spark, d):
    """As many change rules as parts: a hit carries how many it fires."""
    return RX.ranked_hits(_written_metrics(spark, d), _part_rules(spark, d))


def q_rules_fired(spark, d):
    """Hits per rule, from the ranks alone."""
    rules = _part_rules(spark, d)
    return RX.fired_counts(RX.ranked_hits(_written_metrics(spark, d), rules), RX.rule_ranks(rules))


def q_alert_message_rows(spark, d):
    """the whole message body as rows: its text, then one row per hit."""
    rules = alert_rules(spark)
    return A.message_rows(rules, A.rule_hits(_written_metrics(spark, d), rules))


def q_alert_rearm_stream(spark, d):
    """R5 on a stream: the firing days arrive in three chunks, the second
    before the first, and the kept days equal the batch operator's."""
    from barlake.streaming.rearm_stream import kept_table, run_rearm_once
    hits = A.rule_hits(chains.metrics(spark, d, "user"), alert_rules(spark), latest_only=False)
    root = scratch_dir(spark, "rearm")
    A.firing_days(hits).select("rule_id", "date").write.parquet(f"{root}/all")
    firings = spark.read.parquet(f"{root}/all")
    bounds = [("2024-01-10", "2024-01-20"), ("1900-01-01", "2024-01-10"), ("2024-01-20", "2999-12-31")]
    for i, (lo, hi) in enumerate(bounds):
        chunk = firings.where((F.col("date") > F.lit(lo).cast("date")) & (F.col("date") <= F.lit(hi).cast("date")))
        chunk.write.mode("overwrite").parquet(f"{root}/firings/run={i}")
        run_rearm_once(spark, f"{root}/firings", f"{root}/out", f"{root}/_checkpoints/rearm", REARM_GAP_DAYS)
    return kept_table(spark, f"{root}/out")


# --- ingest -----------------------------------------------------------------

def q_last_dates(spark, d):
    return I.last_dates(FX.sink_bars(spark, d))


def q_last_dates_footers(spark, d):
    """A1 over a table partitioned by ticker, from file footers alone."""
    path = scratch_dir(spark, "footers")
    overwrite(FX.bars(spark, d, "event_type"), path, ["ticker"])
    return footers.last_dates(spark, path, BARS_SCHEMA)


def q_global_last_date_footers(spark, d):
    """A2 from file footers."""
    path = scratch_dir(spark, "footers")
    overwrite(FX.sink_bars(spark, d), path)
    return footers.global_last_date(spark, path, BARS_SCHEMA)


def q_landing_drift(spark, d):
    """Landed files whose headers differ: odd tickers carry an extra column,
    even ones lack the volume; one table by name, extras kept."""
    path = FX.write_drift_landing(spark, d, scratch_dir(spark, "drift"), bundled=True)
    rows, _ = union_landing(spark, path)
    said = F.array_join(F.transform(F.array_sort(F.map_entries("extra")), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return rows.select(*BARS_SCHEMA.fieldNames(), said.alias("extra"))


def q_global_last_date(spark, d):
    return I.global_last_date(FX.sink_bars(spark, d))


def q_high_water_mark(spark, d):
    return I.high_water_mark(FX.fixture_universe(spark, d), FX.sink_bars(spark, d))


def q_ingest_plan(spark, d):
    hwm = I.high_water_mark(FX.fixture_universe(spark, d), FX.sink_bars(spark, d))
    return I.ingest_plan(hwm, FX.INGEST_AS_OF)


def q_symbol_build(spark, d):
    u = FX.fixture_universe(spark, d)
    return u.select("exchange", "ticker", I.symbol(F.col("ticker"), F.col("exchange")).alias("symbol"))


def q_dedupe_batch(spark, d):
    return I.dedupe(FX.update_bars(spark, d))


def q_new_rows(spark, d):
    return I.new_rows(FX.sink_bars(spark, d), FX.update_bars(spark, d))


def q_insert_only_upsert(spark, d):
    return I.insert_only(FX.sink_bars(spark, d), FX.update_bars(spark, d))


def q_upsert_update(spark, d):
    """The merge with corrections: the batch's row replaces the loaded one."""
    return I.upsert(FX.sink_bars(spark, d), FX.update_bars(spark, d), on_match="update")


def q_upsert_table(spark, d):
    """The merge into the stored table, with the close of one loaded day
    corrected to half: only days with changes are rewritten."""
    path = f"{scratch_dir(spark, 'upsert')}/raw"
    overwrite(FX.sink_bars(spark, d), path, ["date"])
    upsert_table(spark, path, FX.corrected_bars(spark, d))
    return scan(spark, path, BARS_SCHEMA).select(*BARS_SCHEMA.fieldNames())


def q_metrics_bucketed(spark, d):
    """All metrics over a bucketed table: no exchange, no sort."""
    path = scratch_dir(spark, "bucketed")
    table = save_bucketed(FX.dirty_bars(spark, d, "user"), f"bars_{path[-12:]}", path, 8)
    return _round_cols(M.compute_metrics(R.refine_prices(table)), ["close_sma_20", "close_sma_200"])


def q_bars_clustered(spark, d):
    """The brand bars written along the (ticker, date) curve and read back."""
    path = scratch_dir(spark, "clustered")
    write_clustered(FX.bars(spark, d, "brand"), path, file_rows=4096)
    return spark.read.parquet(path)


def q_dedupe_nulls(spark, d):
    """A broken copy of every bar (no prices) never beats the whole one."""
    b = FX.update_bars(spark, d)
    broken = b.select("ticker", "date", *[F.lit(None).cast("double").alias(c) for c in ("open", "high", "low", "close")], "volume")
    return I.dedupe(b.unionByName(broken))


def q_merge_date_only(spark, d):
    """A table of one series, all events of a day as one bar, merged on the
    date alone."""
    days = FX.bars_whole(spark, d)
    day = F.col("date")
    changed = days.where(day == F.lit(FX.CHANGED_DAY).cast("date")).withColumn("close", F.col("close") * 2)
    batch = days.where(day >= F.lit(FX.UPDATE_FROM).cast("date")).unionByName(changed)
    return I.insert_only(days.where(day <= F.lit(FX.SINK_CUT).cast("date")), batch, keys=["date"])


# --- landed files and the stream --------------------------------------------

def q_landing_csv(spark, d):
    path = FX.write_fixture_landing(spark, d, scratch_dir(spark, "landing"), bundled=True)
    good, _ = read_landing(spark, path)
    return good


def q_landing_source(spark, d):
    """The same files through the ``eod_landing`` data source."""
    path = FX.write_fixture_landing(spark, d, scratch_dir(spark, "landing"), bundled=True)
    return read_landing_source(spark, path)[0]


def q_quarantine_bad_rows(spark, d):
    path = FX.write_fixture_landing(spark, d, scratch_dir(spark, "landing"), bundled=True)
    _, bad = read_landing(spark, path)
    return bad.select("ticker", "date_text", "reason")


def _stream_root(spark, d) -> str:
    """Two scheduled runs of the ingest stream: the first sees the files of
    the days up to the sink cut, the second the files of the update batch
    (which repeat six days); returns the folder of its tables."""
    root = scratch_dir(spark, "stream")
    landing, ckpt = f"{root}/landing", f"{root}/_checkpoints/ingest"
    FX.write_fixture_landing(spark, d, f"{landing}/batch=1",
                             F.col("date") <= F.lit(FX.SINK_CUT).cast("date"), bundled=True)
    run_once(spark, landing, f"{root}/raw", f"{root}/quarantine", ckpt)
    FX.write_fixture_landing(spark, d, f"{landing}/batch=2",
                             F.col("date") >= F.lit(FX.UPDATE_FROM).cast("date"), with_stub=False, bundled=True)
    run_once(spark, landing, f"{root}/raw", f"{root}/quarantine", ckpt)
    return root


def q_landing_reconcile(spark, d):
    """Every landed data line is in the raw table, a duplicate of a row there,
    or in quarantine; counted per ticker."""
    root = _stream_root(spark, d)
    header = F.col("line").contains(LANDING_FIELDS["date"]) | (F.trim(F.col("line")) == STUB_LINE)
    lines = landing_lines(spark, f"{root}/landing").where(~header)
    landed = lines.groupBy(split_symbol(symbol_of_path(F.col("file")))[0].alias("ticker")).agg(F.count(F.lit(1)).alias("n_lines"))
    raw = scan(spark, f"{root}/raw", BARS_SCHEMA).groupBy("ticker").agg(F.count(F.lit(1)).alias("n_raw"))
    bad = scan(spark, f"{root}/quarantine", QUARANTINE_SCHEMA).groupBy("ticker").agg(F.count(F.lit(1)).alias("n_quarantined"))
    joined = landed.join(raw, "ticker", "left").join(bad, "ticker", "left").na.fill(0)
    return joined.withColumn("n_duplicates", F.col("n_lines") - F.col("n_raw") - F.col("n_quarantined"))


def q_stream_ingest(spark, d):
    return scan(spark, f"{_stream_root(spark, d)}/raw", BARS_SCHEMA).select(*BARS_SCHEMA.fieldNames())


def _daily(spark, d, strategy, **kw):
    from barlake.plans.pipeline import refresh_tables
    root = scratch_dir(spark, "daily")
    landing = f"{root}/landing"
    FX.write_fixture_landing(spark, d, landing, bundled=True)
    run_once(spark, landing, f"{root}/raw", f"{root}/quarantine", f"{root}/_checkpoints/ingest")
    raw = scan(spark, f"{root}/raw", BARS_SCHEMA)
    _, metrics_path = refresh_tables(spark, raw, root, "r1", strategy=strategy, **kw)
    return A.rule_hits(scan(spark, metrics_path), alert_rules(spark))


def q_daily_pipeline(spark, d):
    """Landed files -> stream ingest -> refined + metrics tables -> alert hits."""
    return _daily(spark, d, "key")


def q_daily_incremental(spark, d):
    """The default daily job run twice: first over the landed days up to the
    sink cut, then over the later days; the second run's hits (latest day)
    equal the full pipeline's."""
    from barlake.plans.pipeline import run_daily
    root = scratch_dir(spark, "daily-inc")
    first = F.col("date") <= F.lit(FX.SINK_CUT).cast("date")
    FX.write_fixture_landing(spark, d, f"{root}/landing/run=0", first, bundled=True)
    run_daily(spark, f"{root}/landing", root, "r0").count()
    FX.write_fixture_landing(spark, d, f"{root}/landing/run=1", ~first, with_stub=False, bundled=True)
    return run_daily(spark, f"{root}/landing", root, "r1")


def q_daily_pipeline_long(spark, d):
    """The same run with the long-series (skew-safe) operators."""
    return _daily(spark, d, "long", block_rows=512)


def q_metrics_stream(spark, d):
    """Raw table filled in three ingest runs; after each, the metrics stream
    processes only the new raw files incrementally.  The resulting metrics
    table equals a full recompute over all landed rows."""
    from barlake.streaming.metrics_stream import metrics_table, run_metrics_once
    root = scratch_dir(spark, "metrics-stream")
    landing, raw = f"{root}/landing", f"{root}/raw"
    cuts = [("1900-01-01", FX.UPDATE_FROM), (FX.UPDATE_FROM, FX.SINK_CUT), (FX.SINK_CUT, "2999-12-31")]
    for i, (lo, hi) in enumerate(cuts):
        window = (F.col("date") > F.lit(lo).cast("date")) & (F.col("date") <= F.lit(hi).cast("date"))
        FX.write_fixture_landing(spark, d, f"{landing}/run={i}", window, with_stub=(i == 0), bundled=True)
        run_once(spark, landing, raw, f"{root}/quarantine", f"{root}/_checkpoints/ingest")
        run_metrics_once(spark, raw, root, f"{root}/_checkpoints/metrics")
    out = metrics_table(spark, root).select(*chains.metrics_columns())
    return _round_cols(out, ["close_sma_20", "close_sma_200"])


def q_metrics_state_stream(spark, d):
    """Metrics from keyed state: the user bars arrive in three chunks of days;
    every batch touches the state of its own tickers only."""
    from barlake.streaming.state_metrics import run_state_metrics_once, state_metrics_table
    root = scratch_dir(spark, "state-metrics")
    raw = FX.dirty_bars(spark, d, "user")
    cuts = [("1900-01-01", FX.UPDATE_FROM), (FX.UPDATE_FROM, FX.SINK_CUT), (FX.SINK_CUT, "2999-12-31")]
    for i, (lo, hi) in enumerate(cuts):
        days = (F.col("date") > F.lit(lo).cast("date")) & (F.col("date") <= F.lit(hi).cast("date"))
        raw.where(days).write.parquet(f"{root}/raw/run={i}")
        run_state_metrics_once(spark, f"{root}/raw", f"{root}/out", f"{root}/_checkpoints/state", partitions=8)
    return _round_cols(state_metrics_table(spark, f"{root}/out"), ["close_sma_20", "close_sma_200"])


def q_alert_rearm_state(spark, d):
    """R5 on state: the brand series' firing days arrive in two chunks, the
    kept notices equal the batch operator's."""
    from barlake.streaming.state_metrics import notices_table, run_state_rearm_once
    hits = A.rule_hits(chains.metrics(spark, d, "brand"), alert_rules(spark), latest_only=False)
    root = scratch_dir(spark, "state-rearm")
    A.firing_days(hits).select("rule_id", "date").write.parquet(f"{root}/all")
    firings = spark.read.parquet(f"{root}/all")
    half = F.col("date") <= F.lit("1995-06-30").cast("date")
    for i, chunk in enumerate((half, ~half)):
        firings.where(chunk).write.parquet(f"{root}/firings/run={i}")
        run_state_rearm_once(spark, f"{root}/firings", f"{root}/out", f"{root}/_checkpoints/rearm", DEFAULT_REARM, partitions=2)
    return notices_table(spark, f"{root}/out").where("kind = 'kept'").select("rule_id", "date")


def _saved_hits(spark, d, alerts) -> DataFrame:
    from barlake.plans import saved_queries as SQ
    return SQ.run_saved(spark, SQ.hits_statement(SQ.table_ref(_metrics_table(spark, d)), alerts))


def q_alert_price_5_sql(spark, d):
    hits = _saved_hits(spark, d, [("eod_change", 5)])
    return hits.select("ticker", to_decimal_10_3(F.col("value")).alias("close_change"))


def q_alert_sma_20_sql(spark, d):
    hits = _saved_hits(spark, d, [("sma_crossover", 20)])
    return hits.orderBy("value", "ticker").select("ticker", sma_text(F.col("value"), 20).alias("sma_text"))


def q_alert_rules_sql(spark, d):
    """All configured rules by one generated statement."""
    return _saved_hits(spark, d, DEFAULT_ALERTS)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bars_user": q_bars_user,
    "bars_brand": q_bars_brand,
    "bars_event_type": q_bars_event_type,
    "dirty_bars": q_dirty_bars,
    "null_nonpositive": q_null_nonpositive,
    "forward_fill": q_forward_fill,
    "refine_prices": q_refine_prices,
    "refine_prices_brand": q_refine_prices_brand,
    "previous_close": q_previous_close,
    "pct_change": q_pct_change,
    "sma_20": q_sma_20,
    "sma_200": q_sma_200,
    "sma_exact": q_sma_exact,
    "sma_cents": q_sma_cents,
    "sma_exact_double": q_sma_exact_double,
    "crossover_exact_double": q_crossover_exact_double,
    "crossover_20": q_crossover_20,
    "crossover_200": q_crossover_200,
    "metrics_all": q_metrics_all,
    "metrics_brand": q_metrics_brand,
    "forward_fill_long": q_forward_fill_long,
    "refine_prices_long": q_refine_prices_long,
    "metrics_long": q_metrics_long,
    "metrics_incremental": q_metrics_incremental,
    "metrics_corrected": q_metrics_corrected,
    "metrics_ticks": q_metrics_ticks,
    "metrics_ticks_long": q_metrics_ticks_long,
    "metrics_ticks_exact": q_metrics_ticks_exact,
    "alert_price_5": q_alert_price_5,
    "alert_price_10": q_alert_price_10,
    "alert_sma_20": q_alert_sma_20,
    "alert_sma_200": q_alert_sma_200,
    "alert_price_5_sql": q_alert_price_5_sql,
    "alert_sma_20_sql": q_alert_sma_20_sql,
    "alert_rules_sql": q_alert_rules_sql,
    "latest_per_ticker": q_latest_per_ticker,
    "alert_hits": q_alert_hits,
    "rules_many": q_rules_many,
    "alert_state": q_alert_state,
    "alert_messages": q_alert_messages,
    "alert_history": q_alert_history,
    "alert_rearm": q_alert_rearm,
    "alert_rearm_100": q_alert_rearm_100,
    "alert_rearm_long": q_alert_rearm_long,
    "alert_rearm_events": q_alert_rearm_events,
    "rules_ranked": q_rules_ranked,
    "rules_fired": q_rules_fired,
    "alert_message_rows": q_alert_message_rows,
    "alert_rearm_stream": q_alert_rearm_stream,
    "last_dates": q_last_dates,
    "global_last_date": q_global_last_date,
    "last_dates_footers": q_last_dates_footers,
    "global_last_date_footers": q_global_last_date_footers,
    "landing_drift": q_landing_drift,
    "high_water_mark": q_high_water_mark,
    "ingest_plan": q_ingest_plan,
    "symbol_build": q_symbol_build,
    "dedupe_batch": q_dedupe_batch,
    "new_rows": q_new_rows,
    "insert_only_upsert": q_insert_only_upsert,
    "upsert_update": q_upsert_update,
    "upsert_table": q_upsert_table,
    "metrics_bucketed": q_metrics_bucketed,
    "bars_clustered": q_bars_clustered,
    "dedupe_nulls": q_dedupe_nulls,
    "merge_date_only": q_merge_date_only,
    "landing_csv": q_landing_csv,
    "landing_source": q_landing_source,
    "quarantine_bad_rows": q_quarantine_bad_rows,
    "stream_ingest": q_stream_ingest,
    "landing_reconcile": q_landing_reconcile,
    "daily_pipeline": q_daily_pipeline,
    "daily_pipeline_long": q_daily_pipeline_long,
    "daily_incremental": q_daily_incremental,
    "metrics_stream": q_metrics_stream,
    "metrics_state_stream": q_metrics_state_stream,
    "alert_rearm_state": q_alert_rearm_state,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the whole chain (bars -> faults -> refine -> metrics) and all
    four alert rules evaluated on the latest day, at sf0.001."""
    return q_alert_hits(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(_QUERIES)
    if LLM is not None:
        out.update(LLM.QUERIES)
    if PIPELINE is not None:
        out["pipeline"] = PIPELINE.run
    return out


# --- oracle SQL ---------------------------------------------------------------

def _oracle() -> dict[str, str]:
    c = O.chain
    r = O.rnd
    sma20_user = f"{r('close_sma_20')} AS close_sma_20"
    sma200_user = f"{r('close_sma_200')} AS close_sma_200"
    metrics_cols = ("ticker, date, open, high, low, close, volume, close_previous, close_change, "
                    f"{sma20_user}, close_sma_20_co, {sma200_user}, close_sma_200_co")
    latest_user = "date = (SELECT max(date) FROM metrics_user)"
    sql = {
        "bars_user": c("user", "bars") + "SELECT * FROM bars_user",
        "bars_brand": c("brand", "bars") + "SELECT * FROM bars_brand",
        "bars_event_type": c("event_type", "bars") + "SELECT * FROM bars_event_type",
        "dirty_bars": c("user", "dirty") + "SELECT * FROM dirty_user",
        "null_nonpositive": c("user", "p1") + "SELECT * FROM p1_user",
        "forward_fill": c("user", "filled") + "SELECT * FROM filled_user",
        "refine_prices": c("user", "refined") + "SELECT * FROM refined_user",
        "refine_prices_brand": c("brand", "refined") + "SELECT * FROM refined_brand",
        "previous_close": c("user", "refined")
        + f"SELECT ticker, date, close, lag(close) OVER {O.W} AS close_previous FROM refined_user",
        "pct_change": c("user", "refined")
        + f"SELECT ticker, date, (close - lag(close) OVER {O.W}) / nullif(lag(close) OVER {O.W}, 0)"
          f" * 100 AS close_change FROM refined_user",
        "sma_20": c("brand", "refined")
        + f"SELECT ticker, date, {r(O._sma(20))} AS close_sma_20 FROM refined_brand",
        "sma_200": c("brand", "refined")
        + f"SELECT ticker, date, {r(O._sma(200))} AS close_sma_200 FROM refined_brand",
        "sma_exact": c("brand", "refined")
        + f"SELECT ticker, date, {r(O._sma(19))} AS close_sma_20 FROM refined_brand",
        "sma_cents": c("brand", "refined")
        + "SELECT ticker, date, "
          + r("sum(CAST(round(close * 100) AS BIGINT)) OVER (PARTITION BY ticker ORDER BY date "
              "ROWS BETWEEN 200 PRECEDING AND CURRENT ROW) / (100.0 * count(close) OVER "
              "(PARTITION BY ticker ORDER BY date ROWS BETWEEN 200 PRECEDING AND CURRENT ROW))")
          + " AS close_sma_200 FROM refined_brand",
        "crossover_20": c("brand", "metrics") + "SELECT ticker, date, close_sma_20_co FROM metrics_brand",
        "crossover_200": c("brand", "metrics") + "SELECT ticker, date, close_sma_200_co FROM metrics_brand",
        "metrics_all": c("user", "metrics") + f"SELECT {metrics_cols} FROM metrics_user",
        "metrics_brand": c("brand", "metrics") + f"SELECT {metrics_cols} FROM metrics_brand",
        "metrics_incremental": c("user", "metrics") + f"SELECT {metrics_cols} FROM metrics_user",
        "forward_fill_long": c("brand", "filled") + "SELECT * FROM filled_brand",
        "refine_prices_long": c("brand", "refined") + "SELECT * FROM refined_brand",
        "metrics_long": c("brand", "metrics") + f"SELECT {metrics_cols} FROM metrics_brand",
        "alert_price_5": c("user", "metrics")
        + f"SELECT ticker, CAST(close_change AS DECIMAL(10,3)) AS close_change FROM metrics_user "
          f"WHERE {latest_user} AND abs(close_change) > 5",
        "alert_price_10": c("user", "metrics")
        + f"SELECT ticker, CAST(close_change AS DECIMAL(10,3)) AS close_change FROM metrics_user "
          f"WHERE {latest_user} AND abs(close_change) > 10",
    }
    for n in (20, 200):
        co = f"close_sma_{n}_co"
        sql[f"alert_sma_{n}"] = c("user", "metrics") + f"""SELECT ticker,
  CASE WHEN {co} > 0 THEN 'Went above {n} day moving average.'
       WHEN {co} < 0 THEN 'Went below {n} day moving average.' ELSE 'N/A' END AS sma_text
FROM metrics_user WHERE {latest_user} AND abs({co}) > 0 ORDER BY {co}, ticker"""
    sql["latest_per_ticker"] = c("user", "metrics") + """SELECT m.ticker, m.date, m.close_change
FROM metrics_user m JOIN (SELECT ticker, max(date) AS d FROM metrics_user GROUP BY ticker) l
  ON m.ticker = l.ticker AND m.date = l.d"""
    wt = "(PARTITION BY ticker ORDER BY ts)"
    ticks = f"""WITH t AS (SELECT event_type AS ticker, ts, value AS close FROM events),
t1 AS (SELECT *, lag(close) OVER {wt} AS close_previous,
         (close - lag(close) OVER {wt}) / nullif(lag(close) OVER {wt}, 0) * 100 AS close_change,
         avg(close) OVER (PARTITION BY ticker ORDER BY ts ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS s20,
         avg(close) OVER (PARTITION BY ticker ORDER BY ts ROWS BETWEEN 200 PRECEDING AND CURRENT ROW) AS s200
       FROM t),
t2 AS (SELECT *, CASE WHEN close >= s20 THEN 1 ELSE -1 END AS f20,
              CASE WHEN close >= s200 THEN 1 ELSE -1 END AS f200 FROM t1)
SELECT ticker, ts, close, close_previous, close_change, {r('s20')} AS close_sma_20,
  CASE WHEN f20 > 0 AND f20 <> lag(f20) OVER {wt} THEN 1
       WHEN f20 < 0 AND f20 <> lag(f20) OVER {wt} THEN -1 ELSE 0 END AS close_sma_20_co,
  {r('s200')} AS close_sma_200,
  CASE WHEN f200 > 0 AND f200 <> lag(f200) OVER {wt} THEN 1
       WHEN f200 < 0 AND f200 <> lag(f200) OVER {wt} THEN -1 ELSE 0 END AS close_sma_200_co
FROM t2"""
    exact = c("brand", "refined") + ", " + O.exact_flags("refined_brand", "date")
    sql["sma_exact_double"] = exact + f"SELECT ticker, date, {r('s20')} AS close_sma_20, {r('s200')} AS close_sma_200 FROM e2"
    sql["crossover_exact_double"] = exact + f"""SELECT ticker, date, {O._co('f20')} AS close_sma_20_co,
  {O._co('f200')} AS close_sma_200_co FROM e2"""
    sql["metrics_ticks_exact"] = ("WITH t AS (SELECT event_type AS ticker, ts, value AS close FROM events), " + O.exact_flags("t", "ts")
                                  + f"""SELECT ticker, ts, close, lag(close) OVER {wt} AS close_previous,
  (close - lag(close) OVER {wt}) / nullif(lag(close) OVER {wt}, 0) * 100 AS close_change,
  {r('s20')} AS close_sma_20, {O._co('f20').replace(O.W, wt)} AS close_sma_20_co,
  {r('s200')} AS close_sma_200, {O._co('f200').replace(O.W, wt)} AS close_sma_200_co FROM e2""")
    sql["metrics_ticks"] = ticks
    sql["metrics_ticks_long"] = ticks
    sql["alert_price_5_sql"] = sql["alert_price_5"]
    sql["alert_sma_20_sql"] = sql["alert_sma_20"]
    hits = c("user", "metrics") + ",\n" + O.RULES_VALUES + ",\n" + O.hits_sql("user") + "\n"
    hits_all = c("user", "metrics") + ",\n" + O.RULES_VALUES + ",\n" + O.hits_sql("user", False) + "\n"
    state = """state AS (
  SELECT r.rule_id, r.rule_type, r.threshold, r.periods,
    CASE WHEN r.rule_type = 'eod_change'
         THEN 'US_' || r.metric || '_' || CAST(CAST(r.threshold AS BIGINT) AS VARCHAR)
         ELSE 'US_' || r.metric END AS query_name,
    coalesce(h.n, 0) AS n_hits
  FROM rules r LEFT JOIN (SELECT rule_id, count(*) AS n FROM hits_user GROUP BY rule_id) h
    ON r.rule_id = h.rule_id
)
"""
    sql["alert_hits"] = hits + "SELECT rule_id, ticker, date, value FROM hits_user"
    sql["alert_rules_sql"] = sql["alert_hits"]
    sql["alert_state"] = hits + ", " + state + """SELECT rule_id, query_name,
  'Alert - ' || query_name AS alert_name, n_hits,
  CASE WHEN n_hits > 0 THEN 'TRIGGERED' ELSE 'UNKNOWN' END AS state FROM state"""
    sql["alert_messages"] = hits + ", " + state + """SELECT rule_id, 'Alert - ' || query_name AS alert_name,
  n_hits,
  CASE WHEN rule_type = 'eod_change'
       THEN 'US - ' || CAST(CAST(threshold AS BIGINT) AS VARCHAR) || '% change.'
       ELSE 'US - ' || CAST(periods AS VARCHAR) || ' day moving average' END AS subject,
  CASE WHEN rule_type = 'eod_change'
       THEN 'The following tickers prices changed more than  '
            || CAST(CAST(threshold AS BIGINT) AS VARCHAR) || '% today:'
       ELSE 'The following tickers crossed the ' || CAST(periods AS VARCHAR)
            || ' day moving average today:' END AS body
FROM state WHERE n_hits > 0"""
    firing = ", firing AS (SELECT rule_id, date, count(*) AS n_hits FROM hits_user GROUP BY rule_id, date)\n"
    sql["alert_history"] = hits_all + firing + "SELECT * FROM firing"
    sql["alert_rearm"] = _rearm_oracle("user", REARM_GAP_DAYS)
    sql["alert_rearm_100"] = _rearm_oracle("brand", DEFAULT_REARM)
    sql["rules_many"] = c("user", "metrics") + f"""SELECT 'part_' || p_partkey AS rule_id, ticker, date, close_change AS value
FROM metrics_user JOIN part ON abs(close_change) > CAST(p_retailprice AS DOUBLE) / 100 WHERE {latest_user}"""
    said = sql["alert_messages"]
    sql["alert_message_rows"] = f"""WITH m AS ({said}), h AS ({sql["alert_hits"]})
SELECT rule_id, 0 AS part, CAST(NULL AS VARCHAR) AS ticker, subject AS text FROM m
UNION ALL SELECT rule_id, 1, NULL, body FROM m
UNION ALL SELECT rule_id, 2, ticker, ticker || ' ' || CAST(date AS VARCHAR) || ' ' || CAST(CAST(value AS DECIMAL(10,3)) AS VARCHAR) FROM h"""
    sql["alert_rearm_stream"] = sql["alert_rearm"]
    sql["alert_rearm_state"] = sql["alert_rearm_100"]
    sql["alert_rearm_long"] = sql["alert_rearm_100"]
    sql["alert_rearm_events"] = """WITH RECURSIVE kept AS (SELECT min(ts) AS ts FROM events
  UNION ALL SELECT (SELECT min(e.ts) FROM events e WHERE e.ts >= kept.ts + INTERVAL 6 HOUR) FROM kept WHERE kept.ts IS NOT NULL)
SELECT 'any_event' AS rule_id, ts FROM kept WHERE ts IS NOT NULL"""
    sql["rules_ranked"] = c("user", "metrics") + f"""SELECT 'close_change' AS metric, ticker, date, close_change AS value, count(*) AS n_rules
FROM metrics_user JOIN part ON abs(close_change) > CAST(p_retailprice AS DOUBLE) / 100 WHERE {latest_user} GROUP BY ticker, date, close_change"""
    sql["rules_fired"] = c("user", "metrics") + f"""SELECT 'part_' || p_partkey AS rule_id, count(close_change) AS n_hits
FROM part LEFT JOIN (SELECT close_change FROM metrics_user WHERE {latest_user}) ON abs(close_change) > CAST(p_retailprice AS DOUBLE) / 100
GROUP BY p_partkey"""
    sql["metrics_state_stream"] = sql["metrics_all"]
    sql["bars_clustered"] = sql["bars_brand"]
    sql["metrics_corrected"] = sql["metrics_all"]
    sql["metrics_bucketed"] = sql["metrics_all"]
    sql.update(_ingest_oracle())
    sql.update(_landing_oracle())
    return sql


def _rearm_oracle(kind: str, gap: int) -> str:
    chain = O.chain(kind, "metrics") + ",\n" + O.RULES_VALUES + ",\n" + O.hits_sql(kind, False)
    return "WITH RECURSIVE " + chain[len("WITH "):] + f""",
f AS (SELECT rule_id, date, row_number() OVER (PARTITION BY rule_id ORDER BY date) AS rn
      FROM (SELECT DISTINCT rule_id, date FROM hits_{kind})),
rec AS (
  SELECT rule_id, rn, date, date AS last_kept, true AS kept FROM f WHERE rn = 1
  UNION ALL
  SELECT f.rule_id, f.rn, f.date,
         CASE WHEN f.date >= rec.last_kept + {gap} THEN f.date ELSE rec.last_kept END,
         f.date >= rec.last_kept + {gap}
  FROM rec JOIN f ON f.rule_id = rec.rule_id AND f.rn = rec.rn + 1
)
SELECT rule_id, date FROM rec WHERE kept"""


def _landing_oracle() -> dict[str, str]:
    days = "datediff('day', DATE '1995-01-01', date)"
    n = "CAST(ticker AS BIGINT)"

    def k(offset):
        return f"(({days} * 7 + {n} * 3 + {offset}) % 23)"

    short, odd = f"{k(6)} = 0", f"{n} % 2 = 1"
    landed = f"""SELECT ticker, date, open, high,
       CASE WHEN {short} AND {odd} THEN NULL ELSE low END AS low, close,
       CASE WHEN {short} AND NOT ({odd}) THEN NULL ELSE volume END AS volume
FROM dirty_user WHERE {k(5)} <> 0"""
    base = O.chain("user", "dirty") + f", dirty_landed AS (\n{landed}\n)\n"
    full = base.rstrip("\n")
    for name, fn in O.STAGES[2:]:
        full += f",\n{name}_landed AS (\n{fn('landed')}\n)"
    full += ",\n" + O.RULES_VALUES + ",\n" + O.hits_sql("landed") + "\n"
    return {
        "landing_csv": base + "SELECT *, 'US' AS exchange FROM dirty_landed",
        "landing_drift": O.chain("user", "bars") + f"""SELECT ticker, date, open, high, low, close,
  CASE WHEN {odd} THEN volume END AS volume, CASE WHEN {odd} THEN 'Trades=' || (volume * 3) ELSE '' END AS extra FROM bars_user""",
        "landing_source": base + "SELECT *, 'US' AS exchange FROM dirty_landed",
        "quarantine_bad_rows": O.chain("user", "dirty")
        + f"SELECT ticker, strftime(date, '%Y/%m/%d') AS date_text, 'bad date' AS reason "
          f"FROM dirty_user WHERE {k(5)} = 0",
        "stream_ingest": base + "SELECT * FROM dirty_landed",
        "landing_reconcile": O.chain("user", "dirty") + f""", lines AS (
  SELECT ticker, date, {k(5)} = 0 AS bad FROM dirty_user WHERE date <= DATE '2024-01-20'
  UNION ALL SELECT ticker, date, {k(5)} = 0 FROM dirty_user WHERE date >= DATE '2024-01-15')
SELECT ticker, count(*) AS n_lines, count(DISTINCT date) FILTER (NOT bad) AS n_raw,
       count(*) FILTER (bad) AS n_quarantined,
       count(*) FILTER (NOT bad) - count(DISTINCT date) FILTER (NOT bad) AS n_duplicates
FROM lines GROUP BY ticker""",
        "daily_pipeline": full + "SELECT rule_id, ticker, date, value FROM hits_landed",
        "daily_pipeline_long": full + "SELECT rule_id, ticker, date, value FROM hits_landed",
        "daily_incremental": full + "SELECT rule_id, ticker, date, value FROM hits_landed",
        "metrics_stream": full + "SELECT ticker, date, open, high, low, close, volume, close_previous, "
        "close_change, round(close_sma_20 + 1e-8, 6) AS close_sma_20, close_sma_20_co, "
        "round(close_sma_200 + 1e-8, 6) AS close_sma_200, close_sma_200_co FROM metrics_landed",
    }


def _ingest_oracle() -> dict[str, str]:
    base = O.chain("user", "bars") + """, sink AS (SELECT * FROM bars_user WHERE date <= DATE '2024-01-20'),
upd AS (
  SELECT * FROM bars_user WHERE date >= DATE '2024-01-15'
  UNION ALL SELECT * FROM bars_user WHERE date = DATE '2024-01-25'
  UNION ALL SELECT ticker, date, open, high, low, close * 2 AS close, volume
            FROM bars_user WHERE date = DATE '2024-01-16'
),
uni AS (SELECT DISTINCT 'US' AS exchange, ticker FROM bars_user
        UNION ALL SELECT 'US', 'NODATA'),
ld AS (SELECT ticker, max(date) AS last_date FROM sink GROUP BY ticker),
hwm AS (SELECT u.exchange, u.ticker, coalesce(ld.last_date, DATE '2023-01-01') AS last_date
        FROM uni u LEFT JOIN ld ON u.ticker = ld.ticker),
dd AS (SELECT ticker, date,
         min({'open': open, 'high': high, 'low': low, 'close': close, 'volume': volume}) AS m
       FROM upd GROUP BY ticker, date),
dedup AS (SELECT ticker, date, m.open AS open, m.high AS high, m.low AS low, m.close AS close,
                 m.volume AS volume FROM dd),
fresh AS (SELECT * FROM dedup d WHERE NOT EXISTS
            (SELECT 1 FROM sink s WHERE s.ticker = d.ticker AND s.date = d.date))
"""
    return {
        "last_dates": base + "SELECT * FROM ld",
        "global_last_date": base + "SELECT coalesce(max(date), DATE '2023-01-01') AS last_date FROM sink",
        "global_last_date_footers": base + "SELECT coalesce(max(date), DATE '2023-01-01') AS last_date FROM sink",
        "last_dates_footers": O.chain("event_type", "bars") + "SELECT ticker, max(date) AS last_date FROM bars_event_type GROUP BY ticker",
        "high_water_mark": base + "SELECT * FROM hwm",
        "ingest_plan": base + """SELECT exchange, ticker, last_date,
  upper(ticker) || '.' || upper(exchange) AS symbol,
  last_date + 1 AS date_from, DATE '2024-01-20' AS date_to,
  strftime(last_date + 1, '%Y-%m-%d') AS date_from_text, '2024-01-20' AS date_to_text
FROM hwm WHERE DATE '2024-01-20' > last_date""",
        "symbol_build": base + "SELECT exchange, ticker, upper(ticker) || '.' || upper(exchange) AS symbol FROM uni",
        "dedupe_batch": base + "SELECT * FROM dedup",
        "new_rows": base + "SELECT * FROM fresh",
        "insert_only_upsert": base + "SELECT * FROM sink UNION ALL SELECT * FROM fresh",
        "upsert_table": base.replace("UNION ALL SELECT ticker, date, open, high, low, close * 2 AS close, volume",
                                     "UNION ALL SELECT ticker, date, open, high, low, close / 2 AS close, volume") + """SELECT * FROM sink s WHERE NOT EXISTS
  (SELECT 1 FROM dedup d WHERE d.ticker = s.ticker AND d.date = s.date) UNION ALL SELECT * FROM dedup""",
        "upsert_update": base + """SELECT * FROM sink s WHERE NOT EXISTS
  (SELECT 1 FROM dedup d WHERE d.ticker = s.ticker AND d.date = s.date) UNION ALL SELECT * FROM dedup""",
        "dedupe_nulls": base + "SELECT * FROM dedup",
        "merge_date_only": """WITH days AS (SELECT 'ALL' AS ticker, CAST(ts AS DATE) AS date, arg_min(value, row(ts, user_id, value)) AS open,
  max(value) AS high, min(value) AS low, arg_max(value, row(ts, user_id, value)) AS close, count(*) AS volume FROM events GROUP BY 2),
upd AS (SELECT * FROM days WHERE date >= DATE '2024-01-15'
        UNION ALL SELECT ticker, date, open, high, low, close * 2, volume FROM days WHERE date = DATE '2024-01-16'),
dd AS (SELECT date, min({'open': open, 'high': high, 'low': low, 'close': close, 'volume': volume}) AS m FROM upd GROUP BY date)
SELECT * FROM days WHERE date <= DATE '2024-01-20'
UNION ALL SELECT 'ALL', date, m.open, m.high, m.low, m.close, m.volume FROM dd WHERE date > DATE '2024-01-20'""",
    }


def oracle_sql() -> dict[str, str]:
    out = _oracle()
    if LLM is not None:
        out.update(LLM.ORACLE_SQL)
    if PIPELINE is not None and PIPELINE.ORACLE_SQL:
        out["pipeline"] = PIPELINE.ORACLE_SQL
    return out
