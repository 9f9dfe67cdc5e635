"""The sanity figures of FIXTURES.md F4 (all five measures dirtied, sf0.001):
rows left after refine, latest-day alert counts, and rows where the
independently filled columns give high < low (quirk Q15, kept)."""

import pytest
from pyspark.sql import functions as F

from barlake.config import alert_rules
from barlake.operators import alerts as A
from barlake.plans import chains

# kind: rows left, (tickers, >5 %, >10 %, SMA20 cross, SMA200 cross), high < low
FIGURES = {
    "user": (386, (14, 12, 12, 8, 8), 20),
    "brand": (5685, (2, 1, 1, 0, 0), 693),
}


@pytest.mark.parametrize("kind", sorted(FIGURES))
def test_fixture_figures(spark, sf_small, kind):
    rows, latest, inverted = FIGURES[kind]
    refined = chains.refined(spark, sf_small, kind)
    assert refined.count() == rows
    assert refined.where(F.col("high") < F.col("low")).count() == inverted
    metrics = chains.metrics(spark, sf_small, kind)
    tickers = A.latest_day(metrics).count()
    hits = {r.rule_id: r.n_hits for r in
            A.alert_state(alert_rules(spark), A.rule_hits(metrics, alert_rules(spark))).collect()}
    assert (tickers, hits["change_5"], hits["change_10"], hits["sma_20"], hits["sma_200"]) == latest
