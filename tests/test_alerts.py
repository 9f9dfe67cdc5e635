"""R1-R6, P9-P13, O1 and F11."""

import datetime as dt

from barlake.config import alert_rules
from barlake.operators import alerts as A
from barlake.operators import metrics as M

SCHEMA = "ticker string, date date, close double"


def d(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def metrics(spark):
    data = [("A", d(0), 100.0), ("A", d(1), 106.0), ("A", d(2), 100.0),
            ("B", d(0), 10.0), ("B", d(1), 9.5), ("B", d(2), 10.0),
            ("C", d(0), 50.0), ("C", d(1), 60.0),  # no bar on the latest day
            ("D", d(0), 10.0), ("D", d(1), 10.0), ("D", d(2), 10.5)]  # exactly +5%
    return M.compute_metrics(spark.createDataFrame(data, SCHEMA))


def test_price_alert_is_strict_table_wide_latest_day(spark):
    m = metrics(spark)
    got = {r.ticker: r.close_change for r in A.price_change_alert(m, 5).collect()}
    # A: 106 -> 100 is -5.66%; B: +5.26%; D: exactly +5% is not > 5; C is absent.
    assert set(got) == {"A", "B"}
    assert str(got["A"]) == "-5.660" and str(got["B"]) == "5.263"


def test_sma_alert_labels_and_order(spark):
    m = metrics(spark)
    out = A.sma_cross_alert(m, 20).collect()
    assert [r.ticker for r in out] == ["A", "B"]
    assert out[0].sma_text == "Went below 20 day moving average."
    assert out[1].sma_text == "Went above 20 day moving average."


def test_hits_state_messages(spark):
    m = metrics(spark)
    rules = alert_rules(spark)
    hits = A.rule_hits(m, rules)
    got = sorted((r.rule_id, r.ticker) for r in hits.collect())
    assert got == [("change_5", "A"), ("change_5", "B"), ("sma_20", "A"), ("sma_20", "B"),
                   ("sma_200", "A"), ("sma_200", "B")]
    state = {r.rule_id: r for r in A.alert_state(rules, hits).collect()}
    assert state["change_10"].state == "UNKNOWN" and state["change_5"].state == "TRIGGERED"
    assert state["change_5"].query_name == "US_close_change_5"
    assert state["sma_20"].alert_name == "Alert - US_close_sma_20_co"
    msgs = {r.rule_id: r for r in A.alert_messages(rules, hits).collect()}
    assert msgs["change_5"].subject == "US - 5% change."
    assert msgs["change_5"].body == "The following tickers prices changed more than  5% today:"
    assert msgs["sma_200"].subject == "US - 200 day moving average"


def test_rearm_keeps_gap_from_last_kept(spark):
    firings = spark.createDataFrame([("r", d(i)) for i in (1, 2, 3, 4, 5, 9)], "rule_id string, date date")
    kept = sorted(r.date for r in A.rearm(firings, 3).collect())
    assert kept == [d(1), d(4), d(9)]


def test_rules_of_any_number_give_the_same_rows(spark):
    """One path whether rules are few or many, and whatever other columns the
    metrics have."""
    m = spark.createDataFrame([("A", "x", 7.0, 1), ("B", "y", -2.0, 0)], "ticker string, note string, close_change double, close_sma_20_co int") \
        .selectExpr("ticker", "date'2024-01-01' AS date", "note", "close_change", "close_sma_20_co")
    few = spark.createDataFrame([("r5", "close_change", 5.0), ("c", "close_sma_20_co", 0.0)], "rule_id string, metric string, threshold double")
    many = few.unionByName(spark.range(20_000).selectExpr("concat('z', id) AS rule_id", "'close_change' AS metric", "1000.0D AS threshold"))
    got = [sorted(map(tuple, A.rule_hits(m, r).collect())) for r in (few, many)]
    assert got[0] == got[1] and [x[0] for x in got[0]] == ["c", "r5"]
