"""Stored rules as one generated statement over a path table."""

import datetime as dt
import tempfile

from barlake.config import DEFAULT_ALERTS, alert_rules
from barlake.operators import alerts as A
from barlake.operators import metrics as M
from barlake.plans import saved_queries as SQ
from barlake.sources.tables import overwrite


def d(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def test_statement_matches_rule_hits(spark):
    data = [("A", d(0), 100.0), ("A", d(1), 106.0), ("A", d(2), 100.0), ("it's", d(2), 1.0),
            ("B", d(0), 10.0), ("B", d(1), 9.5), ("B", d(2), 10.0)]
    m = M.compute_metrics(spark.createDataFrame(data, "ticker string, date date, close double"))
    path = tempfile.mkdtemp(prefix="barlake-metrics-") + "/m"
    overwrite(m, path, ["date"])
    out = SQ.run_saved(spark, SQ.hits_statement(SQ.table_ref(path), DEFAULT_ALERTS))
    want = A.rule_hits(m, alert_rules(spark)).collect()
    assert want and sorted(map(tuple, out.collect())) == sorted(map(tuple, want))
    assert "PartitionFilters: [isnotnull(date" in out._jdf.queryExecution().toString()
