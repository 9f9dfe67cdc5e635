"""Mixing: the query against its SQL, odd rows and properties of the sample."""

from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from barlake.llm import mixing
from barlake.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "doc_id long, source string, text string, size string, rank int, uid int, n long"


def by_sql(sql, **tables):
    con = duckdb.connect()
    for name, path in tables.items():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    res = con.execute(sql)
    cols = [c[0] for c in res.description]
    return cols, [dict(zip(cols, r)) for r in res.fetchall()]


def same(df, sql, **tables):
    cols, want = by_sql(sql, **tables)
    assert sorted(cols) == sorted(df.columns)
    rows = [r.asDict() for r in df.collect()]
    assert sorted(map(repr, (sorted(r.items()) for r in rows))) == sorted(map(repr, (sorted(r.items()) for r in want)))
    return rows


def test_mixing_query(spark, sf_small):
    rows = same(QUERIES["op13_pareto_mixing"](spark, sf_small), ORACLE_SQL["op13_pareto_mixing"], documents=f"{sf_small}/documents.parquet")
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] in range(4)
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in rows))
    assert max(abs(taken[s] - target[s]) / target[s] for s in target) < 0.06


def rows_of(texts):
    return [(d, s, t, "x", 1, 2, 3) for d, s, t in texts]


def odd_documents():
    words = lambda n: " ".join(["w"] * n)
    texts = [(i, "a", words(1 + i % 7)) for i in range(40)] + [(1000, "a", words(900))]
    texts += [(50 + i, "b", words(3)) for i in range(5)] + [(7, "c", words(2))] * 30 + [(60 + i, None, words(5)) for i in range(20)]
    texts += [(80, "empty", None), (81, "empty", ""), (82, "empty", " \t\n\x0b\x0c\r "), (None, "a", words(4)), (None, "a", words(4)), (None, None, None)]
    return texts + [(90, "\U0001f600", " x y  z\t"), (91, "￿", "q\x0bq\x1cq")]


def test_mixing_odd_rows(spark, tmp_path):
    docs = spark.createDataFrame(rows_of(odd_documents()), SCHEMA).repartition(4)
    docs.write.parquet(f"{tmp_path}/d")
    rows = same(mixing.mix(docs).drop("uid"), ORACLE_SQL["op13_pareto_mixing"], documents=f"{tmp_path}/d/*.parquet")
    assert {r["taken"] for r in rows if r["source"] == "empty"} == {0}
    assert {r["size"] for r in rows if r["doc_id"] == 90} == {2}
    assert all(r["taken"] <= 3 * r["size"] for r in rows)


def test_mixing_does_not_depend_on_the_layout(spark):
    docs = spark.createDataFrame(rows_of(odd_documents()), SCHEMA)
    shape = lambda df: sorted(map(str, df.drop("uid").collect()))
    assert shape(mixing.mix(docs.repartition(7, "n", "doc_id"))) == shape(mixing.mix(docs.coalesce(1)))


def test_mixing_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []


def test_mixed_documents_are_the_texts_as_often_as_taken(spark):
    docs = spark.createDataFrame(rows_of(odd_documents()), SCHEMA)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r["doc_id"], r["source"], r["size"]] += r["copies"]
    got = Counter((r["doc_id"], r["source"], len((r["text"] or "").replace(" ", "_").replace(" ", "_").replace("\x1c", "_").split()))
                  for r in mixed.collect())
    assert got == +want


def test_weights_multiply_the_inclusion_odds(spark):
    """Ten documents in a hundred with nine times the odds: the head of the
    order holds them about that much more often."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"),
                                    F.lit("w").alias("text"), F.when(F.col("id") % 10 == 0, 9.0).otherwise(1.0).alias("w"))
    out = mixing.mix(docs, weights=(1, 3), weight="w").where("source = 'a'")
    heavy, light = (out.where(c).agg(F.avg("copies")).first()[0] for c in ("doc_id % 10 = 0", "doc_id % 10 != 0"))
    assert out.agg(F.sum("copies")).first()[0] == 1000
    # Odds of 9 and 1 times o with 0.1 * 9o/(1+9o) + 0.9 * o/(1+o) = 0.5: o is 0.8.
    assert heavy == pytest.approx(0.88, abs=0.05) and light == pytest.approx(0.445, abs=0.04)
