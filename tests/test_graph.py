import random

from pyspark.sql import functions as F

from weftline.operators import components
from weftline.operators.components import connected_components
from weftline.operators.skew import deal, with_totals


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 130)] + [(200, 200 + i) for i in range(30)] + [(7, None), (500, 500)]
    for few in (0, 100_000):
        got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long"), few=few).collect()}
        assert got == brute(edges)
    text = [(f"n{a}", f"n{b}") for a, b in edges if a is not None and b is not None]
    assert {r.node: r.component for r in connected_components(spark.createDataFrame(text, "src string, dst string")).collect()} == brute(text)


def test_components_with_hot_nodes(spark, monkeypatch):
    monkeypatch.setattr(components, "HOT_EDGES", 3)
    edges = [(1000, i) for i in range(40)] + [(i, i + 1) for i in range(50, 70)] + [(i % 7 + 80, i) for i in range(100, 150)] + [(5, 60)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "src long, dst long"), few=0).collect()}
    assert got == brute(edges)


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_totals_reach_every_row(spark):
    rows = [(i, "hot" if i % 3 else f"k{i}") for i in range(600)]
    df = deal(spark.createDataFrame(rows, "id long, k string"), ["k"], F.xxhash64("id"))
    out = with_totals(df, ["k"], {"n": (F.count("*"), F.sum), "top": (F.max("id"), F.max)})
    got = {(r.id, r.n, r.top) for r in out.collect()}
    assert got == {(i, 400 if i % 3 else 1, 599 if i % 3 else i) for i, _ in rows}


def test_edges_are_made_once(spark):
    """The rounds and the search for loops read the cut edges, not what made them."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(len(b))
            yield b

    edges = spark.range(500, numPartitions=3).selectExpr("id as src", "id div 2 as dst").mapInPandas(count, "src long, dst long")
    for n, few in enumerate((0, 1000), 1):
        assert connected_components(edges, few=few).where("component = 0").count() == 500
        assert made.value == n * 500


def test_totals_in_order_equal_totals(spark):
    rows = [(i, "hot" if i % 3 else f"k{i}") for i in range(600)]
    df = deal(spark.createDataFrame(rows, "id long, k string"), ["k"], F.xxhash64("id"))
    out = with_totals(df, ["k"], {"n": (F.count("*"), F.sum), "top": (F.max(F.struct("id")), F.max)}, in_order=True)
    got = {(r.id, r.n, r.top.id) for r in out.collect()}
    assert got == {(i, 400 if i % 3 else 1, 599 if i % 3 else i) for i, _ in rows}
    assert "SortAggregate" in out._jdf.queryExecution().executedPlan().toString()
