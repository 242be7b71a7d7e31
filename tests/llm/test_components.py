import random

from hoopline.llm.components import connected_components, forest


def test_forest():
    assert forest([(5, 3), (3, 9), (7, 7)]) == {5: 3, 3: 3, 9: 3, 7: 7}


def test_many_tasks_equal_one(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(150)]
    edges += [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2100)] + [(5, 5), (1, None)]
    df = spark.createDataFrame(edges, "a long, b long")
    expected = forest((a, b) for a, b in edges if b is not None)
    for per_task in (1_000_000, 20):
        got = {r["node"]: r["root"] for r in connected_components(df, per_task).collect()}
        assert got == expected


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
