import random

import pytest

from txflow.operators.ranks import exact_percentiles, running_total

RANKS = {"p50": 0.50, "p95": 0.95, "p99": 0.99, "top": 1.0}


def brute(values, rank):
    ordered = sorted(values)
    return ordered[min(int(rank * len(ordered)), len(ordered) - 1)]


def groups():
    rng = random.Random(11)
    made = {size: [rng.randint(0, 5_000_000) for _ in range(size)] for size in (1, 2, 3, 19, 20, 21, 100, 200)}
    made["negative"] = [rng.randint(-3000, 3000) for _ in range(500)]
    made["equal"] = [42] * 300
    made["hot"] = [rng.choice([5, 5, 5, rng.randint(0, 10**12)]) for _ in range(5000)]
    return {str(name): values for name, values in made.items()}


@pytest.mark.parametrize("bits", [1, 8, 20])
def test_percentiles_equal_brute_force(spark, bits):
    data = groups()
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k string, v long").repartition(5)
    rows = exact_percentiles(df, ["k"], "v", RANKS, bits=bits).collect()
    assert len(rows) == len(data)
    for r in rows:
        assert {name: r[name] for name in RANKS} == {name: brute(data[r.k], p) for name, p in RANKS.items()}


def test_percentiles_of_the_whole_table_and_of_counted_input(spark):
    values = [v for vs in groups().values() for v in vs]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    expected = {name: brute(values, p) for name, p in RANKS.items()}
    assert exact_percentiles(df, [], "v", RANKS).first().asDict() == expected
    counted = df.groupBy("v").count()
    assert exact_percentiles(counted, [], "v", RANKS, weight="count").first().asDict() == expected


@pytest.mark.parametrize("bits", [1, 4, 20])
def test_running_total_equals_brute_force(spark, bits):
    rng = random.Random(5)
    rows = [(i, rng.randint(-3, 5)) for i in rng.sample(range(-200, 5000), 800)]
    total, expected = 0, {}
    for i, w in sorted(rows):
        total += w
        expected[i] = total
    df = spark.createDataFrame(rows, "i long, w long").repartition(6)
    assert {r.i: r.running for r in running_total(df, "i", "w", bits).collect()} == expected
