"""Lloyd steps against plain Python."""

import random
import statistics

from zonescope.operators import clusters


def lloyd_brute(rows, k, steps):
    columns = list(zip(*[[0.0 if v is None else v for v in values] for _, *values in rows], strict=True))
    scaled = []
    for column in columns:
        mean, deviation = statistics.fmean(column), statistics.pstdev(column)
        scaled.append([round((v - mean) / deviation, 9) if deviation else 0.0 for v in column])
    points = list(zip(*scaled, strict=True))
    keys = [row[0] for row in rows]

    def d(a, b):
        return round(sum((x - y) ** 2 for x, y in zip(a, b, strict=True)), 9)

    seeds = []
    while len(seeds) < k:
        far = [(-min([d(p, s) for s in seeds], default=d(p, [0.0] * len(p))), key, p) for p, key in zip(points, keys, strict=True)]
        best = min(far)
        if seeds and best[0] == 0:
            break
        seeds.append(best[2])
    assign = lambda: [min(range(len(seeds)), key=lambda i: (d(p, seeds[i]), i)) for p in points]
    for _ in range(steps):
        at = assign()
        for i in range(len(seeds)):
            own = [p for p, c in zip(points, at, strict=True) if c == i]
            if own:
                seeds[i] = [round(statistics.fmean(v), 9) for v in zip(*own, strict=True)]
    return dict(zip(keys, assign(), strict=True))


def test_lloyd_equals_brute_force(spark):
    rnd = random.Random(12)
    rows = [(f"z{i:03}", rnd.choice([0.0, 10.0, 50.0]) + rnd.gauss(0, 1), rnd.choice([None, 5.0, 9.0]), 3.0) for i in range(150)]
    df = spark.createDataFrame(rows, "zone string, a double, b double, c double")
    for k, steps in ((4, 5), (1, 2), (3, 0)):
        got = {r.zone: r.cluster for r in clusters.lloyd(df.repartition(3), "zone", ["a", "b", "c"], k, steps).collect()}
        assert got == lloyd_brute(rows, k, steps)


def test_fewer_points_than_clusters_and_none(spark):
    schema = "zone string, a double, b double"
    few = spark.createDataFrame([("x", 1.0, 1.0), ("y", 1.0, 1.0), ("z", 2.0, None)], schema)
    got = {r.zone: r.cluster for r in clusters.lloyd(few, "zone", ["a", "b"], k=5).collect()}
    assert got["x"] == got["y"] != got["z"] and set(got.values()) == {0, 1}
    assert clusters.lloyd(spark.createDataFrame([], schema), "zone", ["a", "b"]).collect() == []
