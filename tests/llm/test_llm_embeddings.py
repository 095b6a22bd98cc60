"""Near copies among embeddings against all pairs."""

import math
import random

import numpy as np
import pytest
from llm_data import as_set

from docmart.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int, node string, class string, a string, copies string, n string"
COLS = ("vec_id", "n_links", "component_id", "kept")


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], schema)


def brute(rows, threshold=0.93):
    ok = [r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    x = [np.array(r[1], np.float32).astype(float) if o else None for r, o in zip(rows, ok)]
    near = [set() for _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]) and E.exact_cosine(x[i], x[j]) >= threshold:
                near[i].add(j)
                near[j].add(i)
    out, low = [], list(range(len(rows)))
    key = lambda i: (rows[i][0] is None, rows[i][0] or 0)
    for i in sorted(range(len(rows)), key=key):
        todo, seen = [i], {i}
        while todo:
            for k in near[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        low[i] = rows[min(seen, key=key)][0]
    for i, r in enumerate(rows):
        out.append((r[0], len(near[i]), low[i], r[0] == low[i]))
    return sorted(out, key=repr)


def cloud(rng, n, dim=24, labels=3, groups=12):
    centres = rng.standard_normal((groups, dim))
    rows = []
    for i in range(n):
        kind = i % 4
        v = rng.standard_normal(dim) if kind == 0 else centres[i % groups] + rng.standard_normal(dim) * rng.choice([0.02, 0.1])
        rows.append((i, [float(np.float32(a)) for a in v], int(rng.integers(labels))))
    return rows


def awkward_vectors():
    v = [0.5, -0.25, 1.0, 0.125]
    return [
        (1, v, 0), (2, [2 * a for a in v], 0), (3, v, 1), (4, None, 0), (5, [], 0), (6, [0.0] * 4, 0), (7, [float("nan"), 1.0, 1.0, 1.0], 0),
        (8, [float("inf"), 1.0, 1.0, 1.0], 0), (9, [None, 1.0, 1.0, 1.0], 0), (10, v, None), (None, v, 0), (None, [9.0, 1.0, 0.0, 0.0], 0),
        (11, v, 0), (11, v, 0), (12, [-a for a in v], 0), (13, v + [0.0], 0), (-14, v, 1), (15, [1e-38 * a for a in v], 0), (16, [3e38 * a for a in v], 0),
        (17, [-0.0, 1.0, 0.0, 0.0], 2), (18, [0.0, 1.0, 0.0, 0.0], 2), (None, None, None)]


def test_awkward_rows_match_all_pairs(spark):
    rows = awkward_vectors()
    assert as_set(E.label(table(spark, rows).repartition(2)), *COLS) == brute(rows)
    assert E.label(table(spark, [])).count() == 0


@pytest.mark.parametrize("tile", [2048, 16])
def test_links_match_all_pairs(spark, tile):
    """Small tiles: cut buckets, cut groups, and groups compared by buckets."""
    rows = cloud(np.random.default_rng(5), 400)
    got = as_set(E.label(table(spark, rows), tile=tile, recall=0.99999999), *COLS)
    assert got == brute(rows) and max(r[1] for r in got) > 5


def test_hot_label_and_hot_vector(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal(16).astype(np.float32).tolist()
    rows = [(i, base, 0) for i in range(300)] + [(1000 + i, rng.standard_normal(16).astype(np.float32).tolist(), 0) for i in range(300)]
    rows += [(2000, [a * 1.01 for a in base], 0)]
    got = {r["vec_id"]: r for r in E.label(table(spark, rows)).collect()}
    assert all(got[i]["n_links"] == 300 and got[i]["component_id"] == 0 and got[i]["kept"] == (i == 0) for i in range(300))
    assert got[2000]["n_links"] == 300 and got[2000]["component_id"] == 0


def test_recall_at_the_threshold(spark):
    """Pairs right above the threshold, the hardest to find."""
    rng, rows = np.random.default_rng(7), []
    for i in range(400):
        a = rng.standard_normal(64)
        b = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist(), 0), (2 * i + 1, (0.9305 * a + math.sqrt(1 - 0.9305**2) * b).tolist(), 0)]
    schema = SCHEMA.replace("array<float>", "array<double>")
    linked = E.label(table(spark, rows, schema)).filter("n_links > 0").count()
    assert linked >= 0.98 * len(rows)


def test_borderline_pairs_are_taken_exactly():
    x = np.array([1.0, 0.0])
    y = np.array([0.93, math.sqrt(1 - 0.93**2)])
    assert abs(E.exact_cosine(x, y) - 0.93) < 1e-15
    rng = random.Random(8)
    for _ in range(100):
        a, b = (np.array([rng.uniform(-1, 1) for _ in range(9)]) for _ in range(2))
        assert abs(E.exact_cosine(a, b) - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-14


def test_dedup_keeps_columns(spark):
    rows = awkward_vectors()
    got = E.dedup(table(spark, rows))
    assert got.columns == ["vec_id", "embedding", "label", "node", "class", "a", "copies", "n"]
    want = {i for i, _, _, kept in brute(rows) if kept}
    assert {r["vec_id"] for r in got.collect()} == want


def test_plan_keeps_the_recall_at_every_size():
    for n in (0, 1, 10**4, 10**7, 10**11):
        width, tables = E.plan(n, 0.93, 0.995)
        same = 1 - math.acos(0.93) / math.pi
        assert 1 - (1 - same**width) ** tables >= 0.995 and width <= 24
