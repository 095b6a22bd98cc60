"""Mixing to target weights and sharding by histogram sort."""

import random
import re
import zlib
from collections import defaultdict

import pytest
from llm_data import awkward, documents, prose

from docmart.llm import mixing, sharding


def corpus(seed, n=400, sources=("a", "b", "c", "d", None)):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = "a" if i % 3 == 0 else rng.choice(sources)
        rows.append((i, prose(rng, rng.randrange(1, 80)), "en", s, 1))
    return rows


def size(text):
    return len([w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w])


def waterfill(sizes, weights, cap=3.0):
    """Targets by repeated resharing."""
    total, target, open_ = sum(sizes.values()), {}, set(sizes)
    while open_:
        rest = total - sum(target.values())
        share = {s: rest * weights[s] / sum(weights[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > cap * sizes[s]}
        if not above:
            return {**target, **share}
        for s in above:
            target[s] = cap * sizes[s]
        open_ -= above
    return target


@pytest.mark.parametrize("seed,pieces", [(1, 4096), (2, 10)])
def test_mix_hits_targets(spark, seed, pieces):
    rows = corpus(seed)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r[1])
    names = sorted(sizes, key=lambda s: (s is None, s))
    want = waterfill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)})
    got = mixing.Mix(documents(spark, rows), rows_per_piece=pieces).documents().collect()
    assert sorted(r["doc_id"] for r in got) == [r[0] for r in rows]
    source = {r[0]: r[3] for r in rows}
    taken = defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == size(rows[r["doc_id"]][1]) and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.005 * want[s]  # whole documents of up to 80 words


@pytest.mark.parametrize("pieces", [16, 1024])
def test_mix_fills_behind_a_very_long_document(spark, pieces):
    rng = random.Random(9)
    rows = []
    for s in range(12):  # a document of half its source's words among short ones
        for k in range(150):
            n = 1500 if k == 75 else rng.randrange(5, 16)
            rows.append((len(rows), prose(rng, n), "en", f"s{s:02}", 1))
    mix = mixing.Mix(documents(spark, rows), rows_per_piece=pieces)
    order, target, taken = set(), {}, defaultdict(int)
    for r in mix._taken(mix.placed).collect():
        order.add(r["skey"])
        target[r["skey"]] = r["target"]
        taken[r["skey"]] += r["size"] * r["copies"]
        assert len(r["t"]) == r["copies"] and all(0 <= t <= 1 for t in r["t"])
    assert len(order) == 12
    assert all(abs(taken[s] - target[s]) < 5 for s in order)  # below the smallest document


def test_mix_caps_small_sources_and_reshares(spark):
    rows = [(i, "w " * 100, "en", "small", 1) for i in range(2)] + [(10 + i, "w " * 100, "en", "z", 1) for i in range(50)]
    got = {r["doc_id"]: r for r in mixing.Mix(documents(spark, rows)).documents().collect()}
    assert got[0]["target"] == 600 and got[0]["taken"] == 300 and got[10]["target"] == 5200 - 600
    assert sum(r["taken"] for r in got.values() if r["doc_id"] >= 10) == 4600


def test_mix_positions_follow_the_schedule(spark):
    """Words taken up to each progress t are the integral of the schedule, scaled to the target."""
    rows = corpus(3, 3000)
    mix = mixing.Mix(documents(spark, rows))
    kind = {s: i % 3 for i, s in enumerate(["a", "b", "c", "d", None])}
    placed = mix._taken(mix.placed).collect()
    by = defaultdict(list)
    source = {r[0]: r[3] for r in rows}
    for r in placed:
        by[source[r["doc_id"]]] += [(t, r["size"]) for t in r["t"]]
        target = r["target"]
    for s, points in by.items():
        total = sum(n for _, n in points)
        (_, w0), (_, w1) = mixing.CURRICULUM[kind[s]]
        for t in (0.25, 0.5, 0.75):
            want = (w0 * t + (w1 - w0) * t * t / 2) / ((w0 + w1) / 2)
            assert sum(n for x, n in points if x < t) / total == pytest.approx(want, abs=0.03)
    assert target > 0


def test_mix_named_schedules_of_many_segments(spark):
    points = ((0, 0), (0.5, 4), (0.5 + 1e-9, 0), (1, 0))
    rows = [(i, "w " * 10, "en", s, 1) for i, s in enumerate(["x", "y"] * 100)]
    mix = mixing.Mix(documents(spark, rows), named={"x": points, "y": ((0, 1), (1, 1))})
    got = mix._taken(mix.placed).filter("skey = '=x'").collect()
    assert got and all(t <= 0.5 + 1e-6 for r in got for t in r["t"])
    for bad in (((0, 1), (0.5, 1)), ((0, -1), (1, 1)), ((0, 1), (0.5, 1), (0.5, 2), (1, 1))):
        with pytest.raises(ValueError):
            mixing._segments(bad)


def test_mix_corpus_is_in_order_and_whole(spark):
    rows = corpus(4) + [(1000 + i, *r[1:]) for i, r in enumerate(awkward())]
    docs = documents(spark, rows)
    mix = mixing.Mix(docs, rows_per_piece=16)
    out = mix.corpus()
    assert out.columns == docs.columns
    counts = defaultdict(int)
    for r in out.collect():
        counts[r["doc_id"]] += 1
    assert counts == {r["doc_id"]: r["copies"] for r in mix.documents().collect() if r["copies"]}


def test_mix_awkward_reruns_and_empty(spark):
    docs = documents(spark, awkward())
    a, b = ([tuple(r) for r in mixing.Mix(d).documents().collect()] for d in (docs, docs.repartition(5)))
    assert sorted(a, key=repr) == sorted(b, key=repr) and len(a) == len(awkward())
    assert all(r[4] == 0 for r in a if r[1] == 0)
    assert mixing.Mix(documents(spark, [])).documents().count() == 0


# sharding -----------------------------------------------------------------------------------------

def shards(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["shard"]].append(r)
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_shards_are_even_whole_and_gapless(spark, hot):
    rng = random.Random(5)
    rows = [(i, "hot text " * 9 if hot and i % 3 == 0 else prose(rng, rng.randrange(1, 60)), "en", "a", 1) for i in range(3000)]
    got = shards(sharding.shard(documents(spark, rows).repartition(5), 8, rows_per_task=50))
    total, biggest = 0, max(len((r[1] or "").encode()) for r in rows)
    by_id = {r[0]: r for r in rows}
    sums = []
    for _, part in sorted(got.items()):
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
        for r in part:
            raw = by_id[r["doc_id"]][1].encode()
            assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        sums.append(sum(r["size"] for r in part))
        total += len(part)
    assert sorted(got) == list(range(8)) and total == len(rows)
    assert max(sums) - min(sums) <= 2 * (biggest + 0.005 * sum(sums) / 8) + 2


def test_equal_texts_share_a_shard_unless_too_large(spark):
    rng = random.Random(6)
    rows = [(i, f"group {i // 4} " + prose(random.Random(i // 4), 30), "en", "a", 1) for i in range(2000)]
    rng.shuffle(rows)
    where = defaultdict(set)
    text = {r[0]: r[1] for r in rows}
    for r in sharding.shard(documents(spark, rows), 8, tolerance=0.01).collect():
        where[text[r["doc_id"]]].add(r["shard"])
    assert sum(len(s) > 1 for s in where.values()) == 0


def brute_boundaries(keys, shards):
    """For each target the distance of the best boundary that keeps copies together, and of the best of all."""
    rows = sorted(keys)
    total, below, whole, parts = sum(r[2] for r in rows), 0, [0], [0]
    for i, (k1, _, size) in enumerate(rows):
        below += size
        parts.append(below)
        if i + 1 == len(rows) or rows[i + 1][0] != k1:
            whole.append(below)
    near = lambda at, t: min(abs(x - t) for x in at)
    return [(near(whole, total * i / shards), near(parts, total * i / shards)) for i in range(1, shards)], total


@pytest.mark.parametrize("case", ["prose", "repeated", "hot"])
def test_splitters_match_brute_force(spark, case):
    rng = random.Random(16)
    rows = [(i, prose(rng, rng.randrange(1, 60)), "en", "a", 1) for i in range(400)]
    if case == "repeated":
        rows = [(1, "x" * 999, "en", "a", 1)] * 100 + [(i, "abc", "en", "a", 1) for i in range(200)]
    if case == "hot":
        rows += [(1000 + i, "one text of many", "en", "a", 1) for i in range(2000)]
    keys = sharding.keyed(documents(spark, rows))
    table = [(r["k1"] + (1 << 63), r["k2"] + (1 << 63), r["size"]) for r in keys.collect()]
    bounds, n = sharding.splitters(keys, 8)
    assert n == len(rows)
    best, total = brute_boundaries(table, 8)
    for i, b in enumerate(bounds):
        below = sum(s for k1, k2, s in table if (k1 << 64 | k2) < b)
        off, biggest = abs(below - total * (i + 1) / 8), max(s for _, _, s in table)
        assert off <= max(0.005 * total / 8, best[i][1]) + biggest
    got = shards(sharding.shard(documents(spark, rows), 8))
    sums = [sum(r["size"] for r in part) for part in got.values()]
    assert len(got) == 8 and max(sums) - min(sums) <= 2 * (max(s for _, _, s in table) + 0.005 * total / 8)


def test_shards_of_awkward_few_and_no_rows(spark):
    rows = awkward()
    got = shards(sharding.shard(documents(spark, rows), 8))
    assert sum(map(len, got.values())) == len(rows)
    for part in got.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    same = [(1, "x", "en", "a", 1)] * 50 + [(None, None, None, None, None)] * 50
    got = shards(sharding.shard(documents(spark, same), 4))
    assert sum(map(len, got.values())) == 100
    assert sharding.shard(documents(spark, []), 8).count() == 0


def test_sharding_runs_no_python(spark):
    plan = sharding.shard(documents(spark, awkward()), 8)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
