"""Exact, near and substring deduplication against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import xxhash
from llm_data import as_set, awkward, documents, prose

from docmart.llm import components, exact_dedup, simhash, substring_dedup

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACES.split(text or "") if w]


# exact --------------------------------------------------------------------------------------------

def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[SPACES.sub(" ", r[1] or "")].append(r[0])
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        for k, i in enumerate(sorted(ids, key=lambda x: (x is None, x))):
            out.append((i, keep, len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


COLS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_labels_awkward_rows(spark):
    rows = awkward()
    for parts, bits in ((1, 4), (7, 1), (7, 2)):
        got = exact_dedup.label(documents(spark, rows).repartition(parts), bits)
        assert as_set(got, *COLS) == brute_exact(rows)


def test_exact_hot_group(spark):
    rng = random.Random(1)
    rows = [(i, "hot text" if i % 3 == 0 else prose(rng, 5, 30), "en", "a", 1) for i in range(3000)]
    assert as_set(exact_dedup.label(documents(spark, rows).repartition(9), 1), *COLS) == brute_exact(rows)


def test_exact_dedup_keeps_columns_and_one_row_a_group(spark):
    rows = awkward()
    docs = documents(spark, rows)
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns
    want = sorted((r[0] for r in brute_exact(rows) if r[3]), key=repr)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == want


def test_exact_empty(spark):
    docs = documents(spark, [])
    assert exact_dedup.label(docs).count() == 0 and exact_dedup.dedup(docs).count() == 0


def test_exact_plan_runs_no_python(spark):
    plan = exact_dedup.label(documents(spark, awkward()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# SimHash ------------------------------------------------------------------------------------------

def brute_fingerprint(text):
    w = [x.encode().lower() for x in words(text)]  # bytes.lower() acts on A-Z
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius=4):
    """Fingerprints, and for each row the first row that it reaches."""
    fps = np.array([brute_fingerprint(r[1]) for r in rows], dtype=np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    label = np.arange(len(rows))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(rows))])
        if (new == label).all():
            return fps, label.tolist()
        label = new


def smallest(rows, label):
    """The smallest id of each component, None without one."""
    ids = defaultdict(list)
    for k, r in zip(label, rows):
        ids[k] += [] if r[0] is None else [r[0]]
    return {k: min(x) if x else None for k, x in ids.items()}


def brute_simhash(rows, radius=4):
    fps, label = brute_components(rows, radius)
    ids = smallest(rows, label)
    return sorted(((r[0], f"{fps[k]:016x}", ids[label[k]]) for k, r in enumerate(rows)), key=repr)


def near_copies(n, seed):
    rng = random.Random(seed)
    base = [prose(rng, 200).split() for _ in range(4)]
    rows = []
    for i in range(n):
        w = list(base[i % 4]) if i % 3 else prose(rng, 100).split()
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(99)}"
        rows.append((i, " ".join(w), "en", "a", 1))
    return rows


def test_simhash_matches_brute_force(spark):
    for rows in (awkward(), near_copies(150, 3)):
        got = simhash.label(documents(spark, rows))
        assert as_set(got, "doc_id", "fingerprint", "component_id") == brute_simhash(rows)


def test_simhash_small_tiles_and_parts_change_nothing(spark):
    rows = near_copies(150, 4)
    want = brute_simhash(rows)
    for tile, parts in ((7, 1), (16, 2), (16, 4)):
        got = simhash.label(documents(spark, rows), tile=tile, parts=parts)
        assert as_set(got, "doc_id", "fingerprint", "component_id") == want


def test_simhash_chain_is_one_component(spark):
    """Fingerprints 4 bits apart in a long chain, far beyond one tile."""
    fps = [(1 << (4 * i)) - 1 for i in range(16)]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, tile=2, parts=1)
    got = components.components(links).collect()
    assert len(got) == 16 and len({r["component"] for r in got}) == 1


def test_simhash_forest_of_a_clique_is_small():
    child, root = simhash.forest(np.zeros(5000, dtype=np.uint64), None, 4)
    assert len(child) == 4999 and set(root) == {0}


def test_simhash_dedup_keeps_one_of_each_component(spark):
    rows = awkward() + [(100 + r[0], *r[1:]) for r in near_copies(60, 5)]
    docs = documents(spark, rows)
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, smallest(rows, brute_components(rows)[1]).values()))


def test_simhash_empty(spark):
    docs = documents(spark, [])
    assert simhash.label(docs).count() == 0 and simhash.dedup(docs).count() == 0


def test_components_against_union_find(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    got = components.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for x in linked}


# substrings ---------------------------------------------------------------------------------------

def brute_substrings(rows, window=50):
    order = lambda i: float("inf") if i is None else i
    first = {}
    for r in rows:
        w = words(r[1])
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, float("inf")), order(r[0]))
    out = []
    for r in rows:
        w = words(r[1])
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < order(r[0]):
                gone[k:k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        spans = re.finditer("1+", "".join("01"[g] for g in gone))
        out.append((r[0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), [m.span() for m in spans]))
    return sorted(out, key=repr)


def cut(df):
    out = []
    for r in df.select("doc_id", "cut.*").collect():
        out.append((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest(),
                    [(x["start"], x["stop"]) for x in r["removed"]]))
    return sorted(out, key=repr)


def passages(seed, n=120):
    """Documents that share passages at any offset, overlap them, repeat them and edit them."""
    rng = random.Random(seed)
    shared = [prose(rng, k).split() for k in (49, 50, 51, 70, 200)] + [["a"] * 80, ["a", "b"] * 40]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randrange(1, 4)):
            w += prose(rng, rng.randrange(60)).split()
            p = list(rng.choice(shared))
            if rng.random() < 0.3:
                p[rng.randrange(len(p))] = "edit"
            if rng.random() < 0.3:
                p = p[rng.randrange(20):]
            w += p
        rows.append((rng.randrange(n) if i % 10 == 0 else i, " ".join(w), "en", "a", 1))
    return rows


def test_substrings_match_brute_force(spark):
    for rows in (awkward(), passages(1), passages(2)):
        docs = documents(spark, rows).repartition(5)
        assert cut(substring_dedup.dedup(docs)) == brute_substrings(rows)


def test_substrings_other_sizes(spark):
    rows = passages(3, 60)
    for window, inner in ((20, 5), (12, 12), (5, 1)):
        got = substring_dedup.dedup(documents(spark, rows), window=window, inner=inner)
        assert cut(got) == brute_substrings(rows, window)


def test_substrings_hot_passage(spark):
    rng = random.Random(9)
    hot = prose(rng, 60)
    rows = [(i, prose(rng, 20) + " " + hot + " " + prose(rng, 20) if i % 3 == 0 else prose(rng, 70), "en", "a", 1)
            for i in range(400)]
    assert cut(substring_dedup.dedup(documents(spark, rows).repartition(6))) == brute_substrings(rows)


def test_substrings_empty(spark):
    assert substring_dedup.dedup(documents(spark, [])).count() == 0
