"""Periodic runs against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from llm_data import as_set, awkward, documents, prose

from docmart.llm import periodic as R

COLS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def brute_runs(w, least=6, repeats=4):
    n, out = len(w), set()
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            e = i + q
            smaller = any(all(w[k] == w[k + d] for k in range(s, e - d)) for d in range(1, q))
            if e - s >= max(least, repeats * q) and not smaller:
                out.add((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plant(doc_id, text):
    ws = (text or "").encode().split()
    n, h = len(ws), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    return ws


def brute(rows):
    out = []
    for r in rows:
        ws = plant(r[0], r[1])
        runs = brute_runs(ws)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else (None,) * 3
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        text = b" ".join(w for i, w in enumerate(ws) if i not in dropped)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        out.append((r[0], len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                    hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text).hexdigest()))
    return sorted(out, key=repr)


def made(rng, n, letters):
    w = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n > 10:
            a, p = rng.randrange(n), 1 + rng.randrange(12)
            for i in range(a + p, min(n, a + p * rng.randrange(1, 9) + rng.randrange(p))):
                w[i] = w[i - p]
    return w


@pytest.mark.parametrize("block", [1 << 17, 40])
def test_runs_match_brute_force(monkeypatch, block):
    monkeypatch.setattr(R, "_BLOCK", block)
    rng = random.Random(41)
    for _ in range(150):
        texts = [made(rng, rng.randrange(120), rng.choice([1, 2, 3, 5, 50])) for _ in range(rng.randrange(1, 8))]
        assert R.find([np.array(t, dtype=np.int64) for t in texts]) == [brute_runs(t) for t in texts]


def test_grammar_extensions_match_plain_comparison():
    rng = random.Random(42)
    for _ in range(60):
        texts = [made(rng, rng.randrange(1, 90), rng.choice([1, 2, 4])) for _ in range(3)]
        seq, _ = R._joined([np.array(t, dtype=np.int64) for t in texts])
        grammar = R.Grammar(seq)
        assert sum(len(x) for x in grammar.levels[-1][:1]) <= 7  # one symbol a text between separators
        s = seq.tolist()
        for _ in range(60):
            x, y = sorted(rng.sample(range(1, len(s) - 1), 2)) if len(s) > 3 else (1, 1)
            if x == y:
                continue
            k = 0
            while y + k < len(s) and s[x + k] == s[y + k]:
                k += 1
            assert grammar.forward(x, y) == k
            k = 0
            while x - k > 0 and s[x - 1 - k] == s[y - 1 - k]:
                k += 1
            assert grammar.backward(x, y) == k


def test_profile_matches_brute_force(spark):
    rng = random.Random(43)
    rows = [r for r in awkward() if len(r[1] or "") < 100_000]
    rows += [(100 + i, prose(rng, rng.randrange(1, 150), rng.choice([2, 5, 400])), "en", "a", 1) for i in range(150)]
    rows += [(900, "a b " * 40 + "c " + "x y z " * 20, "en", "a", 1), (901, "é日 \x0b" * 30, "en", "a", 1), (902, "q " * 500, "en", "a", 1)]
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows)
    got = R.profile(R.planted(documents(spark, rows).repartition(3)))
    assert as_set(got, *COLS) == brute(rows)
    assert R.profile(R.planted(documents(spark, []))).count() == 0


def test_runs_keep_columns_and_their_order(spark):
    rows = documents(spark, [(1, "a b a b a b a b c", "en", "a", 1), (2, None, None, None, None)])
    got = {r["doc_id"]: r for r in R.with_runs(rows).collect()}
    p = got[1]["periodic"]
    assert [tuple(x) for x in p["runs"]] == [(0, 8, 2)] and tuple(p["best"]) == (0, 8, 2) and p["collapsed"] == "a b c"
    assert got[1]["digest"] == "extra" and got[2]["periodic"]["n_words"] == 0 and got[2]["periodic"]["best"] is None


def test_very_long_texts():
    words = np.arange(300_000)
    words[1000:200_000] = np.resize(np.arange(777), 199_000)
    # Word 777 and 999 continue nothing: the run is exactly as planted.
    assert R.find([words, np.zeros(50_000, np.int64)]) == [[(1000, 199_000, 777)], [(0, 50_000, 1)]]
    with pytest.raises(ValueError):
        R.find([words], repeats=3)
