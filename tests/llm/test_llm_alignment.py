"""Cross-tokenizer alignment against both libraries and dense matrices."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_data import as_set, awkward, documents, prose

from docmart.llm import alignment as A
from docmart.llm.queries import tokenizer_path

A_PATH, B_PATH = tokenizer_path("byte_bpe_50k.json"), tokenizer_path()
COLS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


@pytest.fixture(scope="module")
def pair():
    with open(A_PATH, "rb") as f, open(B_PATH, "rb") as g:
        return A.Pair(f.read(), g.read())


def spans(libraries, text):
    """(id, start, end) in bytes of each token of both sides, by the libraries alone."""
    if not text:
        return [], []
    a_lib, b_lib = libraries
    raw, out = b" " + text.encode(), []
    byte_of = {c: i for i, c in enumerate(A.byte_alphabet())}
    a = [(i, bytes(byte_of[c] for c in a_lib.id_to_token(i))) for i in a_lib.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in b_lib.encode(text):
        piece = b_lib.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if b_lib.is_byte(i) else piece.replace("▁", " ").encode()))
    for side in (a, b):
        if b"".join(x for _, x in side) != raw:
            return [], []
        at, rows = 0, []
        for i, x in side:
            rows.append((i, at, at + len(x)))
            at += len(x)
        out.append(rows)
    return out


def brute(libraries, rows):
    docs, counts = [], Counter()
    for r in rows:
        a, b = spans(libraries, r[1])
        links = [(x, y) for x, _, e in a for y, _, f in b if e == f] if len(a) < 500 else None
        if links is None:  # only the pairs that end at one byte
            at = {f: y for y, _, f in b}
            links = [(x, at[e]) for x, _, e in a if e in at]
        counts.update(links)
        docs.append((r[0], a, b, links))
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    out = []
    for i, a, b, links in docs:
        groups = []
        for cut in sorted({e for _, _, e in a} & {e for _, _, e in b}):
            low = groups[-1][0] if groups else 0
            inside = lambda side: ",".join(str(x) for x, _, e in side if low < e <= cut)  # noqa: B023, E731
            groups.append((cut, inside(a) + "|" + inside(b))) if len(a) < 500 else groups.append((cut, None))
        if len(a) >= 500:
            text = _long_groups(a, b, {c for c, _ in groups})
        else:
            text = ";".join(g for _, g in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(counts[x] == top[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return sorted(out, key=repr)


def _long_groups(a, b, cuts):
    sides = []
    for side in (a, b):
        parts, run = [], []
        for x, _, e in side:
            run.append(str(x))
            if e in cuts:
                parts.append(",".join(run))
                run = []
        sides.append(parts)
    return ";".join("|".join(x) for x in zip(*sides))


def strange(n=60):
    rng = random.Random(31)
    odd = " \n\tabtheing é日本▁😀<s>\x00  'll12 34.,!?"
    rows = [(1000 + i, "".join(rng.choice(odd) for _ in range(rng.randrange(80))), "en", "a", 1) for i in range(n)]
    return rows + [(2000, "<|endoftext|> and <s> </s> <0x41> are text", "en", "a", 1), (2001, "don't we'll THEY'VE  two   three", "en", "a", 1),
                   (2002, "x" * 3000, "en", "a", 1), (2003, "naïve café " * 50, "en", "a", 1)]


def test_products_match_dense_matrices():
    rng = np.random.default_rng(3)
    for _ in range(50):
        m, k, n = rng.integers(1, 12, 3)
        a, b = rng.integers(0, 2, (m, k)), rng.integers(0, 2, (k, n))
        sparse = [(np.concatenate([[0], np.cumsum(x.sum(1))]), np.nonzero(x)[1], x.shape[1]) for x in (a, b)]
        row, col, value = A.product(*sparse)
        dense = np.zeros((m, n), int)
        dense[row, col] = value
        assert (dense == a @ b).all() and (value > 0).all()
        back = A.transpose(sparse[0])
        assert (back[0] == np.concatenate([[0], np.cumsum(a.sum(0))])).all() and (back[1] == np.nonzero(a.T)[1]).all()


@pytest.mark.parametrize("block", [1 << 19, 7])
def test_links_of_every_kind_match_brute_force(libraries, pair, monkeypatch, block):
    monkeypatch.setattr(A, "_BLOCK", block)
    rng = random.Random(32)
    texts = [r[1] for r in strange(30)[:30]] + [prose(rng, 20), None, "", "the cat's whiskers"]
    whole = A.Aligned(pair, pair.encode(texts))
    a_at, b_at, want = 0, 0, {k: Counter() for k in A.KINDS}
    for text in texts:
        a, b = spans(libraries, text)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        group = lambda e: sum(c < e for c in cuts)  # noqa: B023, E731
        for i, (_, s, e) in enumerate(a):
            for j, (_, t, f) in enumerate(b):
                shared = min(e, f) - max(s, t)
                if shared > 0:
                    want["overlap"][a_at + i, b_at + j] = shared
                    if e == f:
                        want["end"][a_at + i, b_at + j] = shared
                if group(e) == group(f):
                    want["group"][a_at + i, b_at + j] = 1
        a_at, b_at = a_at + len(a), b_at + len(b)
    for kind in A.KINDS:
        got = {(int(x), int(y)): int(w) for x, y, w in zip(*whole.links(kind))}
        assert got == want[kind], kind
    assert len(want["overlap"]) > len(want["end"]) > 0


def test_profile_matches_brute_force(spark, libraries):
    rows = awkward() + strange()
    got = A.profile(documents(spark, rows).repartition(3), A_PATH, B_PATH)
    assert as_set(got, *COLS) == brute(libraries, rows)
    assert A.profile(documents(spark, []), A_PATH, B_PATH).count() == 0


def test_aligned_column_keeps_rows_and_names(spark, libraries):
    rows = strange(5) + awkward()[:8]
    got = A.align(documents(spark, rows), A_PATH, B_PATH, "group").collect()
    for r, row in zip(sorted(got, key=lambda r: repr((r["doc_id"], r["text"]))), sorted(rows, key=lambda r: repr((r[0], r[1])))):
        a, b = spans(libraries, row[1])
        assert r["aligned"]["a_ids"] == [x for x, _, _ in a] and r["aligned"]["b_ids"] == [x for x, _, _ in b]
        assert r["digest"] == "extra"
        both = set(zip(r["aligned"]["a_at"], r["aligned"]["b_at"]))
        assert both == {(i, j) for i, g in enumerate(r["aligned"]["a_group"]) for j, h in enumerate(r["aligned"]["b_group"]) if g == h}


def test_fast_encoder_matches_the_library(libraries, pair):
    """Every assigned and unassigned code point between letters, digits, spaces and itself."""
    library = libraries[0]
    step = 7  # every seventh code point beyond the first plane's start; the others were compared once by hand
    points = [c for c in (*range(0x3000), *range(0x3000, 0x110000, step)) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 4000):
        text = "".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}2\n{chr(c)} " for c in points[i:i + 4000])
        assert pair.encode_a(text) == library.encode(text, add_special_tokens=False).ids


def test_other_vocabularies_fall_back_to_the_library(libraries):
    import json

    with open(A_PATH, "rb") as f:
        spec = json.load(f)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    other = A.Pair(json.dumps(spec).encode(), open(B_PATH, "rb").read())
    assert "Encoding" not in repr(other.encode_a) and other.encode_a(" the") == libraries[0].encode(" the").ids


def test_id_pairs_are_bounded_by_the_vocabularies(pair):
    assert A.suffix_pairs(pair) < 1_000_000
