"""Language, quality, licences and SentencePiece."""

import hashlib
import random
import re
import struct
from collections import Counter

import pytest
from llm_data import as_set, awkward, documents, prose

from docmart.llm import langid, licenses, quality, sentencepiece_codec
from docmart.llm.queries import tokenizer_path

SAMPLES = {"en": "the and of that with have this from they which one would there their", "de":
           "der die und nicht ein ist das mit sich auch werden für eine ß ü ä", "fr": "le la et les des une dans qui que pas pour sur é è ç"}


def speech(rng, lang, n=40):
    return " ".join(rng.choice(SAMPLES[lang].split()) for _ in range(n))


def spoken(n=300):
    rng = random.Random(8)
    return [(i, speech(rng, x), x, "a", 1) for i in range(n) for x in [rng.choice(list(SAMPLES))]]


def test_features_do_not_depend_on_slices(monkeypatch):
    text = speech(random.Random(1), "de", 300) + " 日本語😀 123 x"
    codes = langid.code_points(text)
    whole = Counter(langid.features(codes).tolist())
    monkeypatch.setattr(langid, "_SLICE", 7)
    parts = Counter()
    for i in range(0, len(codes), 7):
        parts.update(langid.features(codes[i:i + 7]).tolist())
        if i:
            parts.update(langid._across(codes, i).tolist())
    assert parts == whole


def brute_scores(rows, test):
    """Naive Bayes with plain loops over the same n-grams."""
    import math
    import zlib

    counts, n_docs = {}, Counter()
    for r in rows:
        key = "" if r[0] is None else str(r[0])
        if r[2] is None or zlib.crc32(key.encode()) % 5 == 0:
            continue
        n_docs[r[2]] += 1
        counts.setdefault(r[2], Counter()).update(langid.features(langid.code_points(r[1])).tolist())
    out = []
    for r in test:
        codes = langid.code_points(r[1])
        if not len(codes):
            out.append(("und", 0.0))
            continue
        s = {}
        for lang, c in counts.items():
            total = sum(c.values()) + 0.5 * (1 << langid.DIM_BITS)
            s[lang] = math.log(n_docs[lang] / sum(n_docs.values())) + sum(
                math.log((c[f] + 0.5) / total) for f in langid.features(codes).tolist())
        best = max(s, key=s.get)
        out.append((best, 1 / sum(math.exp(x - s[best]) for x in s.values())))
    return out


def test_language_matches_brute_force(spark):
    rows = spoken() + [(1000, "", "en", "a", 0), (1001, None, "de", "a", 0), (1002, "12 !", None, "a", 0),
                       (1003, "the der le", None, "a", 0), (1003, "a", "en", "a", 0), (None, "und", "de", "a", 0)]
    got = langid.label(documents(spark, rows)).collect()
    want = brute_scores(rows, rows)
    by = {(r["doc_id"], i): r for i, r in enumerate(got)}
    assert len(by) == len(rows)
    for r, (lang, score), g in zip(rows, want, got):
        assert g["doc_id"] == r[0] and g["lang_pred"] == lang and g["score"] == pytest.approx(score, abs=1e-3)


def test_language_held_out_accuracy(spark):
    rows = spoken(600)
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in langid.label(documents(spark, rows), per_lang=60).collect() if r["held_out"]]
    assert len(held) > 50 and sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) / len(held) > 0.97


def test_language_keeps_columns_and_drops_unknown(spark):
    docs = documents(spark, spoken(60) + [(900, "123", "en", "a", 1), (901, None, None, "a", 1)])
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns and kept.count() == 60


def test_language_without_labels_and_bounds(spark):
    rows = [(1, "the", None, "a", 1)]
    assert [tuple(r) for r in langid.label(documents(spark, rows)).collect()] == [(1, False, "und", 0.0)]
    assert langid.label(documents(spark, [])).count() == 0
    assert langid.label(documents(spark, awkward())).count() == len(awkward())
    with pytest.raises(ValueError):
        langid.train(documents(spark, spoken(50)), max_langs=2)


# quality ------------------------------------------------------------------------------------------

def brute_measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    n = Counter(windows)
    covered = set()
    for k, x in enumerate(windows):
        if n[x] > 1:
            covered.update(range(k, k + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    base_failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(covered), base_failed)


QUALITY = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def noisy():
    rng = random.Random(11)
    rows = []
    for i in range(200):
        good = prose(rng, 100, 5000) + "."
        kind = i % 10
        if kind == 0:
            text = " ".join(w + rng.choice(["***", "$$$", "%%%"]) for w in good.split())
        elif kind == 1:
            text = " ".join(w.upper() + "!!" for w in good.split())
        elif kind == 2:
            text = " ".join([prose(rng, 5)] * 20)
        else:
            text = good
        rows.append((i, text, "en", "a", 1))
    return rows


def test_quality_measures_match_brute_force(spark):
    rows = awkward() + [(1000 + r[0], *r[1:]) for r in noisy()] + [
        (2000, "a b c d e\na b c d e\n\n a\n", "en", "a", 1), (2001, "x " * 500, "en", "a", 1),
        (2002, "a b c d e f g a b c d e f q r s t u v", "en", "a", 1)]
    got = as_set(quality.judge(documents(spark, rows)), *QUALITY)
    assert got == sorted(((r[0], *brute_measures(r[1])) for r in rows), key=repr)


def test_quality_rejects_noise_and_keeps_prose(spark):
    got = {r["doc_id"]: r for r in quality.judge(documents(spark, noisy())).collect()}
    assert all(got[i]["kept"] == (i % 10 > 2) for i in got)
    assert all(0 <= r["quality"] <= 1 for r in got.values())


def test_estimate_matches_plain_em(spark):
    """The same expectation-maximisation in plain Python."""
    import math

    rng = random.Random(3)
    rules = quality.RULES[:3]
    rows = [tuple(rng.choice((-1, 0, 1, 1)) if rng.random() < 0.8 else -1 for _ in rules) for _ in range(200)]
    prior, right = 0.8, [(0.98, 0.3)] * 3
    for _ in range(5):
        goods = []
        for v in rows:
            odds = math.log(prior / (1 - prior))
            for x, (g, b) in zip(v, right):
                odds += math.log(g / (1 - b)) if x == 1 else math.log((1 - g) / b) if x == -1 else 0
            goods.append(1 / (1 + math.exp(-odds)))
        total = sum(goods)
        prior = (total + 1) / (len(rows) + 2)
        new = []
        for j in range(3):
            s = {(x, c): sum((g if c else 1 - g) for v, g in zip(rows, goods) if v[j] == x) for x in (1, -1) for c in (0, 1)}
            new.append(((s[1, 1] + 1) / (s[1, 1] + s[-1, 1] + 2), (s[-1, 0] + 1) / (s[-1, 0] + s[1, 0] + 2)))
        right = new
    votes = spark.createDataFrame(rows, ", ".join(f"{r.name} int" for r in rules))
    got = quality.estimate(votes, rules, rounds=5, tolerance=0)
    assert got.prior == pytest.approx(prior, abs=1e-6)
    assert [x for p in got.right for x in p] == pytest.approx([x for p in right for x in p], abs=1e-6)


def test_quality_empty_and_native(spark):
    assert quality.judge(documents(spark, [])).count() == 0
    plan = quality.judge(documents(spark, awkward()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# licences -----------------------------------------------------------------------------------------

def brute_canonical(text):
    text = (text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER))
    text = re.sub(licenses.HEAD_COPYRIGHT, r"\1", re.sub(licenses.COPYRIGHT_LINE, "", text))
    lines = []
    for line in re.sub(licenses.MARKS, " ", text).split("\n"):
        line = line.strip(" ")
        for old, new in licenses.SPELLINGS:
            line = re.sub(rf"(?<= )(?={re.escape(old)} ){re.escape(old)}", new, f" {line} ").strip(" ")
        lines.append(line)
    return lines


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_licenses_match_brute_force(spark):
    mit = next(t for s, t in licenses.KNOWN if s == "MIT")
    rows = awkward() + [
        (100, "MIT License\n\nCopyright (c) 2020 A. Person\n\n" + mit.upper().replace("SUBLICENSE", "SUBLICENCE"), "en", "a", 1),
        (101, "/* Copyright © 2019-2021 X */\n" + mit.replace(" ", "   ").replace('"', "“"), "en", "a", 1),
        (102, mit + " And more.", "en", "a", 1), (103, mit[:-20], "en", "a", 1),
        (104, "Some text.\nReleased under the MIT Licence!\nLICENSED UNDER CC BY-NC 4.0\nmore", "en", "a", 1),
        (105, "Released under the MIT License and others.", "en", "a", 1),
        (106, "https licence licence https", "en", "a", 1)]
    known = {digest(" ".join(" ".join(brute_canonical(t)).split(" ")).strip()) for _, t in licenses.KNOWN}
    table = {}
    for s, t in sorted(licenses.KNOWN, reverse=True):
        table[digest(re.sub(" +", " ", " ".join(brute_canonical(t))).strip(" "))] = s
    want = []
    for r in rows:
        lines = brute_canonical(r[1])
        whole = digest(re.sub(" +", " ", " ".join(lines)).strip(" "))
        notices = " ".join(table[digest(x)] for x in lines if digest(x) in table)
        want.append((r[0], whole, table.get(whole), notices))
    got = as_set(licenses.scan(documents(spark, rows)), "doc_id", "canonical_sha256", "license", "notices")
    assert got == sorted(want, key=repr) and known
    by = {x[0]: x for x in got}
    assert by[100][2] == by[101][2] == "MIT" and by[102][2] is None and by[103][2] is None
    assert by[104][3] == "MIT CC-BY-NC-4.0" and by[105][3] == ""


def test_licenses_as_they_lie_in_repositories(spark):
    text = {}
    for spdx, known in licenses.KNOWN:
        text.setdefault(spdx, known)
    mit, isc, bsd = text["MIT"], text["ISC"], text["BSD-3-Clause"]
    want = [
        ("MIT", "MIT License\n\nCopyright (c) Microsoft Corporation.\n\n" + mit),
        ("MIT", "The MIT License (MIT)\r\n\r\nCopyright (C) Jane Doe 2020\r\nAll rights reserved.\r\n\r\n" + mit.replace("\n", "\r\n")),
        ("MIT", "MIT License\nCopyright (c) <year> <copyright holders>\n" + mit),
        ("MIT", mit.replace("\n", " ").replace("OR COPYRIGHT HOLDERS BE", "OR\nCOPYRIGHT HOLDERS BE")),  # a line of the terms
        ("ISC", "The ISC License\n\n© Someone\n" + isc),
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, X\nAll rights reserved.\n\n" + bsd),
        ("MIT", "MIT License\nCopyright Jane Doe\n" + mit), ("ISC", "Copyright Jane Doe and others\n\nCopyright X\n" + isc),
        (None, "MIT License\n\nBe nice.\nCopyright holders keep all.\n" + mit)]
    for spdx, name in licenses.FILES:
        with open(f"/usr/share/common-licenses/{name}", encoding="utf-8") as f:
            want.append((spdx, f.read()))
    got = licenses.scan(documents(spark, [(i, t, "en", "a", 1) for i, (_, t) in enumerate(want)]))
    assert [x for _, x in as_set(got, "doc_id", "license")] == [
        x for _, x in sorted(((i, x) for i, (x, _) in enumerate(want)), key=repr)]


def test_whole_licences_among_rows(spark):
    """Known files rendered by row: another case, other spaces and a holder on every third."""
    texts = [(spdx, text) for spdx, text in licenses.KNOWN if len(text) > 300]
    rows, want = [], []
    for i in range(200):
        spdx, text = texts[i % len(texts)]
        if i % 3 == 1:
            text = "Copyright (c) 2001 Holder %d\n\n" % i + text.replace(" ", "  ")
        if i % 3 == 2:
            text = text + "\nEnd of copy %d." % i
        rows.append((i, text, "en", "a", 1))
        want.append((i, None if i % 3 == 2 else spdx))
    assert as_set(licenses.scan(documents(spark, rows)), "doc_id", "license") == sorted(want, key=repr)


def test_licenses_empty_and_native(spark):
    assert licenses.scan(documents(spark, [])).count() == 0
    plan = licenses.scan(documents(spark, awkward()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange hash.*text", plan)


# SentencePiece ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def model():
    import sentencepiece

    with open(tokenizer_path(), "rb") as f:
        raw = f.read()
    return sentencepiece_codec.Codec(raw), sentencepiece.SentencePieceProcessor(model_proto=raw)


def test_codec_matches_the_library(model):
    codec, library = model
    rng = random.Random(12)
    texts = ["", " ", "  a  b ", "\n", "\n\n a\n", "▁▁ x▁y", "<s> </s> <0x41>", "日本語😀", "\x00", "x" * 5000, " " * 300]
    texts += ["".join(rng.choice(" ▁\nabtheé日<0x41>\t.") for _ in range(rng.randrange(60))) for _ in range(2000)]
    texts += [r[1] for r in awkward() if r[1]]
    ids = codec.encode(texts)
    want = library.encode(texts, add_bos=True, add_eos=True)
    assert ids == [struct.pack(f"<{len(x)}I", *x) for x in want]
    assert [codec.decode(x) for x in ids] == [library.decode(x) for x in want]


def test_decode_of_any_ids(model):
    codec, library = model
    rng = random.Random(13)
    for _ in range(2000):
        ids = [rng.choice([1, 2, rng.randrange(3, 131), rng.randrange(259, 32000)]) for _ in range(rng.randrange(12))]
        assert codec.decode(struct.pack(f"<{len(ids)}I", *ids)) == library.decode(ids)


def test_codec_drops_old_chunks_without_changing_results(model, monkeypatch):
    codec, library = model
    monkeypatch.setattr(sentencepiece_codec, "_CACHE_SIZE", 10)
    rng = random.Random(14)
    for _ in range(5):
        text = prose(rng, 50)
        want = library.encode(text, add_bos=True, add_eos=True)
        assert codec.encode([text]) == [struct.pack(f"<{len(want)}I", *want)]


def test_check_finds_a_wrong_encoding(model):
    codec, _ = model
    with pytest.raises(RuntimeError):
        codec._check({"\u2581the": codec.byte[0]})
    for wrong in (["the"], [codec.begin + codec.end], ["The"]), (["the"], codec.encode(["the"]), ["The"]):
        with pytest.raises(RuntimeError):
            codec.check_whole(*wrong)


def test_digests_of_awkward_rows(spark, model):
    _, library = model
    want = []
    for r in awkward():
        ids = library.encode(r[1] or "", add_bos=True, add_eos=True)
        want.append((r[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     digest(library.decode(ids))))
    got = sentencepiece_codec.digest(documents(spark, awkward()), tokenizer_path())
    assert as_set(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert sentencepiece_codec.digest(documents(spark, []), tokenizer_path()).count() == 0
