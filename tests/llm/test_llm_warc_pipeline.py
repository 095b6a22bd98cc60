"""WARC archives, the registered queries against SQL, and the pipeline."""

import base64
import hashlib
import os
import random
import re
import struct
from collections import Counter

import pytest
from llm_data import as_set, awkward, documents, prose
from oracle_harness import compare, duck

import __spark_entry__ as contract
import corpus_pipeline
from docmart.llm import langid, mixing, warc
from docmart.llm.oracles import ORACLES
from docmart.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, file string, run string, offset string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], PAGES)


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute_warc(rows, least=0):
    top = {}
    for i, _, html in rows:
        if i is not None:
            top[html or ""] = max(i, top.get(html or "", i))
    out = []
    for i, _, html in rows:
        big = top.get(html or "")
        response = big is None or i == big or len((html or "").encode()) < least
        out.append((i, len((html or "").encode()), b32(html), "response" if response else "revisit", None if response else big))
    return sorted(out, key=repr)


COLS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def fake_record(body):
    """A complete record as it might be quoted inside a page."""
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    return (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:666>\r\n"
            f"Content-Length: {len((http + body).encode())}\r\n\r\n{http}{body}\r\n\r\n")


def nasty(n=200):
    rng = random.Random(20)
    rows = []
    for i in range(n):
        kind = i % 8
        html = f"<p>{prose(rng, rng.randrange(200))}</p>"
        if kind == 1:
            html += fake_record("quoted") + "tail"
        elif kind == 2:
            html = fake_record("a") + fake_record("b") + fake_record("é" * 50)
        elif kind == 3:
            html = "WARC/1.0\r\n" * 3 + html + "WARC/1.0\r\nContent-Length: 99999999\r\n\r\n"
        elif kind == 4:
            html = "\r\n\r\n" + html + "\r\n\r\nWARC/1.0"
        elif kind == 5:
            html = "copied page"
        rows.append((i, f"http://x/{i}\r\nEvil: 1" if kind == 6 else None if kind == 7 else f"http://x/{i}", html))
    return rows


def test_round_trip_with_magic_in_payloads(spark):
    rows = nasty()
    got = warc.round_trip(pages(spark, rows).repartition(3))
    assert as_set(got, *COLS) == brute_warc(rows)
    assert all(r["intact"] for r in got.collect())


def test_round_trip_over_many_splits(spark):
    """Splits fall anywhere: inside headers, payloads and the magic itself."""
    rows = nasty(60)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for size in ("997", "4099"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            got = warc.round_trip(pages(spark, rows).coalesce(1))
            assert as_set(got, *COLS) == brute_warc(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_archives_are_plain_warc(spark, tmp_path):
    rows = nasty(40)
    warc.write(pages(spark, rows).coalesce(1), str(tmp_path / "w"))
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    at, ids = 0, []
    while at < len(raw):  # read front to back, record by record
        end = raw.index(b"\r\n\r\n", at)
        head = raw[at:end].decode()
        assert head.startswith("WARC/1.0\r\n") and "\r\nEvil" not in head
        ids.append(int(re.search(r"WARC-Record-ID: <urn:x-page:(\d+)>", head)[1]))
        at = end + 4 + int(re.search(r"\r\nContent-Length: (\d+)$", head)[1])
        assert raw[at:at + 4] == b"\r\n\r\n"
        at += 4
    assert sorted(ids) == [r[0] for r in rows]


def test_foreign_archive_with_preface_free_start_and_cut_end(spark, tmp_path):
    whole = "".join(fake_record(f"body {i}").replace("666", str(i)) for i in range(30))
    (tmp_path / "a.warc").write_bytes(whole.encode())
    (tmp_path / "b.warc").write_bytes(whole.encode()[:-10])  # the last record is cut off
    (tmp_path / "c.warc").write_bytes(b"")
    got = Counter(r["record_id"] for r in warc.read(spark, str(tmp_path)).collect())
    assert got == Counter({f"<urn:x-page:{i}>": 2 if i < 29 else 1 for i in range(30)})


def test_scans_that_are_split_differently(spark, monkeypatch):
    """As when executors come or go: the second scan has other splits than the first."""
    rows = nasty(60)
    names = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    old = [spark.conf.get(x) for x in names]
    segments, sizes = warc._segments, iter(("4099", "997", "997"))

    def split(spark, path):
        spark.conf.set(names[0], next(sizes))
        return segments(spark, path)

    try:
        spark.conf.set(names[1], "1")
        monkeypatch.setattr(warc, "_segments", split)
        got = warc.round_trip(pages(spark, rows).coalesce(1))
        assert as_set(got, *COLS) == brute_warc(rows)
    finally:
        for name, value in zip(names, old):
            spark.conf.set(name, value)


def test_round_trip_of_very_long_urls(spark):
    """A head of several hundred KB, and the pages behind it in the same file."""
    rows = [(i, f"http://x/{i}?" + "q" * (300_000 if i % 3 == 1 else 65_400 if i % 3 == 2 else 5), f"page {i // 2}")
            for i in range(9)]
    rows += [(9, "http://x/" + "é" * 200_000, "a" + fake_record("quoted") + "b"), (10, "http://x/10", "last")]
    got = warc.round_trip(pages(spark, rows).coalesce(1))
    assert as_set(got, *COLS) == brute_warc(rows)
    assert all(r["intact"] for r in got.collect())


def test_urls_that_hold_other_line_separators(spark):
    """Only a line feed ends a header, whatever else Java or Unicode takes for the end of a line."""
    rows, forged = [], ("Content-Length: 1", "WARC-Payload-Digest: sha1:X", "WARC-Type: revisit", "WARC-Refers-To: <urn:x-page:7>")
    for i, mark in enumerate("\u0085\u2028\u2029\x0b\x0c\x1c\r\n"):
        rows += [(10 * i + k, f"http://x/{mark}{text}{mark}", f"page {i} {k // 2}") for k, text in enumerate(forged)]
    got = warc.round_trip(pages(spark, rows).coalesce(2))
    assert as_set(got, *COLS) == brute_warc(rows)
    assert all(r["intact"] for r in got.collect())


def test_archives_that_end_early_and_lost_records_are_told(spark, tmp_path, monkeypatch):
    whole = "".join(fake_record(f"body {i}") for i in range(5)).encode()
    for name, raw in (("a", whole), ("b", whole[:-10]), ("c", b"junk" + whole)):
        (tmp_path / f"{name}.warc").write_bytes(raw)
    size = len(fake_record("body 0").encode())
    got = {r["file"][-6:]: (r["end"], r["file_size"]) for r in warc.ends(warc._real(spark, str(tmp_path))).collect()}
    assert got == {"a.warc": (5 * size, 5 * size), "b.warc": (4 * size, 5 * size - 10), "c.warc": (0, 5 * size + 4)}
    with pytest.raises(ValueError, match="records end"):
        warc.read(spark, str(tmp_path), strict=True)
    read = warc.read
    monkeypatch.setattr(warc, "read", lambda *a, **b: read(*a, **b).filter("record_id <> '<urn:x-page:3>'"))
    with pytest.raises(RuntimeError, match="read back"):
        warc.round_trip(pages(spark, nasty(8)))


def test_revisits_are_held_against_the_response_they_name(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "shared_dir", lambda *_: str(tmp_path / "w"))
    write = warc.write

    def tampered(pages, path, least):
        write(pages, path, least)
        for p in (tmp_path / "w").glob("part-*"):  # the response's payload changes, its length stays
            p.write_bytes(p.read_bytes().replace(b"copied page", b"COPIED page"))
        for p in (tmp_path / "w").glob(".*.crc"):
            p.unlink()

    monkeypatch.setattr(warc, "write", tampered)
    got = warc.round_trip(pages(spark, [(1, "u", "copied page"), (2, "u", "copied page"), (3, "u", "other")]))
    assert {r["page_id"]: r["intact"] for r in got.collect()} == {1: False, 2: False, 3: True}


def test_round_trip_awkward_rows_and_limits(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "x"), (4, None, "x"), (4, None, "x"), (None, None, "x"), (None, "u", "alone"),
            (5, "u", "é😀" * 100_000), (-6, "", "y\x00z")]
    assert as_set(warc.round_trip(pages(spark, rows)), *COLS) == brute_warc(rows)
    assert as_set(warc.round_trip(pages(spark, rows), least=2), *COLS) == brute_warc(rows, 2)
    assert warc.round_trip(pages(spark, [])).count() == 0


# queries and pipeline -----------------------------------------------------------------------------

@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    _, problems = compare(spark, duck(SF), name, contract.queries()[name], ORACLES[name], SF)
    assert not problems, problems


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_every_row_of_its_table(spark, name):
    """One row per row of the table, each id once; the values are tested against brute force beside the operators."""
    table, key = {"op5": ("pages", "page_id"), "op13": ("embeddings", "vec_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    ids = spark.read.parquet(f"{SF}/{table}.parquet").select(key)
    assert sorted(r[key] for r in contract.queries()[name](spark, SF).collect()) == sorted(r[key] for r in ids.collect())


def test_every_operator_is_registered():
    names = contract.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) <= set(names) and "pipeline" in names


def brute_stages(rows):
    """The pipeline's filters by brute force; the mix and the classifier by their own operators."""
    from test_llm_dedup import SPACES, brute_components, smallest

    seen = {}
    for r in sorted(rows, key=lambda r: r[0]):
        seen.setdefault(SPACES.sub(" ", r[1]), r)
    unique = list(seen.values())
    keep = set(smallest(unique, brute_components(unique)[1]).values())
    return [r for r in unique if r[0] in keep]


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_pipeline_matches_brute_force(spark):
    import sentencepiece

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    model = langid.train(docs)
    rows = [tuple(r) for r in docs.collect()]
    known = [r for r, (lang, score) in zip(rows, model.score([r[1] for r in rows])) if lang != "und" and score >= 0.5]
    unique = brute_stages(known)
    taken = mixing.Mix(spark.createDataFrame(unique, docs.schema)).documents().collect()
    text = {r[0]: r[1] for r in unique}
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    want = Counter()
    for r in taken:
        ids = library.encode(text[r["doc_id"]], add_bos=True, add_eos=True)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if r["copies"]:
            want[r["doc_id"], packed, len(ids), hashlib.sha256(packed).hexdigest(),
                 hashlib.sha256(library.decode(ids).encode()).hexdigest()] = r["copies"]
    got = Counter((r["doc_id"], bytes(r["ids"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
                  for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want and len(want) > 100
    assert columns == docs.columns


def test_stages_keep_columns_and_take_awkward_and_no_rows(spark):
    for rows in (awkward(), []):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= 3 * max(1, len(rows))
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == len(rows)


def test_stages_name_the_dealt_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "mixing", "sentencepiece"]
