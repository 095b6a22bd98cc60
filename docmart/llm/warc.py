"""WARC archives: writing with revisit records, and splittable reading by boundary chains.

Writing. One record per page, payload the page in UTF-8 behind an HTTP head. Of pages with equal
payloads the largest page_id is a response, the others are revisits of it. Groups are found on
digests; only revisit rows join back to the pages. Spark's text writer puts the records one behind
the other, so each task writes one plain archive.

Reading. Archives are read by Spark's text source with the record magic as line separator, so large
files are split and streamed. Each stretch between two magics is a candidate record; its
header names the offset of its successor. Magic inside a payload gives false candidates, so a
candidate counts only if the chain of successors from the start of its file reaches it:

1. offsets are running sums, first within each split, then over the splits of a file;
2. within a split, candidates that follow each other exactly form runs (one window);
3. pointer jumping over the runs' entries, from offset 0 of every file: the reached set grows by the
   jump table, the jump table is squared, in about log2(splits of a file) rounds of narrow joins;
4. a candidate is a record if an entry at or before it in its run is reached.

Payload bytes stay in the scan: digests are made there for records that lie between two magics.
Only the parts of records that hold a magic are read again and put together. A part is named by
its own digest, so the second scan may be split in any way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docmart.llm.common import materialize
from docmart.session import shared_dir

MAGIC = "WARC/1.0\r\n"
URN = "urn:x-page:"
HEX_DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: 160 bits are four times 40 bits, eight characters each."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), HEX_DIGITS, BASE32)


def _revisits(rows: DataFrame, least: int) -> DataFrame:
    """(page_id, sha, refers_to) of the rows that repeat the payload of a larger page_id."""
    groups = materialize(rows.filter(F.col("n_bytes") >= least).groupBy("sha")
                         .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
                         .filter("n > 1 and refers_to is not null").drop("n"), "warc_groups")
    return materialize(rows.join(groups, "sha").filter("page_id is null or page_id < refers_to")
                       .select("page_id", "sha", "refers_to").distinct(), "warc_revisits")


def write(pages: DataFrame, path: str, least: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write (page_id, url, html) as archives under ``path``.

    Payloads of fewer than ``least`` bytes are always responses. A NULL html is an empty payload; a
    NULL url writes no target. Rows that repeat the largest page_id of a group are all responses;
    rows without an id revisit any that has one, and are responses among themselves.
    """
    sha = F.unhex(F.sha2(F.coalesce("html", F.lit("")), 256)).alias("sha")
    rows = materialize(pages.select("page_id", sha, F.octet_length(F.coalesce("html", F.lit(""))).alias("n_bytes")),
                       "warc_digests")
    revisits = _revisits(rows, least).select(F.col("page_id").alias("r_page"), F.col("sha").alias("r_sha"), "refers_to")
    page = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"), sha)
    page = page.join(revisits, (F.col("sha") == F.col("r_sha")) & F.col("page_id").eqNullSafe(F.col("r_page")), "left")
    repeat = F.col("refers_to").isNotNull()
    name = F.concat(F.lit(f"<{URN}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("payload").cast("string"), F.lit("\r\n\r\n"))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(repeat, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name, F.lit(f"\r\nWARC-Date: {date}\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]+", "%0D%0A"), F.lit("\r\n")), F.lit("")),
        F.lit("WARC-Payload-Digest: sha1:"), sha1_base32(F.col("payload")), F.lit("\r\n"),
        F.when(repeat, F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            F.lit(f"<{URN}"), F.col("refers_to").cast("string"), F.lit(">\r\n"))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "))
    block = F.concat("http", F.when(repeat, F.lit("")).otherwise(F.col("payload")))
    # The writer ends each row with the last line feed of the record.
    (page.select(head.alias("head"), http.alias("http"), "payload", "refers_to")
     .select("head", block.alias("block"))
     .select(F.concat("head", F.octet_length("block").cast("string"), F.lit("\r\n\r\n"), "block", F.lit("\r\n\r")).alias("value"))
     .write.mode("overwrite").option("lineSep", "\n").text(path))


def _field(name: str) -> Column:
    """A header's value. (?d): only a line feed ends a line, not U+0085 or U+2028 inside a value."""
    return F.nullif(F.trim(F.regexp_extract("head", rf"(?dim)^{name}:[ \t]*([^\r\n]*)", 1)), F.lit(""))


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """Everything between two magics, in file order by (block, seq)."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("_metadata.file_size").alias("file_size"), F.monotonically_increasing_id().alias("seq"),
                    F.col("value").cast("binary").alias("bytes")))


def _parsed(df: DataFrame) -> DataFrame:
    """Adds what the header of ``bytes`` says, and the payload if the record ends with ``bytes``."""
    df = df.withColumn("head", F.substring_index(F.col("bytes").cast("string"), "\r\n\r\n", 1))
    df = df.withColumn("head_size", F.octet_length("head")).withColumn("size", F.octet_length("bytes"))
    # However long: a false header does no harm, as only the chain of successors makes records.
    df = df.withColumn("head", F.when(F.col("head_size") < F.col("size"), F.col("head")))
    df = df.withColumn("content", _field("Content-Length").try_cast("long"))
    df = df.withColumn("whole", F.coalesce(F.col("head_size") + 8 + F.col("content") == F.col("size"), F.lit(False)))
    df = df.withColumn("payload", F.when(F.col("whole"), F.expr("substring(bytes, head_size + 5, int(content))")))
    df = df.withColumn("http", F.substring_index(F.col("payload").cast("string"), "\r\n\r\n", 1))
    return df.withColumn("payload", F.expr("substring(payload, octet_length(http) + 5)"))


def _facts() -> list[Column]:
    return [
        _field("WARC-Type").alias("record_type"), _field("WARC-Record-ID").alias("record_id"),
        _field("WARC-Refers-To").alias("refers_to_id"), _field("WARC-Target-URI").alias("target_uri"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("stated_digest"),
        F.regexp_extract("http", r"(?dim)^Content-Length:[ \t]*([0-9]+)", 1).try_cast("long").alias("stated_bytes"),
        F.octet_length("payload").cast("long").alias("n_bytes"), sha1_base32(F.col("payload")).alias("digest")]


def _sha(name: str) -> Column:
    return F.unhex(F.sha2(name, 256)).alias("sha")


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One narrow row per candidate: file, block, seq, offset, successor, run, and its facts."""
    found = materialize(
        _parsed(_segments(spark, path))
        .select("file", "block", "file_size", "seq", "size", "whole", _sha("bytes"),
                (F.col("head_size") + F.col("content") + 8 + len(MAGIC)).alias("span"), *_facts()), "warc_segments")
    step = F.col("size") + len(MAGIC)
    totals = found.groupBy("file", "block").agg(F.sum(step).alias("bytes"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    base = totals.select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("file", "block").orderBy("seq")
    placed = found.join(base, ["file", "block"]).withColumn(
        "offset", F.col("base") + F.coalesce(F.sum(step).over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        - len(MAGIC)).drop("base")
    # What lies before the first magic of a file is no candidate.
    placed = placed.filter("offset >= 0").withColumn("successor", F.col("offset") + F.col("span")).drop("span")
    starts = F.coalesce(F.lag("successor").over(inside) != F.col("offset"), F.lit(True)).cast("long")
    return materialize(placed.withColumn("starts", starts).withColumn("run", F.sum("starts").over(inside)).drop("starts"),
                       "warc_candidates")


def reached(found: DataFrame) -> DataFrame:
    """(file, block, run, entry): the runs that the chain from the file's start enters, and where first."""
    place = found.select("file", "offset", "block", "run")
    exits = found.groupBy("file", "block", "run").agg(F.max_by("successor", "offset").alias("exit"))
    starts = found.select("file").distinct().withColumn("offset", F.lit(0).cast("long"))
    nodes = (exits.select("file", F.col("exit").alias("offset")).union(starts).distinct()
             .join(place, ["file", "offset"]))
    jumps = materialize(nodes.join(exits, ["file", "block", "run"])
                        .select("file", F.col("offset").alias("at"), F.col("exit").alias("to")), "warc_jumps")
    seen = materialize(starts.withColumnRenamed("offset", "at").join(jumps, ["file", "at"]).select("file", "at"), "warc_seen")
    n = seen.count()
    while n:
        onward = seen.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        new = materialize(seen.union(onward.join(jumps.select("file", "at"), ["file", "at"], "left_semi")).distinct(), "warc_seen")
        had, n = n, new.count()
        seen = new
        if n == had:
            break
        again = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("far"))
        jumps = materialize(jumps.join(again, ["file", "to"]).select("file", "at", F.col("far").alias("to"))
                            .union(jumps.join(again, ["file", "to"], "left_anti").select("file", "at", "to")), "warc_jumps")
    return (seen.withColumnRenamed("at", "offset").join(place, ["file", "offset"])
            .groupBy("file", "block", "run").agg(F.min("offset").alias("entry")))


def _real(spark: SparkSession, path: str) -> DataFrame:
    """The candidates under ``path``, those that are records marked ``real``."""
    found = candidates(spark, path)
    real = (found.join(reached(found), ["file", "block", "run"], "left")
            .withColumn("real", F.coalesce(F.col("offset") >= F.col("entry"), F.lit(False))).drop("entry"))
    return materialize(real, "warc_real")


def ends(real: DataFrame) -> DataFrame:
    """(file, file_size, end): where the chain of whole records of each archive ends.

    ``end`` is less than ``file_size`` if the archive is cut off or broken there (0: no whole record).
    """
    done = F.when(F.col("real") & (F.col("successor") <= F.col("file_size")), F.col("successor"))
    return real.groupBy("file", "file_size").agg(F.coalesce(F.max(done), F.lit(0)).alias("end"))


def read(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """The records under ``path``: file, offset, type, ids, target, payload size and digest.

    n_bytes and digest are those of the payload found in the archive; stated_bytes and
    stated_digest those its headers name, which for a revisit describe the page revisited.
    A record that the end of its file cuts off is left out; with ``strict`` a chain that ends
    before its file does raises, naming such a file.
    """
    real = _real(spark, path)
    if strict:
        short = ends(real).filter("end < file_size").first()
        if short:
            raise ValueError(f"records end at byte {short['end']} of {short['file_size']} in {short['file']}")
    facts = ["file", "offset", "record_type", "record_id", "refers_to_id", "target_uri",
             "stated_digest", "stated_bytes", "n_bytes", "digest"]
    records = real.filter("real and whole").select(*facts)
    broken = real.filter("real and not whole and successor <= file_size").select("file", "offset")
    if broken.isEmpty():
        return records
    # Each stretch belongs to the last record that starts at or before it.
    inside = W.partitionBy("file", "block").orderBy("seq")
    start = F.when(F.col("real"), F.col("offset"))
    last = real.groupBy("file", "block").agg(F.max(start).alias("last"))
    carried = last.select("file", "block", F.max("last").over(
        W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)).alias("carried"))
    parts = (real.join(carried, ["file", "block"])
             .withColumn("owner", F.coalesce(F.max(start).over(inside), F.col("carried")))
             .join(broken.withColumnRenamed("offset", "owner"), ["file", "owner"])
             .select("file", "owner", "offset", "sha"))
    parts = materialize(parts, "warc_parts")
    # Where a stretch lies in the second scan does not matter: its bytes are found by their digest.
    held = (_segments(spark, path).select(_sha("bytes"), "bytes")
            .join(parts.select("sha").distinct(), "sha", "left_semi").groupBy("sha").agg(F.first("bytes").alias("bytes")))
    there = F.coalesce("bytes", F.raise_error(F.lit("a part of a record is missing from the second scan")).cast("binary"))
    joined = (parts.join(held, "sha", "left")
              .groupBy("file", F.col("owner").alias("offset"))
              .agg(F.sort_array(F.collect_list(F.struct(F.col("offset").alias("at"), there.alias("bytes")))).alias("parts")))
    magic = F.lit(MAGIC.encode())
    whole = F.aggregate(F.slice("parts", 2, F.size("parts")), F.get("parts", F.lit(0))["bytes"],
                        lambda a, x: F.concat(a, magic, x["bytes"]))
    again = _parsed(joined.select("file", "offset", whole.alias("bytes")))
    return records.unionByName(again.filter("whole").select("file", "offset", *_facts()).select(*facts))


def page_id(name: str) -> Column:
    """The page number in a record id of ours; NULL without one."""
    return F.regexp_extract(F.coalesce(F.col(name), F.lit("")), rf"^<{URN}(-?[0-9]+)>$", 1).try_cast("long")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back: one row per page.

    page_id, payload_bytes and payload_digest of the full payload, record_type, refers_to and
    ``intact``: for a response whether the payload found is what its headers state, for a revisit
    whether it is empty and its headers state what the response it names was found to hold. If an
    archive can't be read to its end, or not as many records as pages come back, this raises.
    An empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = shared_dir(spark, "warc")
    write(pages, path, least)
    records = materialize(read(spark, path, strict=True).select(
        "record_type", "record_id", "refers_to_id", "stated_digest", "stated_bytes", "n_bytes", "digest"), "warc_records")
    n, wanted = records.count(), pages.count()
    if n != wanted:
        raise RuntimeError(f"{n} records were read back of {wanted} pages")
    response = F.col("record_type") == "response"
    named = records.filter(~response).select(F.col("refers_to_id").alias("record_id")).distinct()
    held = (records.filter(response).join(named, "record_id", "left_semi")
            .select(F.col("record_id").alias("refers_to_id"), F.col("digest").alias("stated_digest"),
                    F.col("n_bytes").alias("stated_bytes"), F.lit(True).alias("held")).distinct())
    return records.join(held, ["refers_to_id", "stated_digest", "stated_bytes"], "left").select(
        page_id("record_id").alias("page_id"),
        F.when(response, F.col("n_bytes")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(response, F.col("digest")).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "record_type", page_id("refers_to_id").alias("refers_to"),
        F.when(response, (F.col("digest") == F.col("stated_digest")) & (F.col("n_bytes") == F.col("stated_bytes")))
        .otherwise((F.col("n_bytes") == 0) & F.coalesce("held", F.lit(False))).alias("intact"))
