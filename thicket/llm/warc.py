"""WARC archives: written with segmented, chunk-framed records, and read back by segment reassembly.

Records are built and written by Spark's own text writer (whose line separator is the two line ends that close
a WARC record), so archives can lie in any file system that Spark reaches. The reader groups continuation
records by the identifier of their origin, orders them by segment number, checks the total length, and decodes
the chunked framing of the HTTP body.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, materialize

CRLF = "\r\n"
MIN_REVISIT = 1000


def _bytes(text: str) -> Column:
    return F.lit(text).cast("binary")


def _pieces(data: Column, size: int) -> Column:
    """``data`` cut into pieces of ``size`` bytes; none for empty data."""
    n = F.ceil(F.octet_length(data) / size).cast("int")
    return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.substring(data, i * size + 1, size))


def _joined(parts: Column) -> Column:
    """An array of binaries as one binary. Casting does not look at the bytes; the copy is linear."""
    return F.array_join(F.transform(parts, lambda p: p.cast("string")), "").cast("binary")


def chunked(data: Column, size: int) -> Column:
    """HTTP chunked framing: length in hex, data, line ends, and the closing chunk of no bytes."""
    framed = F.transform(_pieces(data, size), lambda p: F.concat(F.lower(F.hex(F.octet_length(p))).cast("binary"), _bytes(CRLF), p, _bytes(CRLF)))
    return F.concat(_joined(framed), _bytes("0" + CRLF + CRLF))


def warc_records(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", segment_bytes: int = 16384, chunk_bytes: int = 4096) -> DataFrame:
    """One row a WARC record (``record`` string of bytes, without the closing line ends).

    Of rows with equal payloads of at least 1000 bytes, the one with the largest key (ties: the largest url) is a
    ``response``; the others are ``revisit`` records that refer to it. Which row that is, and the identifier by which
    the others name it, follow from contents alone, so it does not matter how the two scans are split. Rows that are
    alike in key, url and payload are counted before they are dealt out: one response, and as many revisits as there
    are further ones. A null key sorts first and has no Page-Id field; a null payload is empty; a null url leaves its
    field out. An empty table gives no records; other columns are ignored.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    base = df.select(F.col(key).alias("key"), F.regexp_replace(url, r"[\x00-\x20]", "%20").alias("url"), payload.alias("payload"))
    base = base.withColumns({"n": F.octet_length("payload"), "digest": F.sha1("payload")})

    def urn(*parts: Column) -> Column:
        plain = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
        return F.regexp_replace(plain, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")

    head_id = urn(F.col("head.key"), F.col("digest"), F.col("head.url"), F.lit("head"))
    alike = base.where(F.col("n") >= MIN_REVISIT).groupBy("digest", "key", "url").agg(F.count(F.lit(1)).alias("alike"), F.max("n").alias("n"))
    heads = alike.groupBy("digest").agg(F.max(F.struct("key", "url", "alike", "n")).alias("head"), F.sum("alike").alias("copies")).where("copies > 1")
    heads = materialize(heads.select("digest", "head"), "warc-heads")  # its size is known then: Spark broadcasts it, or sorts both sides
    met = base.join(heads, "digest", "left").withColumn("is_head", F.col("key").eqNullSafe(F.col("head.key")) & F.col("url").eqNullSafe(F.col("head.url")) & F.col("head").isNotNull())
    repeated = F.col("is_head") & (F.col("head.alike") > 1)
    columns = ["id", "key", "url", "payload", "n", "digest", "head", "head_id", "revisit"]
    own_id = F.when(F.col("is_head"), head_id).otherwise(urn(F.col("key"), F.col("digest"), F.col("url"), F.monotonically_increasing_id()))
    rows = met.where(~F.coalesce(repeated, F.lit(False))).select(own_id.alias("id"), "key", "url", "payload", "n", "digest", "head", head_id.alias("head_id"), (F.col("head").isNotNull() & ~F.col("is_head")).alias("revisit"))
    many = heads.where("head.alike > 1").select("digest", "head", F.col("head.key").alias("key"), F.col("head.url").alias("url"), F.col("head.n").alias("n"), head_id.alias("head_id"))
    if many.take(1):
        payloads = met.where(repeated).groupBy("digest").agg(F.first("payload").alias("payload"))  # one a task before they meet
        firsts = many.join(payloads, "digest").select("*", F.col("head_id").alias("id"), F.lit(False).alias("revisit"))
        turns = many.withColumn("turn", F.explode(F.sequence(F.lit(2).cast("long"), F.col("head.alike"))))
        others = turns.select("*", F.lit(None).cast("binary").alias("payload"), urn(F.col("head_id"), F.col("turn")).alias("id"), F.lit(True).alias("revisit"))
        rows = rows.unionByName(firsts.select(*columns)).unionByName(others.select(*columns))
    http = F.concat(_bytes("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF))
    block = F.when(F.col("revisit"), F.concat(http, _bytes("Content-Length: "), F.col("n").cast("string").cast("binary"), _bytes(CRLF * 2))).otherwise(
        F.concat(http, _bytes("Transfer-Encoding: chunked" + CRLF * 2), chunked(F.col("payload"), chunk_bytes))
    )
    cut = rows.select("id", "key", "url", "digest", "head", "head_id", "revisit", block.alias("block"))
    cut = cut.select("id", "key", "url", "digest", "head", "head_id", "revisit", F.octet_length("block").alias("total"), F.posexplode(_pieces(F.col("block"), segment_bytes)).alias("seg", "part"))
    many, last = F.col("total") > segment_bytes, (F.col("seg") + 1) * segment_bytes >= F.col("total")
    first = F.col("seg") == 0

    def field(name: str, value: Column, when: Column | None = None) -> Column:
        line = F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))
        return F.coalesce(line if when is None else F.when(when, line), F.lit(""))

    own = F.when(first, F.col("id")).otherwise(F.concat(F.expr("left(id, length(id) - 1)"), F.lit(";seg="), F.col("seg") + 1, F.lit(">")))
    head = F.concat(
        F.lit("WARC/1.1" + CRLF),
        field("WARC-Type", F.when(~first, F.lit("continuation")).when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", own),
        F.lit("WARC-Date: 2024-01-01T00:00:00Z" + CRLF),
        field("WARC-Target-URI", F.col("url")),
        field("Page-Id", F.col("key"), first),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")), first),
        field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), first & F.col("revisit")),
        field("WARC-Refers-To", F.col("head_id"), first & F.col("revisit")),
        field("WARC-Refers-To-Target-URI", F.col("head.url"), first & F.col("revisit")),
        field("WARC-Segment-Number", F.col("seg") + 1, many),
        field("WARC-Segment-Origin-ID", F.col("id"), ~first),
        field("WARC-Segment-Total-Length", F.col("total"), many & last),
        F.lit("Content-Type: application/http; msgtype=response" + CRLF),
        field("Content-Length", F.octet_length("part")),
        F.lit(CRLF),
    )
    return cut.select(F.concat(head.cast("binary"), F.col("part")).cast("string").alias("record"))


def write_warc(df: DataFrame, path: str, archive_bytes: int = 32 << 20, segment_bytes: int = 16384, **names) -> None:
    """Writes gzip archives of at most about ``archive_bytes`` before compression into the folder ``path``."""
    records = warc_records(df, segment_bytes=segment_bytes, **names)
    records.write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", max(1, archive_bytes // (segment_bytes + 700))).text(path)


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while True:
        while data[at : at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            return
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        n = int(fields["content-length"])
        yield fields, data[end + 4 : end + 4 + n]
        at = end + 4 + n


def _inflate(data: bytes) -> bytes:
    """All gzip members of a file; other data as it is."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data[:2] == b"\x1f\x8b":
        d = zlib.decompressobj(31)
        out.append(d.decompress(data) + d.flush())
        data = d.unused_data
    return b"".join(out)


RECORD = "origin string, id string, type string, page_id long, uri string, digest string, refers_id string, seg int, total long, block binary"


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content in batch["content"]:
            rows = []
            for f, block in _records(_inflate(bytes(content))):
                if f["warc-type"] not in ("response", "revisit", "continuation"):
                    continue
                rid = f["warc-record-id"]
                rows.append((
                    f.get("warc-segment-origin-id", rid), rid, f["warc-type"], int(f["page-id"]) if "page-id" in f else None, f.get("warc-target-uri"),
                    f.get("warc-payload-digest", "").removeprefix("sha1:"), f.get("warc-refers-to"), int(f.get("warc-segment-number", 1)),
                    int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None, block,
                ))
                if len(rows) == 256:
                    yield _frame(rows)
                    rows = []
            if rows:
                yield _frame(rows)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [x.split()[0] for x in RECORD.split(", ")]
    out = pd.DataFrame(rows, columns=names)
    return out.astype({"page_id": "Int64", "total": "Int64"})


def dechunk(body: bytes) -> bytes:
    """The data of a chunk-framed body; raises ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk length is cut off")
        n = int(body[at:end].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        piece = body[end + 2 : end + 2 + n]
        if len(piece) < n or body[end + 2 + n : end + 4 + n] != b"\r\n":
            raise ValueError("chunk is cut off")
        out.append(piece)
        at = end + 4 + n


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        payloads, lengths, problems = [], [], []
        for block, gaps, want, type_ in zip(batch["block"], batch["gaps"], batch["total"], batch["type"], strict=True):
            payload, length, problem = None, None, None
            head, _, body = bytes(block).partition(b"\r\n\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:])}
            if type_ is None or gaps:
                problem = "segments are missing"
            elif not pd.isna(want) and int(want) != len(block):
                problem = f"{len(block)} bytes, not {int(want)}"
            elif type_ == "revisit":
                length = int(fields.get("content-length", 0))
            else:
                try:
                    payload = dechunk(body) if fields.get("transfer-encoding", "").lower() == "chunked" else body
                    length = len(payload)
                except ValueError as e:
                    problem = str(e)
            payloads.append(payload)
            lengths.append(length)
            problems.append(problem)
        yield pd.DataFrame({"id": batch["id"], "type": batch["type"], "page_id": batch["page_id"].astype("Int64"), "uri": batch["uri"], "digest": batch["digest"], "refers_id": batch["refers_id"], "payload": payloads, "payload_bytes": pd.array(lengths, dtype="Int64"), "problem": problems})


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Whole records of all archives in ``path``.

    Columns: ``id, type, page_id, uri, digest`` (as the record states it), ``refers_id, payload`` (null for
    revisits), ``payload_bytes``, ``refers_to`` (the page of the record referred to) and ``problem``: what is
    wrong with a record whose segments are missing, repeated or of another total length, or whose chunk
    framing is broken, or whose payload has another digest; else null. No record is dropped for a problem.
    The segments of a record meet in one task, as one payload must; no other group is gathered.
    """
    parts = spark.read.format("binaryFile").load(path).select("content").mapInPandas(_parse, RECORD)
    whole = parts.groupBy(F.col("origin").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("seg", "block"))).alias("parts"),
        *[F.max(F.when(F.col("seg") == 1, F.col(c))).alias(c) for c in ("type", "page_id", "uri", "digest", "refers_id")],
        F.max("total").alias("total"),
    )
    numbers = F.transform("parts", lambda p: p["seg"])
    joined = whole.select("id", "type", "page_id", "uri", "digest", "refers_id", "total", (numbers != F.sequence(F.lit(1), F.size("parts"))).alias("gaps"), _joined(F.transform("parts", lambda p: p["block"])).alias("block"))
    decoded = joined.mapInPandas(_decode, "id string, type string, page_id long, uri string, digest string, refers_id string, payload binary, payload_bytes long, problem string")
    wrong = F.col("problem").isNull() & F.col("payload").isNotNull() & (F.sha1("payload") != F.col("digest"))
    decoded = decoded.withColumn("problem", F.when(wrong, F.lit("digest differs")).otherwise(F.col("problem")))
    return decoded


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Adds ``refers_to``, the page of the response a revisit refers to (null where it is not in the archives)."""
    pages = records.where("type = 'response'").select(F.col("id").alias("refers_id"), F.col("page_id").alias("refers_to"))
    revisits = records.where("type = 'revisit'").join(pages, "refers_id", "left")
    return records.where("type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long")).unionByName(revisits.select(*records.columns, "refers_to"))


def sound(records: DataFrame) -> DataFrame:
    """``records`` without the column ``problem``; fails at the first record that has one, so that none goes missing unseen."""
    told = F.raise_error(F.concat(F.lit("WARC record "), F.coalesce("id", F.lit("?")), F.lit(": "), F.col("problem"))).cast("string")
    return records.withColumn("type", F.when(F.col("problem").isNotNull(), told).otherwise(F.col("type"))).drop("problem")


def op5(spark, sf_dir: str) -> DataFrame:
    """``pages`` written to archives and read back. Fails at a record that does not check."""
    path = fresh_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    records = sound(read_warc(spark, path))
    digests = records.select("id", "type", "page_id", "refers_id", "payload_bytes", F.when(F.col("type") == "revisit", F.col("digest")).otherwise(F.sha1("payload")).alias("payload_digest"))
    return resolve_revisits(materialize(digests, "warc-read")).select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
h AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS head FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN head = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN head = page_id THEN NULL ELSE head END AS refers_to FROM h
"""
