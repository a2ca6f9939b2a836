"""WARC archives: writing captures of pages and assembling transactions when reading.

A capture is a request, a response or revisit, and a metadata record. Request and
metadata name the middle one in ``WARC-Concurrent-To``; reading brings records of
one capture together by that identifier and emits one nested row.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimforge.llm import arrow
from claimforge.session import materialize, shared_folder

# Fixed values of the format.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, record_id: str, headers: dict[str, str], block: bytes) -> bytes:
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{record_id}>"]
    lines += [f"{k}: {v}" for k, v in headers.items()] + [f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a WARC record is cut short")
        yield headers, block


def write_archives(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    file_bytes: int = 64 << 20,
    broadcast_rows: int = 200_000,
) -> tuple[DataFrame, str]:
    """Write one capture per row, gzip member by member; returns the file table and the folder.

    Of rows with equal payloads of at least ``least_bytes`` bytes, those with the
    largest id become responses (one, unless rows repeat that id) and the others
    revisits; smaller payloads are all responses. A revisit names the response's record in
    ``WARC-Refers-To``, unless several rows with the largest id are responses of the payload. Null html is an empty payload, a
    null url an empty target, null ids count as smaller than any; other columns are
    ignored and an empty table gives no file. The table of repeated payloads is
    broadcast only up to ``broadcast_rows`` rows, beyond which it is joined by shuffle.
    """
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    rows = arrow.in_small_batches(pages).select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(url_col, F.lit("")).alias("url"),
        F.coalesce(html_col, F.lit("")).alias("html"),
    ).withColumn("payload_key", F.sha2("html", 256))
    repeated = materialize(
        rows.where(F.octet_length("html") >= least_bytes).groupBy("payload_key", "id").count()
       .groupBy("payload_key").agg(F.max("id").alias("keep"), F.max_by("count", "id").alias("answers"), F.sum("count").alias("n"))
        .where("n > 1").select("payload_key", "keep", (F.col("answers") == 1).alias("single")),
        "payloads",
    )
    if repeated.count() <= broadcast_rows:
        repeated = F.broadcast(repeated)
    planned = rows.join(repeated, "payload_key", "left").select(
        "id", "url", "html", F.coalesce(F.col("keep") != F.col("id"), F.col("keep").isNotNull()).alias("revisit"),
        F.when(F.col("single"), F.col("payload_key")).alias("answer"),
    )
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, root = pafs.FileSystem.from_uri(folder)
        mark = f"{folder}/{task.partitionId()}/{task.taskAttemptId()}"
        out, at, n, files = None, 0, 0, []
        for batch in batches:
            for number, url, html, revisit, answer in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    files.append(f"{root}/part-{task.partitionId():06d}-{len(files):04d}-{task.taskAttemptId()}.warc.gz")
                    out, at = fs.open_output_stream(files[-1], compression=None), 0
                answer = answer and _record_id(folder, answer)
                for raw in capture(number, url, html.encode(), revisit, f"{mark}/{n}", date, answer):
                    packed = gzip.compress(raw, 3, mtime=0)
                    out.write(packed)
                    at += len(packed)
                n += 1
                if at >= file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.string())], ["path"])

    return materialize(planned.mapInArrow(write, "path string"), "warc-files"), folder


def _record_id(*parts: str) -> str:
    return str(uuid.uuid5(uuid.NAMESPACE_URL, "/".join(parts)))


def capture(number: int | None, url: str, payload: bytes, revisit: bool, mark: str, date: str, answer: str | None = None) -> Iterator[bytes]:
    """The three records of one capture. ``answer`` is the record id that the payload's response has or gets."""
    ids = [_record_id(mark, k) for k in ("request", "answer", "metadata")]
    if answer and not revisit:
        ids[1] = answer
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    common = {"WARC-Date": date, "WARC-Target-URI": target}
    joined = common | {"WARC-Concurrent-To": f"<urn:uuid:{ids[1]}>"}
    parts = urlsplit("" if "[" in target or "]" in target else target)
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    ask = f"GET {path} HTTP/1.1\r\nHost: {parts.netloc}\r\n\r\n".encode()
    yield record("request", ids[0], joined | {"Content-Type": "application/http;msgtype=request"}, ask)
    head = _HTTP + b"Content-Length: %d\r\n\r\n" % len(payload)
    named = common | {"Content-Type": "application/http;msgtype=response", "WARC-Payload-Digest": f"sha1:{digest(payload)}"}
    if revisit:
        refers = {"WARC-Refers-To": f"<urn:uuid:{answer}>"} if answer else {}
        yield record("revisit", ids[1], named | {"WARC-Profile": PROFILE} | refers, head)
    else:
        yield record("response", ids[1], named, head + payload)
    about = f"page-id: {'' if number is None else number}\r\n".encode()
    yield record("metadata", ids[2], joined | {"Content-Type": "application/warc-fields"}, about)


_RECORD = (
    "record_id string, type string, concurrent_to string, uri string, payload_digest string, "
    "payload_bytes long, payload binary, page_id long, request_line string, refers_to string"
)


def read_archives(files: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """All records of the files, one row each. A payload is checked against its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with fs.open_input_stream(path, compression=None) as f:
                    rows: list[tuple] = []
                    for headers, block in read_records(io.BufferedReader(gzip.GzipFile(fileobj=f))):
                        rows.append(_row(headers, block, with_payload))
                        if len(rows) >= 1500:
                            yield _records(rows)
                            rows = []
                    if rows:
                        yield _records(rows)

    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path").repartition(n, "path").mapInArrow(run, _RECORD)


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind, named = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    payload = number = line = None
    if kind == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if digest(payload) != named:
            raise ValueError(f"the payload of {headers['warc-record-id']} doesn't match its digest")
    elif kind == "metadata":
        fields = dict(x.split(": ", 1) for x in block.decode().splitlines() if ": " in x)
        number = int(fields["page-id"]) if fields.get("page-id") else None
    elif kind == "request":
        line = block.split(b"\r\n", 1)[0].decode()
    size = None if payload is None else len(payload)
    names = ("warc-record-id", "warc-concurrent-to", "warc-refers-to")
    own, joined, refers = (headers.get(k, "").removeprefix("<urn:uuid:").removesuffix(">") or None for k in names)
    return own, kind, joined, headers.get("warc-target-uri"), named, size, payload if with_payload else None, number, line, refers


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (*[pa.string()] * 5, pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string())
    names = [c.split()[0] for c in _RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, request, answer, metadata``.

    Records come together by ``WARC-Concurrent-To``, each capture's few records by
    its own identifier. A capture without request or metadata has null there;
    requests and metadata whose response is missing are left out.
    """
    part = lambda *c: F.struct(*c)
    of = lambda cond, s: F.max(F.when(cond, s))
    kind = F.col("type")
    return (
        records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id"))
        .agg(
            of(kind == "request", part("record_id", "request_line")).alias("request"),
            of(kind.isin("response", "revisit"), part("record_id", "type", "uri", "payload_digest", "payload_bytes", "payload", "refers_to")).alias("answer"),
            of(kind == "metadata", part("record_id", "page_id")).alias("metadata"),
        )
        .where(F.col("answer").isNotNull())
    )


def capture_table(files: DataFrame, folder: str, broadcast_rows: int = 200_000) -> DataFrame:
    """Per capture: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    A revisit has the payload length and the page of the response that its
    ``WARC-Refers-To`` names. One without that header refers to the response with its
    digest (the largest id if several share the payload). The table of responses referred
    to is broadcast only up to ``broadcast_rows`` rows.
    """
    rows = materialize(
        transactions(read_archives(files, folder)).select(
            "metadata.page_id", "answer.record_id", "answer.payload_bytes", "answer.payload_digest", F.col("answer.type").alias("record_type"),
            F.when(F.col("answer.type") == "revisit", F.coalesce("answer.refers_to", "answer.payload_digest")).alias("wanted"),
        ),
        "captures",
    )
    revisits = rows.where("record_type = 'revisit'").select("page_id", "payload_digest", "record_type", "wanted")
    wanted = revisits.select("wanted").distinct()
    names = F.explode(F.array("record_id", "payload_digest")).alias("wanted")
    answers = rows.where("record_type = 'response'").select(names, "page_id", "payload_bytes").join(wanted, "wanted", "left_semi")
    answers = materialize(answers.groupBy("wanted").agg(F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("payload_bytes")), "answers")
    if answers.count() <= broadcast_rows:
        answers = F.broadcast(answers)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    own = rows.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    return own.select(columns).union(revisits.join(answers, "wanted", "left").select(columns))


def op6_warc(spark, sf_dir: str) -> DataFrame:
    return capture_table(*write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet")))


OP6_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, unhex(sha1(coalesce(html, '')))::BIT::VARCHAR AS bits FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keep FROM p)
SELECT page_id, strlen(html) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
    16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT) +
    4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT) +
    CAST(substr(bits, 5 * i + 5, 1) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = keep THEN NULL ELSE keep END AS refers_to
FROM g
"""
