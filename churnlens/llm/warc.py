"""WARC archives: a writer on Spark's text sink and a Python data source.

Writing. A record's header and payload are text, so archives are written by
Spark itself: a row per record, ``\\r\\n`` between records. Payloads of at least
``min_bytes`` that occur more than once are kept once; the others become
revisit records that name it.

Reading. ``spark.read.format("warc")`` plans one partition per archive file
(``maxPartitionBytes`` packs small files), takes equality and IN filters on
``record_type`` and on header columns from the optimiser, parses headers first
and steps over the payload of records that a filter excludes. The option
``payload`` (default true) says whether payloads are decoded at all. Files are
opened through pyarrow's file systems, so paths may be local, HDFS or object
stores; ``.gz`` archives, one member or one per record, are read as streams.
"""

from __future__ import annotations

import io
import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from churnlens.llm.common import written

VERSION = "WARC/1.1"
#: Column -> header of the columns that headers give.
HEADERS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to",
    "content_type": "content-type",
}
SCHEMA = ("record_type string, record_id string, target_uri string, payload_digest string, refers_to string, "
          "content_type string, content_length long, headers string, payload binary")


def _urn(col) -> F.Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(col.cast("string"), F.lit("")), F.lit(">"))


def _one_line(col) -> F.Column:
    """Header values hold no line ends."""
    return F.regexp_replace(F.coalesce(col, F.lit("")), r"[\r\n]+", " ")


def plan_records(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
                 uri_col: str = "url", min_bytes: int = 1000) -> DataFrame:
    """id, uri, payload, bytes, digest, refers_to (null for a response).

    Of equal payloads (same SHA-1 and length) of ``min_bytes`` or more, the one
    with the largest id is the response; rows repeating that id revisit nothing
    and are responses too. Rows without id never win over others. A null
    payload is empty, a null uri is empty.
    """
    body = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), _one_line(F.col(uri_col)).alias("uri"), body.alias("payload"),
                        F.octet_length(body).cast("long").alias("bytes"),
                        F.sha1(F.encode(body, "UTF-8")).alias("digest"))
    # only digests that repeat, written so that their true size picks the join
    first = written(rows.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes")
                    .agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "payloads")
    return rows.join(first, ["digest", "bytes"], "left").select(
        "id", "uri", "payload", "bytes", "digest",
        F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """Write the rows of ``plan_records`` as WARC files under ``path``.

    A revisit has no payload; the full payload's length is kept in the header
    ``X-Payload-Length``. An empty table writes no record.
    """
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit(f"{VERSION}\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _urn(F.col("id"))), line("WARC-Target-URI", F.col("uri")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(
            line("WARC-Refers-To", _urn(F.col("refers_to"))),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        )).otherwise(""),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(body).cast("string")))
    # a record ends with two line ends, of which the sink writes one
    (records.select(F.concat(head, F.lit("\r\n"), body, F.lit("\r\n")).alias("value"))
     .write.option("lineSep", "\r\n").option("compression", compression).text(path))


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def _filesystem(path: str):
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.most = int(options.get("maxpartitionbytes", 128 << 20))
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters):
        """Equality and IN on header columns are applied here, all others by
        Spark."""
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if column in HEADERS and values is not None and None not in values:
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield f

    def partitions(self):
        from pyarrow import fs
        store, root = _filesystem(self.path)
        info = store.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(root, recursive=True))
        scheme = self.path.split("://")[0] + "://" if "://" in self.path and not self.path.startswith("file:") else ""
        files = sorted(((f.path, f.size) for f in found if f.type == fs.FileType.File and f.size
                        and not f.base_name.startswith(("_", "."))))
        out, held = [], 0
        for p, size in files:
            if not out or held + size > self.most:
                out.append([])
                held = 0
            out[-1].append(scheme + p)
            held += size
        return [_Files(x) for x in out] or [_Files([])]

    def read(self, partition):
        cols: list[list] = [[] for _ in range(9)]
        held = 0
        for path in partition.paths:
            for record in read_file(path, self.wanted, self.payload):
                for c, v in zip(cols, record):
                    c.append(v)
                held += 600 + len(record[-1] or b"")
                if held > 8 << 20:
                    yield _batch(cols)
                    cols, held = [[] for _ in range(9)], 0
        if cols[0]:
            yield _batch(cols)


_ARROW = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]])
                    for c in SCHEMA.split(", ")])


def _batch(cols: list[list]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t.type) for c, t in zip(cols, _ARROW)], schema=_ARROW)


def read_file(path: str, wanted: dict[str, set], payload: bool):
    """Records of one archive whose headers are among the wanted values."""
    store, name = _filesystem(path)
    if path.endswith(".gz"):
        import gzip
        with store.open_input_file(name) as raw, gzip.GzipFile(fileobj=raw) as plain, io.BufferedReader(plain, 1 << 20) as f:
            yield from _records(f, wanted, payload, f.read)
    else:
        with store.open_input_file(name) as raw, io.BufferedReader(_Raw(raw), 1 << 20) as f:
            yield from _records(f, wanted, payload, lambda n: f.seek(n, 1))


class _Raw(io.RawIOBase):
    """A pyarrow file as a raw stream; seek and tell do not read."""

    def __init__(self, file):
        self.file = file

    def readable(self):
        return True

    def seekable(self):
        return True

    def readinto(self, b):
        return self.file.readinto(b)

    def seek(self, offset, whence=0):
        return self.file.seek(offset, whence)

    def tell(self):
        return self.file.tell()


def _records(f, wanted: dict[str, set], payload: bool, skip):
    while line := f.readline():
        line = line.rstrip(b"\r\n")
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at a record's start: {line[:60]!r}")
        headers: dict[str, str] = {}
        last = None
        while (line := f.readline()) and (text := line.rstrip(b"\r\n")):
            if text[:1] in b" \t" and last:  # a folded line
                headers[last] += " " + text.strip().decode("utf-8", "replace")
                continue
            k, _, v = text.partition(b":")
            last = k.strip().decode("utf-8", "replace").lower()
            headers[last] = v.strip().decode("utf-8", "replace")
        size = int(headers.get("content-length", 0))
        values = {c: headers.get(h) for c, h in HEADERS.items()}
        if not all(values[c] in ok for c, ok in wanted.items()):
            skip(size)
            continue
        if payload:
            body = f.read(size)
            if len(body) != size:
                raise ValueError(f"record {values['record_id']} ends before its {size} bytes")
        else:
            body = None
            skip(size)
        yield (*values.values(), size, json.dumps(headers), body)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records under ``path``. Turns on the session's filter pushdown into
    Python data sources, which the reader needs also when the plan runs."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def page_digests(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of
    archives that ``write_warc`` wrote. A response's length and digest are
    computed from the payload read, a revisit's are those of its headers."""
    page = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1)
    seen = F.col("record_type") == "response"
    return records.select(
        F.nullif(page(F.col("record_id")), F.lit("")).cast("long").alias("page_id"),
        F.when(seen, F.octet_length("payload"))
         .otherwise(F.get_json_object("headers", "$.x-payload-length")).cast("long").alias("payload_bytes"),
        F.when(seen, F.sha1("payload"))
         .otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type", page(F.col("refers_to")).cast("long").alias("refers_to"))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
r AS (SELECT *, strlen(body) AS bytes, CASE WHEN strlen(body) >= 1000
        THEN max(page_id) OVER (PARTITION BY body) ELSE page_id END AS first FROM p)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to
FROM r"""
