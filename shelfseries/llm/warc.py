"""Web archives: a Python data source that reads WARC files, and a writer on Spark's own text sink.

The writer makes one record per row as a string and lets Spark's text sink write it with the record terminator as line
separator, so files appear through Spark's commit protocol on any file system. The reader plans a partition per file (or
per group of small files), reads each as a stream, parses the header of a record first, and skips the block of records
that the pushed filters reject; payloads are decoded only when the ``payload`` column is asked for.
"""

from __future__ import annotations

import gzip
import io
import re
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition
from pyspark.sql.types import StructType

FORMAT = "warc_records"
END = "\r\n\r\n"
#: Columns of the reader that are header fields, and the fields; fixed values of the format.
FIELDS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "date": "WARC-Date", "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest", "profile": "WARC-Profile",
    "content_type": "Content-Type",
}
#: Profile of a revisit record with an identical payload; fixed value of the format.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = ", ".join(f"{c} string" for c in FIELDS) + ", content_length bigint, http_length bigint, payload binary"


# ---------------------------------------------------------------- reading

def _open(path: str):
    if urlsplit(path).scheme in ("", "file"):
        raw = open(urlsplit(path).path, "rb")
    else:
        from pyarrow import fs

        system, inside = fs.FileSystem.from_uri(path)
        raw = system.open_input_stream(inside, buffer_size=1 << 20)
    raw = io.BufferedReader(raw, 1 << 20) if not isinstance(raw, io.BufferedReader) else raw
    return gzip.open(raw) if path.endswith(".gz") else raw


def _files(path: str) -> list[tuple[str, int]]:
    """Data files below ``path`` with their sizes; names that start with a dot or underscore are no data."""
    from pyarrow import fs

    scheme = urlsplit(path).scheme
    system, inside = fs.FileSystem.from_uri(path) if scheme else (fs.LocalFileSystem(), path)
    top = system.get_file_info(inside)
    found = [top] if top.is_file else system.get_file_info(fs.FileSelector(inside, recursive=True, allow_not_found=True))
    prefix = path[: len(path) - len(urlsplit(path).path)] if scheme else ""
    return sorted((prefix + f.path, f.size) for f in found if f.is_file and f.size and f.base_name[0] not in "._")


def _skip(stream, n: int) -> None:
    if isinstance(stream, io.BufferedReader) and stream.seekable():
        stream.seek(n, io.SEEK_CUR)
        return
    while n:
        got = len(stream.read(min(n, 1 << 20)))
        if not got:
            raise EOFError("a record ends early")
        n -= got


def _header(stream) -> dict[str, str] | None:
    """The next record's header fields, names in lower case; None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record begins with {line[:40]!r}")
    fields: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def _http_split(block: bytes) -> tuple[bytes, int | None]:
    """An HTTP message's body, and the length its header states."""
    head, _, body = block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)
    return body, int(stated[1]) if stated else None


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


class Reader(DataSourceReader):
    """Equality and IN filters on header columns are decided on the header alone; all others stay with Spark."""

    def __init__(self, path: str, schema: StructType, group_bytes: int):
        self.path, self.schema, self.group_bytes = path, schema, group_bytes
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in FIELDS:
                self.wanted.append((FIELDS[f.attribute[0]].lower(), frozenset([f.value])))
            elif isinstance(f, In) and len(f.attribute) == 1 and f.attribute[0] in FIELDS:
                self.wanted.append((FIELDS[f.attribute[0]].lower(), frozenset(f.value)))
            else:
                yield f

    def partitions(self):
        groups, size = [[]], 0
        for path, n in _files(self.path):
            if groups[-1] and size + n > self.group_bytes:
                groups.append([])
                size = 0
            groups[-1].append(path)
            size += n
        return [Files(g) for g in groups if g] or [Files([])]

    def read(self, partition):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        names = self.schema.names
        into = to_arrow_schema(self.schema)
        rows: list[list] = []
        held = 0
        for path in partition.paths:
            with _open(path) as stream:
                while (h := _header(stream)) is not None:
                    length = int(h.get("content-length", 0))
                    if any(h.get(name) not in values for name, values in self.wanted):
                        _skip(stream, length)
                        continue
                    found = {c: h.get(field.lower()) for c, field in FIELDS.items()}
                    found["content_length"] = length
                    if "payload" in names or "http_length" in names:
                        block = stream.read(length)
                        if len(block) < length:
                            raise EOFError(f"a record of {path} ends early")
                        http = (found["content_type"] or "").startswith("application/http")
                        body, stated = _http_split(block) if http else (block, None)
                        found["payload"] = body if found["record_type"] != "revisit" else None
                        found["http_length"] = stated
                        held += length
                    else:
                        _skip(stream, length)
                    rows.append([found[c] for c in names])
                    held += 500
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), into.types)], schema=into)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), into.types)], schema=into)


class Records(DataSource):
    """``spark.read.format("warc_records").load(path)``; options ``columns`` (comma-separated, all if not given) and
    ``groupBytes`` (small files share a partition up to this size, 64 MB)."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        chosen = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]
        kinds = dict(c.split(" ") for c in SCHEMA.split(", "))
        return ", ".join(f"{c} {kinds[c]}" for c in chosen or kinds)

    def reader(self, schema):
        return Reader(self.options["path"], schema, int(self.options.get("groupbytes", 64 << 20)))


def read(spark: SparkSession, path: str, columns: tuple[str, ...] = (), group_bytes: int = 64 << 20) -> DataFrame:
    """Records of all archives below ``path`` (plain or ``.gz``); ``columns`` restricts what is parsed.

    An empty folder gives no rows; a truncated record fails. Filters on header columns (``record_type = 'response'``,
    ``target_uri in (...)``) are decided in the reader before a block is read.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Records)
    return spark.read.format(FORMAT).option("columns", ",".join(columns)).option("groupBytes", group_bytes).load(path)


# ---------------------------------------------------------------- writing

#: The alphabet of base 32 and the digits that conv() gives; fixed values.
BASE32, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def sha1_base32(content: Column) -> Column:
    """SHA-1 of a binary column in base 32: four bits more than a character of hex, so 40-bit groups convert alone."""
    h = F.sha1(content)
    groups = [F.lpad(F.conv(F.substring(h, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*groups)), DIGITS, BASE32)


def _field(name: str, value: Column) -> Column:
    """A header line, left out where the value is null; line breaks and controls in it become %-escapes."""
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(value.cast("string"), "\r", "%0D"), "\n", "%0A"), r"[\x00-\x1F]", "%00")
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n"))).otherwise(F.lit(""))


def plan_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", smallest: int = 0,
) -> DataFrame:
    """``pages`` as ``id, url, body (string), payload_bytes, digest, keeper``: among pages with equal payloads of at
    least ``smallest`` bytes ``keeper`` is the largest id; otherwise the page's own.

    Equal payloads have equal SHA-1 and SHA-256. Null html is an empty payload; a page without an id keeps to itself.
    """
    body = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), body.alias("body"))
    raw = F.col("body").cast("binary")
    rows = rows.withColumns({"payload_bytes": F.octet_length("body").cast("long"), "digest": sha1_base32(raw), "fp": F.sha2(raw, 256)})
    keepers = rows.where(F.col("payload_bytes") >= smallest).groupBy("digest", "fp").agg(
        F.max("id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = rows.join(keepers, ["digest", "fp"], "left")
    own = F.col("keeper").isNull() | F.col("id").isNull()
    return joined.withColumn("keeper", F.when(own, F.col("id")).otherwise(F.col("keeper"))).drop("fp")


def record_uri(ident: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(ident.cast("string"), F.lit("none")), F.lit(">"))


def write(planned: DataFrame, path: str, date: str = "2020-01-01T00:00:00Z", compression: str = "gzip") -> None:
    """Writes the rows of :func:`plan_records` as WARC 1.1 files below ``path``.

    A page whose keeper is itself becomes a ``response`` with an HTTP message as block; others a ``revisit`` that refers
    to the keeper and has the HTTP header alone, which states the full payload's length.
    """
    response = F.col("id").eqNullSafe(F.col("keeper"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(response, F.concat(http, F.col("body"))).otherwise(http)
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(response, F.lit("response")).otherwise(F.lit("revisit"))),
        _field("WARC-Record-ID", record_uri(F.col("id"))), _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(response, F.lit("")).otherwise(F.concat(
            _field("WARC-Profile", F.lit(SAME_PAYLOAD)), _field("WARC-Refers-To", record_uri(F.col("keeper"))))),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"), F.lit(END))
    (planned.withColumn("block", block).select(F.concat(head, F.col("block")).alias("value"))
     .write.option("lineSep", END).option("compression", compression).text(path))


def page_of(uri: Column) -> Column:
    """The page id inside a record URI, null where there is none."""
    return F.regexp_extract(uri, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def check_payloads(records: DataFrame) -> DataFrame:
    """``records`` (with payload), failing on a response whose payload does not have the digest of its header."""
    good = F.concat(F.lit("sha1:"), sha1_base32(F.col("payload"))) == F.col("payload_digest")
    fail = F.raise_error(F.concat(F.lit("wrong payload digest in "), F.col("record_id"))).cast("string")
    return records.withColumn("payload_digest", F.when((F.col("record_type") != "response") | good, F.col("payload_digest")).otherwise(fail))
