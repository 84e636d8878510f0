"""WARC archives: written with DataFrame functions, read by a Python data source.

``write_warc`` makes one record per page: the first page of a payload (the smallest page_id) is a *response*
that holds the HTTP head and the payload, the others are *revisits* that hold the head alone and name the
response.  Records are laid out as text lines ended by the blank lines that end a WARC record, so Spark's
own text writer and its commit protocol put them on whatever file system the path names.

``WarcSource`` (format ``warc``) reads them back.  Partitions are groups of whole files, planned by size on
the driver.  Filters on the record type, on ids and on digests are taken over and judged on a record's head;
the reader then seeks past the blocks of records that are not wanted, and past every block if the schema
asked for has no ``payload``, and no such bytes are decoded.

Defined cases: null html is an empty payload; a null page_id gives a response of its own; rows that
repeat both page_id and payload are responses each; line breaks in a url are percent-encoded and a null url
leaves its header out; an empty table gives an archive without records; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull

from .common import join_hot, materialise, read_table, scratch_path

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n\r\n"
SCHEMA = "warc_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary, file string, offset long"
#: Head fields by column; filters on them need no payload.
HEADERS = {"warc_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once: a lambda's variable, not a copied expression."""
    return F.element_at(F.transform(F.array(value), use), 1)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1: 160 bits are 32 characters of five."""

    def bits_of(hexes: Column) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.lpad(F.conv(F.substring(hexes, i * 5 + 1, F.lit(5)), 16, 2), 20, "0")), "")

    def letters(bits: Column) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.substring(F.lit(BASE32), F.conv(F.substring(bits, i * 5 + 1, F.lit(5)), 2, 10).cast("int") + 1, F.lit(1))), "")

    return _once(_once(F.sha1(payload), bits_of), letters)


def page_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, digest, first_id (the payload's response)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    one = pages.select("page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), base32_sha1(payload.cast("binary")).alias("digest"))
    # Digests alone are shuffled here; only payloads met twice are joined.
    groups = one.where(F.col("payload_bytes") >= min_bytes).groupBy("digest", "payload_bytes").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    repeated = materialise(groups.where("n > 1").drop("n"), "repeated-payloads")
    return join_hot(one, repeated, ["digest", "payload_bytes"], F.col("page_id"))


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", records_per_file: int = 50_000) -> None:
    r = page_records(pages, min_bytes)
    revisit = F.col("first_id").isNotNull() & F.col("page_id").isNotNull() & (F.col("first_id") != F.col("page_id"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), F.lit("Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.0\r\n"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))), line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.lit(date)), F.coalesce(line("WARC-Target-URI", url), F.lit("")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(F.col("first_id"))), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")), F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END),
    )
    r.select(F.concat(head, block).alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


class WarcFiles(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


def _open(uri: str):
    """A file system and a path on it; a bare path is local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if re.match(r"[a-z0-9+.-]+:", uri) else (fs.LocalFileSystem(), uri)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str], types: pa.Schema, split_bytes: int):
        self.path, self.columns, self.types, self.split_bytes = path, columns, types, split_bytes
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo | In):
                self.wanted.append((name, frozenset(f.value if isinstance(f, In) else [f.value])))
            elif not (isinstance(f, IsNotNull) and name in ("warc_type", "record_id")):  # these are always there
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, path = _open(self.path)
        found = [x for x in system.get_file_info(fs.FileSelector(path, recursive=True)) if x.is_file and x.size and not x.base_name.startswith(("_", "."))]
        groups: list[list[str]] = []
        room = 0
        for x in sorted(found, key=lambda x: x.path):
            if not groups or x.size > room:
                groups.append([])
                room = self.split_bytes
            groups[-1].append(x.path)
            room -= x.size
        return [WarcFiles(g) for g in groups]

    def read(self, partition: WarcFiles | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no files, no partitions
            return
        system = _open(self.path)[0]
        rows: list[dict] = []
        held = 0
        for path in partition.files:
            with system.open_input_file(path) as f:
                for row in self._records(f, path):
                    rows.append(row)
                    held += len(row.get("payload") or b"") + 500
                    if held > 8 << 20:
                        yield self._batch(rows)
                        rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{c: r.get(c) for c in self.columns} for r in rows], schema=self.types)

    def _records(self, f, path: str) -> Iterator[dict]:
        at, size, ahead = 0, f.size(), 1 << 12
        while at < size:
            f.seek(at)
            data = f.read(ahead)
            while (end := data.find(b"\r\n\r\n")) < 0:
                if not (more := f.read(ahead)):
                    raise ValueError(f"a record's head at {at} of {path} does not end")
                data += more
            lines = data[:end].decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no record at {at} of {path}")
            head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            block, length = at + end + 4, int(head["content-length"])
            row = {c: head.get(h) for c, h in HEADERS.items()} | {"file": path, "offset": at}
            if all(row[name] in values for name, values in self.wanted):
                if "payload" in self.columns or "payload_bytes" in self.columns:
                    self._payload(f, row, data[end + 4 :][:length], block, length)
                yield row
            at = block + length + 4

    def _payload(self, f, row: dict, data: bytes, block: int, length: int) -> None:
        """The HTTP head says the payload's size; only a response's own block holds the payload itself."""
        while (cut := data.find(b"\r\n\r\n")) < 0 and len(data) < length:
            f.seek(block + len(data))
            data += f.read(min(1 << 12, length - len(data)))
        said = re.search(rb"(?im)^content-length:\s*(\d+)", data[: max(cut, 0)])
        row["payload_bytes"] = int(said[1]) if said else length - max(cut + 4, 0)
        if "payload" in self.columns and row["warc_type"] != "revisit":
            if len(data) < length:
                f.seek(block + len(data))
                data += f.read(length - len(data))
            row["payload"] = data[cut + 4 :]


class WarcSource(DataSource):
    """``spark.read.format("warc").schema(columns of SCHEMA).load(path)``; option split_bytes: bytes a partition, whole files."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        from pyspark.sql.pandas.types import to_arrow_schema

        return WarcReader(self.options["path"], schema.names, to_arrow_schema(schema), int(self.options.get("split_bytes", 64 << 20)))


def read_warc(spark: SparkSession, path: str, schema: str = SCHEMA, **options) -> DataFrame:
    spark.dataSource.register(WarcSource)
    # A Python data source is only offered filters where this is set.
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").schema(schema).options(**options).load(path)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    ids = "record_id string, warc_type string, refers_to string, payload_digest string, payload_bytes long"
    # Responses are measured by the payload read back; of revisits only heads are read.
    response = read_warc(spark, path, f"{ids}, payload binary").where("warc_type = 'response'")
    response = response.select("record_id", "warc_type", "refers_to", base32_sha1(F.col("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("bytes"))
    revisit = read_warc(spark, path, ids).where("warc_type = 'revisit'").select("record_id", "warc_type", "refers_to", F.regexp_replace("payload_digest", "^sha1:", "").alias("digest"), F.col("payload_bytes").alias("bytes"))
    both = response.unionByName(revisit)
    return both.select(number(F.col("record_id")).alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("warc_type").alias("record_type"), number(F.col("refers_to")).alias("refers_to"))
