"""WARC archives: written with one gzip member per record, read back by tasks that each take a byte range.

A reading task looks for gzip magic from the start of its range, decodes each candidate's head and takes it for a
record only if a WARC header comes out; from there members follow one another. A task owns the records that start
inside its range and reads past the end to finish the last one. Bytes travel through pyarrow file systems, which know
local and mounted paths and the usual object stores by their URI.

Input cases: a null html is an empty payload; a null url has no target header; a null page id is written as such and
comes back null, and never is what others refer to; of repeated rows that carry the largest id of a payload each is a
response; an empty table gives empty archives and an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tables

#: Payloads from this size on are stored once.
REVISIT_BYTES = 1000
#: Compressed bytes of an archive file, about, and of the range of one reading task.
FILE_BYTES = 256 << 20
RANGE_BYTES = 8 << 20
#: Tasks that read ranges, at most.
READ_TASKS = 10_000
_CHUNK = 1 << 18
# Fixed values of the formats.
_MAGIC = b"\x1f\x8b\x08"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2025-01-01T00:00:00Z"


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member; with ``refers_to`` a revisit, which has no payload of its own."""
    kind = "response" if refers_to is None else "revisit"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._')}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
        payload = b""
    lines += ["Content-Type: text/html", f"Content-Length: {len(payload)}", "", ""]
    packer = zlib.compressobj(2, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + payload + b"\r\n\r\n") + packer.flush()


def plan_records(pages: DataFrame) -> DataFrame:
    """Pages with ``payload``, ``digest`` and, for those that repeat a payload, the page that they revisit."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= REVISIT_BYTES
    groups = rows.filter(large).groupBy(F.col("digest").alias("same")).agg(
        F.max("page_id").alias("holder"), F.count("*").alias("n")
    )
    groups = groups.filter("n > 1 and holder is not null").select("same", "holder")
    joined = rows.join(groups, (rows["digest"] == groups["same"]) & large, "left")
    refers_to = F.when(~F.col("holder").eqNullSafe(F.col("page_id")), F.col("holder"))
    return joined.select("page_id", "url", "payload", "digest", refers_to.alias("refers_to"))


MANIFEST = "path string, size long, n_records long"


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write files under ``folder``; the rows of the result name those that count.

    Each attempt of a task writes files of new names, so a repeated task leaves at worst a file that nobody reads.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        done: list[tuple[str, int, int]] = []
        out, name, size, n = None, "", 0, 0

        def finish() -> None:
            if out is not None:
                out.close()
                done.append((f"{folder}/{name}", size, n))

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                if out is None or size > FILE_BYTES:
                    finish()
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                member = record(*row)
                out.write(member)
                size, n = size + len(member), n + 1
        finish()
        columns = list(zip(*done)) if done else [(), (), ()]
        kinds = [pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "size", "n_records"]
        )

    return records.mapInArrow(run, MANIFEST)


@dataclass
class _Member:
    start: int
    end: int
    data: bytes


class _Range:
    """Members of a file that start at or after ``start`` and before ``end``."""

    def __init__(self, source: pa.NativeFile, start: int, end: int, size: int):
        self.source, self.start, self.end, self.size = source, start, end, size
        self.held, self.at = b"", start  # bytes of the file from ``at`` on

    def _more(self) -> bool:
        place = self.at + len(self.held)
        if place >= self.size:
            return False
        self.source.seek(place)
        self.held += self.source.read(min(_CHUNK, self.size - place))
        return True

    def _drop(self, n: int) -> None:
        self.held, self.at = self.held[n:], self.at + n

    def _decode(self) -> _Member | None:
        """The member at ``at``, or None if there is none with a WARC header."""
        unpack, out, used = zlib.decompressobj(31), [], 0
        checked = False
        while not unpack.eof:
            if used == len(self.held) and not self._more():
                return None
            try:
                out.append(unpack.decompress(self.held[used:]))
            except zlib.error:
                return None
            used = len(self.held) - len(unpack.unused_data)
            if not checked and (unpack.eof or sum(map(len, out)) >= 7):
                if not b"".join(out).startswith(b"WARC/1."):
                    return None
                checked = True
        data = b"".join(out)
        return _Member(self.at, self.at + used, data) if b"\r\n\r\n" in data else None

    def members(self) -> Iterator[_Member]:
        while True:
            place = self.held.find(_MAGIC)
            if place < 0:
                self._drop(max(len(self.held) - len(_MAGIC) + 1, 0))
                if self.at >= self.end or not self._more():
                    return
                continue
            self._drop(place)
            if self.at >= self.end:
                return
            found = self._decode()
            if found is None:
                self._drop(1)
            else:
                yield found
                self._drop(found.end - found.start)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and the block of a decoded record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    return fields, rest[: int(fields["content-length"])]


RECORDS = (
    "path string, start long, record_type string, page_id long, refers_to long, header_digest string, "
    "header_length long, target_uri string, payload binary"
)


def _page(value: str | None) -> int | None:
    number = value.removeprefix("<urn:x-page:").removesuffix(">") if value else ""
    return int(number) if number else None


def read_archives(manifest: DataFrame, range_bytes: int = RANGE_BYTES, tasks: int = READ_TASKS) -> DataFrame:
    """All records of the files that ``manifest`` names, from byte ranges read side by side.

    There are as many tasks as ranges, up to ``tasks``. Their number is taken from the manifest (one row per file: pass
    a staged one) and given to Spark, which else would put the small rows that name the ranges together in one task.
    """
    n_ranges = manifest.agg(F.sum(F.ceil(F.col("size") / range_bytes))).first()[0] or 0
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(range_bytes)))
    ranges = manifest.filter("size > 0").select("path", "size", starts.alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        kinds += [pa.string(), pa.binary()]
        names = [x.split()[0] for x in RECORDS.split(", ")]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for path, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "size", "start"))):
                system, place = _open(path)
                rows, held = [], 0
                with system.open_input_file(place) as source:
                    for member in _Range(source, start, min(start + range_bytes, size), size).members():
                        fields, block = parse(member.data)
                        rows.append(
                            (
                                path,
                                member.start,
                                fields["warc-type"],
                                _page(fields["warc-record-id"]),
                                _page(fields.get("warc-refers-to")),
                                fields["warc-payload-digest"].removeprefix("sha1:"),
                                int(fields["x-payload-length"]),
                                fields.get("warc-target-uri"),
                                block,
                            )
                        )
                        held += len(block)
                        if held > 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return ranges.repartition(max(1, min(int(n_ranges), tasks))).mapInArrow(run, RECORDS)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    with tables.Staging(spark, "warc") as staging:
        folder = staging.folder("archives")
        manifest = write_archives(plan_records(tables.table(spark, sf_dir, "pages")), folder)
        manifest = staging.put(manifest, "manifest", keep=True)
        staging.keep(folder)
    found = read_archives(manifest)
    whole = F.col("record_type") == "response"
    return found.select(
        "page_id",
        F.when(whole, F.octet_length("payload")).otherwise(F.col("header_length")).cast("long").alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.col("header_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


ORACLE_SQL = """
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest
  FROM pages
), groups AS (
  SELECT digest, max(page_id) AS holder FROM rows WHERE n >= 1000 GROUP BY digest
)
SELECT page_id, n AS payload_bytes, rows.digest AS payload_digest,
  CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM rows LEFT JOIN groups ON rows.digest = groups.digest AND n >= 1000
"""
