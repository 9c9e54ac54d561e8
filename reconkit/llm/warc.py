"""WARC archives: one record a page, written as gzip text files and read back segment by segment.

Writing.  Pages become ``response`` records whose HTTP body is framed as chunks.  Of pages
with equal payloads of at least ``REPEAT_BYTES`` the one with the largest (id, url) is the
response; the others become ``revisit`` records that refer to it.  A block above
``SEGMENT_BYTES`` is cut: the first part stands in the response, the others in
``continuation`` records with the origin's id, a segment number and, in the last, the
total length.  Spark's text sink writes the files, with the record end as line end, so
commits, retries and remote folders are Spark's business.

Reading.  A gzip file can't be split, so a task meets whole files in order, as lines that
end like records do; it joins them again and walks from record to record by their stated
lengths, holding one record at a time.  Blocks that are cut go by their origin's id to one
place, ordered by segment number, and run through the chunk decoder one after another:
a payload of any size is measured and digested without being held.

Defined results: null html is an empty payload; a null id or url is left out of the
headers and comes back as null; rows that repeat id, url and payload are one response and
revisits from ``REPEAT_BYTES`` on, responses below; no pages give no rows.  A payload that is
not whole comes back with the reason in ``problem``, never in silence.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from reconkit.llm.common import slices, stored

# fixed values: line ends, record ends and version of the format
LINE, END, VERSION = b"\r\n", b"\r\n\r\n", b"WARC/1.1"
REPEAT_BYTES = 1000  # payloads from here on are archived once
SEGMENT_BYTES = 16 << 10  # of a record's block
CHUNK_BYTES = 4 << 10  # of a payload in one transfer chunk
BROADCAST_ROWS = 1 << 17  # of repeated payloads, some 100 bytes each
BATCH_BYTES = 1 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_HEAD = "record_id string, type string, url string, page_id long, refers_to_record string, payload_sha1 string"
RECORD = _HEAD + ", origin string, segment int, total long, block binary"
_FIGURES = ", payload_bytes long, payload_digest string, problem string"


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hex=name[:32])}>"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in transfer chunks, with the empty chunk that ends them."""
    parts = []
    for i in range(0, len(payload), size):
        some = payload[i : i + size]
        parts += [b"%x" % len(some), LINE, some, LINE]
    return b"".join([*parts, b"0", END])


class Unchunker:
    """Decodes transfer chunks that come in pieces cut anywhere."""

    def __init__(self) -> None:
        self.pending, self.left, self.state, self.broken = b"", 0, "size", False

    def feed(self, data: bytes) -> Iterator[bytes]:
        data, at = self.pending + data, 0
        self.pending = b""
        while at < len(data) and not self.broken:
            if self.state == "data":
                some = data[at : at + self.left]
                at, self.left = at + len(some), self.left - len(some)
                yield some
                self.state = "data" if self.left else "after"
                continue
            stop = data.find(LINE, at)
            if stop < 0:
                self.pending = data[at:]
                return
            line, at = data[at:stop], stop + 2
            if self.state == "size":
                try:
                    self.left = int(line.split(b";")[0], 16)
                except ValueError:
                    self.broken = True
                    return
                self.broken = self.left < 0
                self.state = "data" if self.left else "trailer"
            elif self.state == "after":
                self.broken, self.state = bool(line), "size"
            elif self.state == "trailer":
                self.state = "trailer" if line else "end"
            else:
                self.broken = True

    @property
    def whole(self) -> bool:
        return self.state == "end" and not self.broken and not self.pending


class Payload:
    """The HTTP body of one record from the pieces of its block: size, SHA-1 and, if asked for, bytes."""

    def __init__(self, keep: bool) -> None:
        self.head, self.decoder, self.n, self.sha1 = b"", None, 0, hashlib.sha1()
        self.kept = [] if keep else None

    def feed(self, block: bytes) -> None:
        if self.head is not None:
            self.head += block
            head, found, block = self.head.partition(END)
            if not found:
                return
            fields = _fields(head)
            self.decoder = Unchunker() if fields.get("transfer-encoding", "").lower() == "chunked" else None
            self.head = None
        for some in self.decoder.feed(block) if self.decoder else [block]:
            self.n += len(some)
            self.sha1.update(some)
            if self.kept is not None:
                self.kept.append(some)

    def told(self, stated: str | None, problem: str | None = None) -> dict[str, object]:
        """Figures of the payload, and the first thing that is wrong with it."""
        found = self.sha1.hexdigest()
        if self.head is not None:
            problem = problem or "no http header"
        elif self.decoder and not self.decoder.whole:
            problem = problem or "chunks"
        elif stated not in (None, found):
            problem = problem or "digest"
        row = {"payload_bytes": self.n, "payload_digest": found, "problem": problem}
        return row if self.kept is None else row | {"payload": b"".join(self.kept)}


class _Segments:
    """One payload from its segments in order; told under the origin's id if the first is missing."""

    def __init__(self, key: str, keep: bool) -> None:
        self.key, self.body, self.problem = key, Payload(keep), None
        self.first, self.last, self.length, self.total = {"record_id": key, "type": "response"}, 0, 0, None

    def feed(self, row: dict) -> None:
        if row["segment"] == 1:
            self.first = row
        if row["segment"] != self.last + 1:
            self.problem = "segments"
        self.last, self.length = row["segment"], self.length + len(row["block"])
        self.total = row["total"] if row["total"] is not None else self.total
        self.body.feed(row["block"])

    def row(self) -> dict[str, object]:
        problem = self.problem or ("length" if self.total != self.length else None)
        return self.first | self.body.told(self.first.get("payload_sha1"), problem)


def _fields(head: bytes) -> dict[str, str]:
    """Header fields under lower-case names; the first line is not one."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _head(kind: str, length: int, *fields: tuple[str, object]) -> bytes:
    lines = [VERSION, b"WARC-Type: " + kind.encode(), *(f"{k}: {v}".encode() for k, v in fields if v is not None), b"Content-Length: %d" % length]
    return LINE.join(lines) + END


def _one_line(url: str | None) -> str | None:
    return None if url is None else " ".join(url.split("\r\n"))


def response_records(name: str, page: int | None, url: str | None, payload: bytes, segment: int) -> Iterator[bytes]:
    """A response and its continuations, without the record ends."""
    block = _HTTP + b"Transfer-Encoding: chunked" + END + chunked(payload)
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    own = record_id(name)
    common = [("WARC-Record-ID", own), ("WARC-Target-URI", _one_line(url)), ("Page-Id", page), ("WARC-Payload-Digest", digest)]
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    number = [("WARC-Segment-Number", 1)] if len(parts) > 1 else []
    yield _head("response", len(parts[0]), *common, *number, ("Content-Type", "application/http; msgtype=response")) + parts[0]
    for i, part in enumerate(parts[1:], 2):
        more = record_id(hashlib.sha1(f"{name}/{i}".encode()).hexdigest())
        total = len(block) if i == len(parts) else None
        yield _head(
            "continuation", len(part), ("WARC-Record-ID", more), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", i),
            ("WARC-Segment-Total-Length", total),
        ) + part


def revisit_record(name: str, page: int | None, url: str | None, target: str, sha1: str) -> bytes:
    block = _HTTP + LINE
    digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()
    return _head(
        "revisit", len(block), ("WARC-Record-ID", record_id(name)), ("WARC-Target-URI", _one_line(url)), ("Page-Id", page),
        ("WARC-Payload-Digest", digest), ("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(target)),
        ("Content-Type", "application/http; msgtype=response"),
    ) + block


def write_archive(
    pages: DataFrame, path: str, id_col="page_id", url_col="url", html_col="html", repeat: int = REPEAT_BYTES, segment: int = SEGMENT_BYTES,
) -> None:
    """Write one record for each row of ``pages`` to ``path``; continuations come on top.

    Only ids, addresses and digests are shuffled to find repeated payloads; the payloads
    meet them by a broadcast where at most ``BROADCAST_ROWS`` of them repeat, else by a join.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), F.encode(F.coalesce(html_col, F.lit("")), "UTF-8").alias("payload")
    ).withColumn("sha1", F.sha1("payload"))
    each = rows.filter(F.length("payload") >= repeat).groupBy("sha1", "page", "url").agg(F.count("*").alias("n"))
    best = each.groupBy("sha1").agg(F.max(F.struct("page", "url", "n")).alias("best"), F.sum("n").alias("rows")).filter("rows > 1")
    best = stored(best.select(F.col("sha1").alias("of"), "best"), "repeated")
    few = best.count() <= BROADCAST_ROWS
    met = rows.join(F.broadcast(best) if few else best, (F.col("sha1") == F.col("of")) & (F.length("payload") >= repeat), "left")
    again = F.col("of").isNotNull()
    first = again & F.col("page").eqNullSafe(F.col("best.page")) & F.col("url").eqNullSafe(F.col("best.url"))
    revisit = again & ~first
    # the response that revisits refer to is named by its payload, so both sides know the name
    own = F.when(first, F.col("sha1")).otherwise(F.sha1(F.concat_ws("/", F.expr("uuid()"), "sha1")))
    columns = ["page", "url", "sha1"]
    records = met.filter(~(first & (F.col("best.n") > 1)) | ~again).select(
        own.alias("name"), *columns, F.when(~revisit, F.col("payload")).alias("payload"), F.when(revisit, F.col("sha1")).alias("target")
    )
    same = best.filter("best.n > 1").select(F.col("of").alias("sha1"), "best.*")
    if not same.isEmpty():
        # rows equal in all three: one is the response, the rest are made from their count
        one = met.filter(first & (F.col("best.n") > 1)).dropDuplicates(["sha1"])
        one = one.select(F.col("sha1").alias("name"), *columns, "payload", F.lit(None).cast("string").alias("target"))
        block = same.withColumn("block", F.explode(F.expr("sequence(0L, (n - 2) div 4096)")))
        copies = block.withColumn("copy", F.explode(F.expr("sequence(1L, least(4096L, n - 1 - block * 4096))")))
        named = F.sha1(F.concat_ws("/", "sha1", "block", "copy", F.lit("copy")))
        copies = copies.select(named.alias("name"), *columns, F.lit(None).cast("binary").alias("payload"), F.col("sha1").alias("target"))
        records = records.unionByName(one).unionByName(copies)

    def run(batches):
        for batch in slices(batches, "payload"):
            out, held = [], 0
            for name, page, url, sha1, payload, target in zip(*(c.to_pylist() for c in batch.columns)):
                new = [revisit_record(name, page, url, target, sha1)] if target else response_records(name, page, url, payload, segment)
                for one in new:
                    out.append(one)
                    held += len(one)
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    values = records.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    values.write.option("lineSep", END.decode()).option("compression", "gzip").text(path)


class _Walk:
    """Cuts the bytes of one file into records."""

    def __init__(self, file: str) -> None:
        self.file, self.parts, self.size, self.need, self.head = file, [], 0, 0, None

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self.parts.append(data)
        self.size += len(data)
        if self.head is not None and self.size < self.need:
            return  # bytes are joined once a record is whole
        held, at = b"".join(self.parts), 0
        while True:
            if self.head is None:
                while held[at : at + 2] == LINE:
                    at += 2
                stop = held.find(END, at)
                if stop < 0:
                    break
                if not held.startswith(b"WARC/", at):
                    raise ValueError(f"no record where one should start in {self.file}")
                self.head = _fields(held[at:stop])
                self.need, at = int(self.head["content-length"]), stop + 4
            if len(held) - at < self.need:
                break
            yield self.head, held[at : at + self.need]
            self.head, at = None, at + self.need
        self.parts, self.size = [held[at:]], len(held) - at

    def close(self) -> None:
        if self.head is not None or b"".join(self.parts).strip(LINE):
            raise ValueError(f"the last record of {self.file} is cut short")


def _digest(text: str | None) -> str | None:
    """SHA-1 in hexadecimal from a digest field, or nothing for other digests."""
    if not text or not text.lower().startswith("sha1:"):
        return None
    value = text[5:]
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def read_records(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """All records below ``path``: ids, type, address, segment fields and the block.

    Files are gzip (``.gz``), which Spark never splits.  For other files set ``whole_files``:
    each is then one row, so it must fit in memory.
    """
    lines = spark.read.text(path, wholetext=True) if whole_files else spark.read.text(path, lineSep=END.decode())
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    schema = _arrow(RECORD)

    def number(text):
        return None if text is None else int(text)

    def run(batches):
        walk, out, held = None, [], 0

        def full():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

        for batch in batches:
            for file, value in zip(batch["file"].to_pylist(), batch["value"].to_pylist()):
                if walk is None or walk.file != file:
                    if walk:
                        walk.close()
                    walk = _Walk(file)
                for head, block in walk.feed(value + END):
                    get = head.get
                    out.append((
                        get("warc-record-id"), get("warc-type"), get("warc-target-uri"), number(get("page-id")), get("warc-refers-to"),
                        _digest(get("warc-payload-digest")), get("warc-segment-origin-id"), number(get("warc-segment-number")),
                        number(get("warc-segment-total-length")), block,
                    ))
                    held += len(block)
                    if held > BATCH_BYTES:
                        yield full()
                        out, held = [], 0
        if walk:
            walk.close()
        if out:
            yield full()

    return lines.mapInArrow(run, RECORD)


def reassembled(records: DataFrame, keep_payload: bool = False) -> DataFrame:
    """One row for each response or revisit: ids, ``payload_bytes``, ``payload_digest`` and ``problem``.

    Blocks in one record are decoded where they are read; only segments are shuffled with
    their bytes, to be taken in order by (origin, segment number), one at a time.  With
    ``keep_payload`` the decoded bytes come too, and are held for one record at a time.
    ``problem`` is null or says why a payload can't be trusted: ``segments`` (a number missing
    or twice), ``length`` (total not met), ``chunks``, ``no http header`` or ``digest``.
    """
    single = RECORD + _FIGURES
    whole = _HEAD + _FIGURES + (", payload binary" if keep_payload else "")

    single_schema, whole_schema = _arrow(single), _arrow(whole)

    def decode(batches):
        for batch in slices(batches, "block"):
            out = []
            for row in batch.to_pylist():
                if row["segment"] is None:
                    block, row["block"] = row["block"], None
                    if row["type"] == "response":
                        body = Payload(keep_payload)
                        body.feed(block)
                        row |= body.told(row["payload_sha1"])
                        row["block"] = row.pop("payload", None)
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, single_schema)

    def join(batches):
        open_one = None
        for batch in slices(batches, "block"):
            out = []
            for row in batch.to_pylist():
                if row["segment"] is None:
                    out.append(row | {"payload": row["block"]})
                    continue
                key = row["origin"] or row["record_id"]
                if open_one is None or open_one.key != key:
                    if open_one:
                        out.append(open_one.row())
                    open_one = _Segments(key, keep_payload)
                open_one.feed(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, whole_schema)
        if open_one:
            yield pa.RecordBatch.from_pylist([open_one.row()], whole_schema)

    decoded = records.filter("segment is not null or type in ('response', 'revisit')").mapInArrow(decode, single)
    place = F.coalesce("origin", "record_id").alias("place")
    parts = decoded.select("*", place).repartition("place").sortWithinPartitions("place", "segment")
    return parts.drop("place").mapInArrow(join, whole)


def resolved(found: DataFrame) -> DataFrame:
    """Responses and revisits; a revisit gets its response's payload figures and page id (``refers_to``).

    A revisit of a record that is not there has null figures and the problem ``target``.
    """
    target = found.filter("type = 'response'").select(
        F.col("record_id").alias("_target"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest")
    )
    joined = found.join(target, F.col("refers_to_record") == F.col("_target"), "left")
    revisit = F.col("type") == "revisit"
    lost = revisit & F.col("_target").isNull()
    changed = revisit & (F.col("payload_sha1") != F.col("_digest"))
    return joined.select(
        "page_id", "url",
        F.when(revisit, F.col("_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), F.when(revisit, F.col("_page")).alias("refers_to"),
        F.when(lost, "target").when(changed, "digest").otherwise(F.col("problem")).alias("problem"),
    )


def round_trip(pages: DataFrame, path: str, **options) -> DataFrame:
    """Write ``pages`` to an archive at ``path`` and tell each page from what is read back."""
    write_archive(pages, path, **options)
    return resolved(stored(reassembled(read_records(pages.sparkSession, path)), "reassembled"))
