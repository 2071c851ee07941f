"""WARC archives: one gzip member for each record, written and read in sequence.

The writer makes a response record for the first page of each payload and
revisit records for the others. The reader inflates a file piece by piece,
frames records by their content length and checks every digest, so its memory
does not grow with the file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tallyframe.llm.shared import make_folder, new_folder, open_path
from tallyframe.plans.lineage import materialize

VERSION = b"WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_BYTES = 512 << 20
READ_BYTES = 1 << 18
MOST_HEADER_BYTES = 1 << 20
GZIP = 16 + zlib.MAX_WBITS


def digest_text(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


# -- writing --------------------------------------------------------------


def _safe(value: str) -> str:
    """Percent-encode what would end a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(kind: str, record_id: str, url: str | None, payload: bytes, sha1: bytes, refers_to: str | None) -> bytes:
    """One record as a gzip member. ``payload`` is always whole; a revisit keeps only its HTTP header."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    lines = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", _safe(url))] if url else []),
        *([("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", PROFILE)] if refers_to else []),
        ("WARC-Payload-Digest", f"sha1:{digest_text(sha1)}"),
        ("WARC-Block-Digest", f"sha1:{digest_text(hashlib.sha1(block).digest())}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n"
    member = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return member.compress(head + block + b"\r\n\r\n") + member.flush()


def _page_uri(page_id: int | None, nth: int, sha1: bytes) -> str:
    """A name for one record: ids may repeat, with one payload or several."""
    return f"urn:page:{'' if page_id is None else page_id}:{nth}:{sha1.hex()[:16]}"


def _write_archives(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_path(folder)
        name, out, count, done = "", None, 0, []
        try:
            for batch in batches:
                for page_id, nth, url, first, revisit, html in zip(*(batch.column(i) for i in range(6))):
                    if out is None:
                        # A repeated task writes other files; only those listed by the one that counts are read.
                        name, count = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    payload = (html.as_py() or "").encode()
                    again, sha1 = revisit.as_py(), hashlib.sha1(payload).digest()
                    out.write(
                        record(
                            "revisit" if again else "response", _page_uri(page_id.as_py(), nth.as_py(), sha1), url.as_py(),
                            payload, sha1, _page_uri(first.as_py(), 0, sha1) if again else None,
                        )
                    )
                    count += 1
                    if out.tell() >= ARCHIVE_BYTES:
                        out.close()
                        out = None
                        done.append((name, count))
        finally:
            if out is not None:
                out.close()
        if out is not None:
            done.append((name, count))
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in ((0, pa.string()), (1, pa.int64()))], names=["file", "records"])

    return write


def write_warc(pages: DataFrame, folder: str) -> str:
    """Archive ``pages`` (``page_id``, ``url``, ``html``) under ``folder``.

    Of the pages with one payload, that with the least page_id is the response
    and the others revisit it; a null page_id comes after all others, and of
    equal rows one is the response. A null html is an empty payload, a null
    url leaves out the target. An empty table makes no archive. Other columns
    are ignored.
    """
    make_folder(f"{folder}/archives")
    html = F.coalesce("html", F.lit(""))
    id_text = F.coalesce(F.col("page_id").cast("string"), F.lit(""))  # never null, so that a plain join finds it
    sha1 = F.sha1(F.encode(html, "utf-8"))
    keyed = pages.select("page_id", "url", html.alias("html"), id_text.alias("id_text"), sha1.alias("sha1"))
    ids = materialize(keyed.select("page_id", "id_text", "sha1"))
    firsts = ids.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    # Only pages whose payload occurs again are joined; equal rows are joined once.
    roles = ids.distinct().join(firsts.drop("n"), "sha1").select("id_text", "sha1", "first", F.lit(True).alias("shared"))
    # Window and join deal by the same keys, so the pages are shuffled once.
    numbered = keyed.withColumn("nth", F.row_number().over(W.partitionBy("id_text", "sha1").orderBy("url")) - 1)
    joined = numbered.join(roles, ["id_text", "sha1"], "left")
    revisit = F.col("shared").isNotNull() & (~F.col("page_id").eqNullSafe(F.col("first")) | (F.col("nth") > 0))
    rows = joined.select("page_id", "nth", "url", "first", revisit.alias("revisit"), "html")
    rows.mapInArrow(_write_archives(f"{folder}/archives"), "file string, records bigint").write.parquet(f"{folder}/list")
    return folder


# -- reading --------------------------------------------------------------


class Members:
    """Bytes of a file of gzip members, inflated as they are asked for."""

    def __init__(self, read: Callable[[int], bytes]):
        self.read, self.raw, self.data, self.inflate = read, b"", b"", None

    def start(self) -> bool:
        """Begin the next member; False at the end of the file."""
        self.raw = self.raw or self.read(READ_BYTES)
        self.inflate = zlib.decompressobj(GZIP) if self.raw else None
        return self.inflate is not None

    def more(self) -> bool:
        """Inflate a bit more into ``data``; False where the member ends."""
        while not self.inflate.eof:
            if not self.raw and not self.inflate.unconsumed_tail:
                self.raw = self.read(READ_BYTES)
                if not self.raw:
                    raise ValueError("archive ends inside a record")
            part = self.inflate.decompress(self.inflate.unconsumed_tail or self.raw, READ_BYTES)
            self.raw = self.inflate.unused_data if self.inflate.eof else b""
            if part:
                self.data += part
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        """What stands before the mark, of any length: a header may hold a very long url."""
        held = bytearray(self.data)
        at = held.find(mark)
        while at < 0:
            self.data = b""
            if not self.more():
                raise ValueError("record header does not end")
            begin = max(0, len(held) - len(mark) + 1)
            held += self.data
            at = held.find(mark, begin)
        head, self.data = bytes(held[:at]), bytes(held[at + len(mark) :])
        return head

    def exactly(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes in pieces."""
        while size:
            if not self.data and not self.more():
                raise ValueError("record is shorter than its content length")
            part, self.data = self.data[:size], self.data[size:]
            size -= len(part)
            yield part

    def finish(self) -> None:
        """The two line ends that close a record must end the member."""
        while self.more():
            if len(self.data) > 4:
                break
        if self.data != b"\r\n\r\n":
            raise ValueError("record is longer than its content length")
        self.data = b""


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:]) if k}


def read_records(read: Callable[[int], bytes], keep_payload: bool) -> Iterator[dict]:
    """Records of one archive in order; a digest that does not hold raises ValueError."""
    members = Members(read)
    while members.start():
        head = members.until(b"\r\n\r\n")
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = _fields(head)
        size = int(fields["content-length"])
        whole, payload, kept, http, inner, seen = hashlib.sha1(), hashlib.sha1(), [], b"", None, 0
        web = fields.get("content-type", "").startswith("application/http")
        for part in members.exactly(size):
            whole.update(part)
            if web and inner is None:
                http += part
                at = http.find(b"\r\n\r\n")
                if at < 0:
                    if len(http) > MOST_HEADER_BYTES:
                        raise ValueError("HTTP header does not end")
                    continue
                inner, part = _fields(http[:at]), http[at + 4 :]
            payload.update(part)
            seen += len(part)
            if keep_payload:
                kept.append(part)
        members.finish()
        kind = fields.get("warc-type", "")
        said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        block = fields.get("warc-block-digest", "").removeprefix("sha1:")
        if block and block != digest_text(whole.digest()):
            raise ValueError(f"block digest of {fields.get('warc-record-id')} does not hold")
        if kind != "revisit" and said and said != digest_text(payload.digest()):
            raise ValueError(f"payload digest of {fields.get('warc-record-id')} does not hold")
        if kind == "revisit" and inner:
            seen = int(inner.get("content-length", seen))
        yield {
            "record_type": kind,
            "record_id": fields.get("warc-record-id", "").strip("<>"),
            "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            "target_uri": fields.get("warc-target-uri"),
            "payload_bytes": seen,
            "payload_digest": said or digest_text(payload.digest()),
            "payload": b"".join(kept) if keep_payload and kind != "revisit" else None,
        }


SCHEMA = pa.schema(
    [(n, pa.string()) for n in ("record_type", "record_id", "refers_to", "target_uri")]
    + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
)
COLUMNS = "record_type string, record_id string, refers_to string, target_uri string, payload_bytes bigint, payload_digest string, payload binary"


def _read_archives(folder: str, keep_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_path(folder)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                with system.open_input_stream(f"{root}/{file}", compression=None) as source:
                    rows, size = [], 0
                    for row in read_records(source.read, keep_payload):
                        rows.append(row)
                        size += len(row["payload"] or b"") + len(row["target_uri"] or "") + 200
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    return read


def read_warc(spark: SparkSession, folder: str, keep_payload: bool = True) -> DataFrame:
    """All records of the archives that :func:`write_warc` listed under ``folder``.

    Each archive is read by one task from start to end. A broken frame, a cut
    file or a wrong digest fails the job. Revisits give the length and digest
    of the payload they stand for, and no payload.
    """
    files = spark.read.parquet(f"{folder}/list").select("file")
    spread = files.repartition(max(1, files.count()))
    return spread.mapInArrow(_read_archives(f"{folder}/archives", keep_payload), COLUMNS)


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    records = read_warc(spark, write_warc(pages, new_folder(spark, "warc")), keep_payload=False)
    number = lambda c: F.expr(f"try_cast(split({c}, ':')[2] as bigint)")
    return records.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"), "target_uri",
    )
