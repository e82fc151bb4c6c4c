r"""WARC archives of captured pages, and their merged capture index.

``write`` renders one record per page and writes gzipped archives with Spark's
text writer, whose line end is set to the two line ends that close a record,
so archives can lie in any store that Spark writes.  Of pages with equal
payloads (SHA-1 of the UTF-8 bytes) the one with the largest page_id becomes a
response record, the others revisit records that refer to it and hold no payload.

``read`` parses the archives by their content lengths and checks each payload
against its digest.  Every archive yields a run of index entries, sorted by URL
key (host reversed, scheme dropped), capture time and page_id.

``merge`` brings the runs together: key ranges are dealt to tasks, and each task
merges the pieces of the runs that fall into its range with a loser tree, so
that the index as a whole is in order.  Ranges cover time and page_id as well,
so the captures of one URL can fill several tasks.

Edge cases: null html is an empty payload, null url an empty target; a null
page_id is written as such and leads only payloads that no page with an id has;
pages with the largest id of their payload are all responses, also if rows
repeat; control characters in URLs are percent-encoded; an empty table gives
no rows; columns other than page_id, url and html are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import cut_lineage

#: Payloads shorter than this are never revisits.
MIN_BYTES = 0
#: Records in one archive at most.
ARCHIVE_RECORDS = 5000
#: Capture times count seconds from here, for tables without a time.
FIRST_CAPTURE = datetime(2020, 1, 1, tzinfo=timezone.utc)
#: Ids wrap after this many seconds, to stay within the calendar.
CAPTURE_SPAN = 10 ** 9

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_digest(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def captured_at(page_id: int | None) -> str:
    return (FIRST_CAPTURE + timedelta(seconds=(page_id or 0) % CAPTURE_SPAN)).strftime("%Y-%m-%dT%H:%M:%SZ")


def url_key(url: str) -> str:
    """Sort key of a URL: reversed host, path and query, without scheme, default port or fragment."""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url
    if not host:
        return url
    host = host.removeprefix("www.")
    shown = "" if port in (None, 80, 443) else f":{port}"
    return ",".join(reversed(host.split("."))) + shown + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def record(page_id, url, payload: bytes, sha1_hex: str, leader, is_response: bool) -> bytes:
    """A whole record without the two line ends that close it."""
    url = _CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", url or "")
    kind = "response" if is_response else "revisit"
    block = _HTTP + payload if is_response else _HTTP
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {captured_at(page_id)}",
            f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{base32_digest(sha1_hex)}", f"X-Payload-Length: {len(payload)}"]
    if not is_response:
        head += [f"WARC-Refers-To: <urn:page:{leader}>", f"WARC-Profile: {_REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block


def _render(batches):
    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("page_id", "url", "digest", "leader", "is_response")]
        payloads = b.column("html").cast(pa.binary()).to_pylist()
        made = [record(i, u, p, d, lead, r) for (i, u, d, lead, r), p in zip(zip(*cols, strict=True), payloads, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary()).cast(pa.string())], ["value"])


def write(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Archive every page below `path`."""
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    src = src.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    same = src.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("leader"), F.count("*").alias("n"))
    same = cut_lineage(same.where("n > 1").select("digest", "leader"))
    chosen = src.join(same, "digest", "left").withColumn(
        "is_response", F.col("leader").isNull() | F.coalesce(F.col("page_id") == F.col("leader"), F.lit(False)))
    (chosen.select("page_id", "url", "html", "digest", "leader", "is_response").mapInArrow(_render, "value string")
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", ARCHIVE_RECORDS).text(path))


def records(archive: bytes):
    """(offset, headers, block) of each record of an unpacked archive."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins at {at}")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        size = int(head["Content-Length"])
        yield at, head, archive[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def _id(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


_INDEX = "run string, url_key string, captured string, page_id long, offset long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _parse(batches):
    names = [x.split()[0] for x in _INDEX.split(", ")]
    kinds = [pa.int64() if x.endswith("long") else pa.string() for x in _INDEX.split(", ")]
    for b in batches:
        for path, data in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
            rows = []
            for offset, head, block in records(zlib.decompress(data.as_py(), wbits=47)):
                digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"])
                if head["WARC-Type"] == "response":
                    payload = block.partition(b"\r\n\r\n")[2]
                    if len(payload) != size or base32_digest(hashlib.sha1(payload).hexdigest()) != digest:
                        raise ValueError(f"{path}: the payload at {offset} differs from its digest")
                rows.append((path, url_key(head["WARC-Target-URI"]), head["WARC-Date"], _id(head["WARC-Record-ID"]), offset,
                             size, digest, head["WARC-Type"], _id(head.get("WARC-Refers-To"))))
            rows.sort(key=_order)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 9, kinds, strict=True)], names)


def _order(row) -> tuple:
    """Order of index entries: URL key (in UTF-8), time, page_id with null first, archive and offset."""
    return row[1].encode("utf-8", "surrogatepass"), row[2], (row[3] is not None, row[3] or 0), row[0], row[4]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The runs: an index entry for each record of the archives, sorted within each archive."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(_parse, _INDEX)


class LoserTree:
    """Merges k sorted sequences: each inner node keeps the loser of the match
    below it, so the next winner takes one match per level."""

    def __init__(self, runs: list[list]):
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.losers = [-1] * max(self.k, 1)
        for run in range(self.k):
            self._play(run)

    def _beats(self, a: int, b: int) -> bool:
        """Whether the head of run a comes before that of run b; ended runs come last."""
        if self.at[a] >= len(self.runs[a]):
            return False
        if self.at[b] >= len(self.runs[b]):
            return True
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return x < y or (x == y and a < b)

    def _play(self, run: int) -> None:
        """Carry a run up from its leaf; while building, the first to reach a node waits there."""
        node, winner = (run + self.k) // 2, run
        while node > 0:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.winner = winner

    def __iter__(self):
        """(run, position) in merged order."""
        while self.k and self.at[self.winner] < len(self.runs[self.winner]):
            run = self.winner
            yield run, self.at[run]
            self.at[run] += 1
            self._play(run)


def _merge_runs(batches):
    """Merge the run pieces of a partition, which come one after another, each in order."""
    held = [b for b in batches if len(b)]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    names = table.column("run").to_pylist()
    rows = list(zip(*(table.column(c).to_pylist() for c in table.column_names), strict=True))
    begin = [k for k in range(len(names)) if k == 0 or names[k] != names[k - 1]]
    pieces = [[_order(r) for r in rows[a:b]] for a, b in zip(begin, [*begin[1:], len(rows)], strict=True)]
    order = [begin[run] + at for run, at in LoserTree(pieces)]
    for lo in range(0, len(order), 10_000):
        yield from table.take(pa.array(order[lo : lo + 10_000])).to_batches()


def merge(runs: DataFrame) -> DataFrame:
    """The index in order of URL key, time and page_id, over all partitions."""
    keys = ["url_key", "captured", "page_id", "run", "offset"]
    dealt = runs.repartitionByRange(*keys).sortWithinPartitions("run", *keys[:3], "offset")
    return dealt.mapInArrow(_merge_runs, _INDEX)
