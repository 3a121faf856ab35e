"""WARC archives with revisit records, read back and merged into capture histories."""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm.shared import cut, join_classes, partitions

#: Payloads below this many bytes are stored each time.
LEAST = 100
#: Records of an archive at most; one archive is one sorted run, and is read whole by one task.
RECORDS = 2000
#: Payloads of this many bytes or more go to archives of their own, ...
BIG = 128 << 10
#: ... of about so many bytes, or of one record, so that no archive is larger than this or ``RECORDS * BIG``.
ARCHIVE = 256 << 20
#: Rows of a range of the index that one task merges.
RANGE = 200_000
CRLF = "\r\n"


def url_key(url: Column) -> Column:
    """Sort key of a URL: the host's labels from the last to the first, then path and query; no URL gives ''."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    rest = F.concat(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), F.coalesce(F.concat(F.lit("?"), F.try_parse_url(url, F.lit("QUERY"))), F.lit("")))
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    return F.coalesce(key, F.lower(url), F.lit(""))


def _header(*lines: Column) -> Column:
    """Header lines, null ones left out, and the empty line after them."""
    return F.concat(F.array_join(F.array_compact(F.array(*lines)), CRLF), F.lit(CRLF * 2))


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def records(pages: DataFrame, id_col: str, url_col: str, text_col: str, time_col: str) -> DataFrame:
    """``(key, date, tie, size, record)``: the text of a WARC record for every row.

    Of records with equal payloads of :data:`LEAST` bytes or more the one with the
    smallest id is a response; the others revisit it and hold no payload. Key, date and
    tie are made from what the header holds: the escaped URL, the second and the id.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    url = F.col(url_col).cast("string")
    for sign, code in ((" ", "%20"), ("\t", "%09"), ("\r", "%0D"), ("\n", "%0A")):
        url = F.replace(url, F.lit(sign), F.lit(code))
    time = F.coalesce(F.col(time_col).cast("timestamp_ntz"), F.lit("1970-01-01").cast("timestamp_ntz"))
    base = pages.select(
        F.col(id_col).cast("long").alias("id"), url.alias("url"), text.alias("text"), F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
    ).withColumns({"size": F.octet_length("text").cast("long"), "digest": F.sha2(F.col("text").cast("binary"), 256)})
    first = base.select("id", "size", "digest").filter(F.col("size") >= LEAST).groupBy("digest").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    named = join_classes(base, first.filter("n > 1 AND least IS NOT NULL"), "digest", "n", {"least": "first"})
    again = F.coalesce(~F.col("id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("size").cast("string"), F.lit(CRLF * 2)
    )
    block = F.when(again, http).otherwise(F.concat(http, F.col("text")))
    only = lambda c: F.when(again, c)
    head = _header(
        F.lit("WARC/1.1"),
        _field("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _field("WARC-Record-ID", name(F.col("id"))),
        _field("WARC-Date", F.col("date")),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        only(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        only(_field("WARC-Refers-To", name(F.col("first")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        _field("Content-Length", F.octet_length(block).cast("string")),
    )
    return named.select(url_key(F.col("url")).alias("key"), "date", _tie().alias("tie"), "size", F.concat(head, block).alias("record"))


def _tie() -> Column:
    """Order of records of one URL and second: by id, those without one first."""
    return F.coalesce("id", F.lit(-(1 << 63)))


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", time_col: str = "time", most: int = RECORDS,
) -> None:
    """Gzipped WARC 1.1 files below ``path``, each sorted by URL key, second and id.

    The record text is written as it is; the two line ends that close a record are
    the separator of the text writer, so any file system that Spark writes to will do. Pages of
    :data:`BIG` bytes or more are written apart, fewer to an archive.
    """
    made = records(pages, id_col, url_col, text_col, time_col)
    size = F.octet_length(F.col(text_col).cast("string")).cast("long")
    largest = pages.agg(F.max(size)).first()[0] or 0

    def write(rows: DataFrame, most: int) -> None:
        out = rows.sortWithinPartitions("key", "date", "tie").select("record").write.mode("append")
        out.option("lineSep", CRLF * 2).option("maxRecordsPerFile", most).text(path, compression="gzip")

    write(made.filter(F.col("size") < BIG), most)
    if largest >= BIG:
        write(made.filter(F.col("size") >= BIG), max(1, min(most, ARCHIVE // largest)))


def parse(data: bytes) -> Iterator[tuple]:
    """(offset, length, type, id, uri, date, payload bytes, payload digest, refers to) of each record.

    A response's payload is digested again; a digest that differs from the header's is an error.
    """
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(CRLF)
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        start, size = end + 4, int(head["Content-Length"])
        close = data.index(b"\r\n\r\n", start) + 4
        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
        if head["WARC-Type"] == "response":
            payload = memoryview(data)[close : start + size]
            n = len(payload)
            if sha256(payload).hexdigest() != digest:
                raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
        else:
            http = dict(line.split(": ", 1) for line in data[start : close - 4].decode().split(CRLF)[1:])
            n = int(http["Content-Length"])
        stop = start + size + 4
        yield at, stop - at, head["WARC-Type"], head["WARC-Record-ID"], head.get("WARC-Target-URI"), head["WARC-Date"], n, digest, head.get("WARC-Refers-To")
        at = stop


def _number(urn: str | None) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">") if urn else "null"
    return None if text == "null" else int(text)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The index of all records below ``path``, in the order of each archive; offsets are those of the unpacked archive."""
    schema = "run string, record_offset long, record_length long, record_type string, id long, url string, date string, payload_bytes long, payload_digest string, refers_to long"
    names = [part.split()[0] for part in schema.split(", ")]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for file, content in zip(batch.column(0), batch.column(1)):
                rows = [(file.as_py(), a, n, kind, _number(i), url, date, size, digest, _number(to)) for a, n, kind, i, url, date, size, digest, to in parse(gzip.decompress(content.as_py()))]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


class LoserTree:
    """k-way merge of sorted runs: inner nodes keep the loser of their match, the root's winner is taken next."""

    def __init__(self, runs: list[list]):
        self.runs = runs
        self.place = [0] * len(runs)
        self.k = max(1, len(runs))
        self.loser = [-1] * self.k
        for r in range(len(runs)):
            self._play(r)

    def _less(self, a: int, b: int) -> bool:
        """Whether run a's next item comes first; an ended run comes last, equal items go by run."""
        x, y = self.runs[a], self.runs[b]
        if self.place[a] >= len(x) or self.place[b] >= len(y):
            return self.place[a] < len(x)
        mine, other = x[self.place[a]], y[self.place[b]]
        return mine < other or (mine == other and a < b)

    def _play(self, r: int) -> None:
        """Send run ``r`` up from its leaf; an empty node keeps it until its other side has played."""
        winner, node = r, (r + self.k) // 2
        while node > 0:
            held = self.loser[node]
            if held == -1:
                self.loser[node] = winner
                return
            if self._less(held, winner):
                self.loser[node], winner = winner, held
            node //= 2
        self.loser[0] = winner

    def __iter__(self):
        while self.runs:
            r = self.loser[0]
            if self.place[r] >= len(self.runs[r]):
                return
            yield self.runs[r][self.place[r]]
            self.place[r] += 1
            self._play(r)


def _merge(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of the index: its rows by run, each run in its order, merged."""
    got = [b for b in source if b.num_rows]
    if not got:
        return
    table = pa.Table.from_batches(got).combine_chunks()
    keys = list(zip(table["key"].to_pylist(), table["date"].to_pylist(), table["tie"].to_pylist(), range(table.num_rows)))
    runs: dict[str, list] = {}
    for run, offset, key in zip(table["run"].to_pylist(), table["record_offset"].to_pylist(), keys):
        runs.setdefault(run, []).append((offset, key))
    sorted_ = [[k for _, k in sorted(r)] for _, r in sorted(runs.items())]
    if any(a[:3] > b[:3] for r in sorted_ for a, b in zip(r, r[1:])):
        raise ValueError("an archive is not sorted")
    order = np.fromiter((k[3] for k in LoserTree(sorted_)), np.int64, table.num_rows)
    yield from table.take(pa.array(order)).to_batches(max_chunksize=10_000)


def histories(index: DataFrame) -> DataFrame:
    """The index in global order of URL key, capture time and id.

    The sorted runs are cut at common bounds (a hot URL is cut by time and id, too),
    and each range is one task's loser-tree merge of its pieces of all runs.
    """
    keyed = cut(index.withColumns({"key": url_key(F.col("url")), "tie": _tie()}))
    ranges = max(partitions(index.sparkSession), -(-keyed.count() // RANGE))
    ranged = keyed.repartitionByRange(ranges, "key", "date", "tie")
    return ranged.mapInArrow(_merge, ranged.schema).drop("tie")


def archive_pages(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", time_col: str = "time",
) -> DataFrame:
    """Write archives below ``path``, read them back and return one row per page in capture order:

    ``(id_col, payload_bytes, payload_digest, record_type, refers_to, url_key, date, run, record_offset, record_length)``.
    A null text is an empty payload, a null URL has no URI line and sorts first, a
    null time is 1970; a null id is never referred to while an equal payload has an
    id; repeated rows with one id are responses each. An empty table gives no rows.
    """
    write_archives(pages, path, id_col, url_col, text_col, time_col)
    merged = histories(read_archives(pages.sparkSession, path))
    return merged.select(
        F.col("id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to", F.col("key").alias("url_key"), "date", "run", "record_offset", "record_length"
    )
