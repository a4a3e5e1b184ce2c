"""WARC archives and their merged capture index.

Every record is a gzip member of its own, so one is read without those before
it. Members are written by Spark's own text writer: an empty gzip member is the
line separator, so archives lie in any store that Spark reaches, unpack with
any gzip reader, and a lost task leaves nothing behind. The index is an
external merge: every archive gives sorted runs, written once; they are cut at
slice borders, and a slice's runs meet in a loser tree that puts them out in
order of URL key and time.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import groupby
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions.scalar import quoted
from wardlens.llm.common import shuffle_partitions, slices, with_possible
from wardlens.session import durable

MIN_REVISIT = 100
_VERSION, _END = b"WARC/1.1\r\n", b"\r\n\r\n"
_RUN = 20_000
_LEVEL = 6
_READ = 1 << 16
_GZIP = 31  # window bits that ask for a gzip header and trailer
_HEADER_BYTES = 600  # of a record, about


def _clean(value: Column) -> Column:
    """A header value: line breaks would end it."""
    return F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"[\r\n]+", " ")


def records(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html",
            date: str | None = None, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """One ``value`` per page: a WARC response, or a revisit of an equal payload.

    Of the pages with equal payloads of at least ``min_bytes`` bytes, that with
    the least id is the response, the others refer to it. Pages that share the
    least id are all responses; null ids come last, and where no id is known
    all are responses. Null html is an empty payload; very long html is kept
    whole. An empty table gives no records, and columns beside those named are
    ignored. Only digests meet in the shuffle that finds the least id,
    pre-aggregated by task. Of the pages only those that a filter of the
    repeated digests lets through enter the join with them. Without a ``date``
    column a page's time is its id in seconds from 2000.
    """
    when = quoted(date).cast("timestamp") if date else F.timestamp_seconds(
        F.lit(946684800) + F.pmod(F.coalesce(quoted(page_id), F.lit(0)), F.lit(1 << 32)))
    rows = pages.select(quoted(page_id).cast("long").alias("id"), _clean(quoted(url)).alias("url"),
                        F.coalesce(quoted(html), F.lit("")).alias("html"),
                        F.date_format(F.to_utc_timestamp(when, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"))
    rows = (rows.withColumn("size", F.octet_length("html").cast("long"))
            .withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)))
    rows = rows.withColumn("hash", F.when(F.col("size") >= min_bytes, F.xxhash64("digest")))
    repeated = durable(
        rows.where(F.col("size") >= min_bytes).groupBy(F.col("digest").alias("of"))
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & F.col("first").isNotNull())
        .select("of", "first", F.xxhash64("of").alias("of_hash")), "repeated-digests")
    seen = with_possible(rows, "hash", repeated, "of_hash")
    met = seen.where("possible").join(repeated.drop("of_hash"), F.col("digest") == F.col("of"), "left").drop("of")
    joined = met.unionByName(seen.where("NOT possible").withColumn("first", F.lit(None).cast("long")))
    revisit = F.coalesce(F.col("first") != F.coalesce("id", F.lit(-1)), F.lit(False)) \
        | (F.col("first").isNotNull() & F.col("id").isNull())

    def name(x: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(x.cast("string"), F.lit("null")), F.lit(">"))

    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    refers = F.when(revisit, F.concat(
        F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
        name(F.col("first")))).otherwise(F.lit(""))
    return joined.select(F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: "), name(F.col("id")),
        F.lit("\r\nWARC-Target-URI: "), F.col("url"), F.lit("\r\nWARC-Date: "), F.col("at"),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.lit("\r\nX-Payload-Length: "), F.col("size").cast("string"), refers,
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit("\r\n\r\n"), http, body).alias("value"))


def member(data: bytes) -> bytes:
    """``data`` as one gzip member; equal data give equal members."""
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, _GZIP)
    return packer.compress(data) + packer.flush()


SEPARATOR = member(b"")


def _members(found: DataFrame) -> DataFrame:
    """Each record with its end mark as a gzip member."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, 0):
                packed = [member(r.encode("utf-8", "surrogatepass") + _END) for r in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], ["value"])

    return found.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))


def write(pages: DataFrame, folder: str, records_per_file: int = 2000, bytes_per_file: int = 64 << 20, **names) -> None:
    """Write the archives, at most ``records_per_file`` records in each.

    Where pages are long, fewer: as many as make ``bytes_per_file`` unpacked at
    the table's mean size, since a task reads an archive back as a whole.
    """
    html = quoted(names.get("html", "html"))
    mean = pages.agg(F.avg(F.coalesce(F.octet_length(html), F.lit(0))).alias("mean")).first()["mean"] or 0
    most = max(1, min(records_per_file, int(bytes_per_file / (mean + _HEADER_BYTES))))
    (_members(records(pages, **names)).write.mode("overwrite").option("compression", "none")
     .option("encoding", "ISO-8859-1").option("lineSep", SEPARATOR.decode("latin-1"))
     .option("maxRecordsPerFile", most).text(folder))


def unpack(data: bytes, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at a byte, and where it ends."""
    reader, parts = zlib.decompressobj(_GZIP), []
    while not reader.eof:
        chunk = data[at:at + _READ]
        if not chunk:
            raise ValueError("a gzip member is cut short")
        parts.append(reader.decompress(chunk))
        at += len(chunk)
    return b"".join(parts), at - len(reader.unused_data)


def record(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of an unpacked record; its length decides, never the content."""
    if not content.startswith(_VERSION):
        raise ValueError("no WARC record")
    stop = content.index(_END)
    lines = content[len(_VERSION):stop].decode().split("\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    body = stop + len(_END)
    end = body + int(headers["Content-Length"])
    if content[end:] != _END:
        raise ValueError("a WARC record does not end where its length says")
    return headers, content[body:end]


def parse(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset and length of each member of an archive, and the headers and block of its record."""
    at = 0
    while at < len(data):
        content, end = unpack(data, at)
        if content:
            yield at, end - at, *record(content)
        at = end


def url_key(url: str) -> str:
    """Sort key of a URL: host labels reversed, then port, path and query, in lower case."""
    try:
        parts = urlsplit(url if "//" in url else f"//{url}")
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{f':{port}' if port else ''}){parts.path or '/'}{query}".lower()


ENTRY = T.StructType([
    T.StructField("url_key", T.StringType()), T.StructField("captured_at", T.StringType()),
    T.StructField("page_id", T.LongType()), T.StructField("record_type", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("refers_to", T.LongType()), T.StructField("file", T.StringType()),
    T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])
_ENTRY_ARROW = pa.struct([(f.name, pa.int64() if isinstance(f.dataType, T.LongType) else pa.string()) for f in ENTRY])


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "null" else int(number)


def entries(file: str, data: bytes) -> Iterator[dict]:
    """Index entries of one archive; the payload of a response is checked against its digest."""
    for offset, length, headers, block in parse(data):
        digest, size = headers["WARC-Payload-Digest"].removeprefix("sha256:"), int(headers["X-Payload-Length"])
        kind = headers["WARC-Type"]
        if kind == "response":
            payload = block[block.index(_END) + len(_END):]
            digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
            if digest != headers["WARC-Payload-Digest"].removeprefix("sha256:"):
                raise ValueError(f"{file} at byte {offset}: the payload does not match its digest")
        yield {"url_key": url_key(headers["WARC-Target-URI"]), "captured_at": headers["WARC-Date"],
               "page_id": _page(headers["WARC-Record-ID"]), "record_type": kind, "payload_digest": digest,
               "payload_bytes": size, "refers_to": _page(headers["WARC-Refers-To"]) if kind == "revisit" else None,
               "file": file, "offset": offset, "length": length}


def order_of(entry: dict) -> tuple:
    """The index order: URL key, time, page (null last), place."""
    page = entry["page_id"]
    return (entry["url_key"], entry["captured_at"], page is None, page or 0, entry["file"], entry["offset"])


class LoserTree:
    """Merges sorted iterators: inner nodes hold the loser of their match, the root's winner goes out.

    Putting out the winner replays only its own path, one comparison a level.
    """

    def __init__(self, runs: Sequence[Iterator[tuple]]):
        self._runs = list(runs)
        self._heads = [next(r, None) for r in self._runs]
        self._losers = [-1] * len(self._runs)
        self._winner = self._play(1) if self._runs else -1

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._heads[a], self._heads[b]
        return y is None or (x is not None and (x[0], a) <= (y[0], b))

    def _play(self, node: int) -> int:
        n = len(self._runs)
        if node >= n:
            return node - n
        left, right = self._play(2 * node), self._play(2 * node + 1)
        winner, loser = (left, right) if self._beats(left, right) else (right, left)
        self._losers[node] = loser
        return winner

    def __iter__(self) -> Iterator:
        while self._winner >= 0 and self._heads[self._winner] is not None:
            run = self._winner
            yield self._heads[run][1]
            self._heads[run] = next(self._runs[run], None)
            node = (run + len(self._runs)) // 2
            while node:
                if self._beats(self._losers[node], run):
                    run, self._losers[node] = self._losers[node], run
                node //= 2
            self._winner = run


def _sorted_runs(files: DataFrame) -> DataFrame:
    """Sorted runs of every archive, one row per run: ``run, entries``."""
    def run(batches):
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = path.rsplit("/", 1)[-1]
                rows = sorted(entries(file, data), key=order_of)
                for i in range(0, len(rows), _RUN):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f"{file}#{i}"]), pa.array([rows[i:i + _RUN]], pa.list_(_ENTRY_ARROW))], ["run", "entries"])

    return files.mapInArrow(run, T.StructType([T.StructField("run", T.StringType()),
                                               T.StructField("entries", T.ArrayType(ENTRY))]))


def _borders(runs: DataFrame, number: int, per_slice: int = 40) -> list[tuple]:
    """Order keys that cut all captures into ``number`` slices, from about ``per_slice`` sampled captures for each.

    Captures are drawn by the hash of their place at a rate set by their
    number, so the driver holds a bounded list whatever the input.
    """
    if number < 2:
        return []
    total = runs.agg(F.sum(F.size("entries"))).first()[0]
    drawn = F.pmod(F.xxhash64("e.file", "e.offset"), F.lit(max(1, total // (number * per_slice)))) == 0
    found = runs.select(F.explode("entries").alias("e")).where(drawn).select(
        "e.url_key", "e.captured_at", "e.page_id", "e.file", "e.offset").collect()
    keys = sorted(order_of(r.asDict()) for r in found)
    return [keys[len(keys) * k // number] for k in range(1, number)] if keys else []


def _cut(runs: DataFrame, borders: Sequence[tuple]) -> DataFrame:
    """``slice, run, entries``: every run cut at the borders, found in it by binary search."""
    def run(batches):
        for batch in batches:
            for name, listed in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys = [order_of(e) for e in listed.as_py()]
                cuts = [0, *[bisect_left(keys, b) for b in borders], len(keys)]
                for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if b > a:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([s], pa.int32()), pa.array([name]),
                             pa.array([listed.values.slice(a, b - a).to_pylist()], pa.list_(_ENTRY_ARROW))],
                            ["slice", "run", "entries"])

    schema = T.StructType([T.StructField("slice", T.IntegerType()), *runs.schema.fields])
    return runs.mapInArrow(run, schema)


def merged_index(spark: SparkSession, folder: str, entries_per_slice: int = 20_000) -> DataFrame:
    """All captures of a folder of archives in index order: ``slice``, ``place`` in it, and the columns of ``ENTRY``.

    Slices are cut on the whole order key, so one URL with a large share of all
    captures spreads over many. A slice holds about ``entries_per_slice``
    entries, more where that would take more slices than the session has
    shuffle partitions; so the borders, one per slice and held by every task,
    are bounded by that setting. Archives are read once, each as a whole by its
    task. An empty folder gives an empty index.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
    found = durable(_sorted_runs(files), "capture-runs")
    captures = found.agg(F.sum(F.size("entries"))).first()[0] or 0
    number = max(1, min(shuffle_partitions(found), -(-captures // entries_per_slice)))
    borders = _borders(found, number)
    runs = _cut(found, borders).repartitionById(len(borders) + 1, "slice").sortWithinPartitions("slice", "run")

    def merge(batches):
        def rows():
            for batch in batches:
                for s, listed in zip(batch.column(0).to_pylist(), batch.column(2)):
                    yield s, listed.values

        for s, group in groupby(rows(), key=lambda r: r[0]):
            held, place = [], 0
            for e in LoserTree([_run_of(listed) for _, listed in group]):
                held.append(e)
                if len(held) == 10_000:
                    yield _index_batch(s, place, held)
                    place, held = place + len(held), []
            if held:
                yield _index_batch(s, place, held)

    schema = T.StructType([T.StructField("slice", T.IntegerType()), T.StructField("place", T.LongType()), *ENTRY.fields])
    return runs.mapInArrow(merge, schema)


def _run_of(listed: pa.StructArray, step: int = 256) -> Iterator[tuple[tuple, dict]]:
    """Order key and entry of a run in turn; few entries at a time are Python objects."""
    for i in range(0, len(listed), step):
        for e in listed.slice(i, step).to_pylist():
            yield order_of(e), e


def _index_batch(s: int, place: int, rows: list[dict]) -> pa.RecordBatch:
    columns = pa.array(rows, _ENTRY_ARROW).flatten()
    return pa.RecordBatch.from_arrays(
        [pa.array([s] * len(rows), pa.int32()), pa.array(range(place, place + len(rows)), pa.int64()), *columns],
        ["slice", "place", *[f.name for f in ENTRY]])
