"""Token-id files: concatenated ids with Elias-Fano encoded document boundaries.

A file is a run of segments, one line feed after each. A segment holds, little
endian: a header, the Elias-Fano coded token offsets of its documents, the
Elias-Fano coded document ids (ascending, null ids last), and all ids at 2 or 4
bytes each. Files come from Spark's own text writer and binary reader, so they
lie in any store that Spark reaches and a lost task leaves nothing behind.
"""

from __future__ import annotations

import array
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from wardlens.functions.scalar import quoted
from wardlens.llm.bpe import ChunkEncoder, WordSplit
from wardlens.llm.common import map_text, pair_bounds, range_of, shuffle_partitions
from wardlens.session import durable

MAGIC = b"EFTK"
_HEADER = struct.Struct("<4sHHIIQQQq")  # magic, version, id bytes, slice, segment, documents, nulls, ids, least id
_LISTS = struct.Struct("<QQQI")  # values, universe, upper bytes, low bits
_SAMPLE = 256


class EliasFano:
    """A non-decreasing list of integers in about 2 + log2(universe / n) bits each.

    The low bits of every value are packed; the high parts are ones in a bit
    vector, the one of value i at place ``high + i``. The place of every 256th
    one is kept, so ``select`` starts near its target.
    """

    def __init__(self, n: int, universe: int, low_bits: int, low: bytes, upper: bytes, samples: np.ndarray):
        self.n, self.universe, self.low_bits = n, universe, low_bits
        self.low, self.upper, self.samples = low, upper, samples

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        low_bits = max(0, int(universe // n).bit_length() - 1) if n else 0
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        bits[places] = 1
        low = b""
        if low_bits:
            planes = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()
        return cls(n, universe, low_bits, low, np.packbits(bits, bitorder="little").tobytes(),
                   places[::_SAMPLE].astype("<u8"))

    def _low_of(self, i: int) -> int:
        bit = i * self.low_bits
        word = int.from_bytes(self.low[bit // 8:(bit + self.low_bits + 7) // 8], "little")
        return (word >> bit % 8) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Value ``i`` from the nearest sample, without unpacking the list."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // _SAMPLE]), i % _SAMPLE
        byte = at // 8
        word = self.upper[byte] & (0xFF << at % 8)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = self.upper[byte]
        for _ in range(left):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        return (place - i) << self.low_bits | self._low_of(i)

    def select_block(self, k: int) -> np.ndarray:
        """The values from the k-th sample up to the next one, without unpacking the rest."""
        first, last = k * _SAMPLE, min(self.n, (k + 1) * _SAMPLE)
        begin = int(self.samples[k])
        end = int(self.samples[k + 1]) if k + 1 < len(self.samples) else 8 * len(self.upper)
        bits = np.unpackbits(np.frombuffer(self.upper, np.uint8, (end + 7) // 8 - begin // 8, begin // 8), bitorder="little")
        places = np.flatnonzero(bits[begin % 8:])[:last - first] + begin
        high = (places - np.arange(first, last)) << self.low_bits
        if not self.low_bits:
            return high
        at, stop = first * self.low_bits, last * self.low_bits
        low = np.unpackbits(np.frombuffer(self.low, np.uint8, (stop + 7) // 8 - at // 8, at // 8), bitorder="little")
        planes = low[at % 8:at % 8 + stop - at].reshape(last - first, self.low_bits).astype(np.int64)
        return high | (planes << np.arange(self.low_bits)).sum(axis=1)

    def values(self) -> np.ndarray:
        """All values at once."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.upper, np.uint8), bitorder="little"))[:self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits:
            return high
        planes = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")
        planes = planes[:self.n * self.low_bits].reshape(self.n, self.low_bits).astype(np.uint64)
        return high | (planes << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def to_bytes(self) -> bytes:
        head = _LISTS.pack(self.n, self.universe, len(self.upper), self.low_bits)
        return head + self.samples.tobytes() + self.upper + self.low

    @classmethod
    def read(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        n, universe, upper, low_bits = _LISTS.unpack_from(data, at)
        at += _LISTS.size
        samples = np.frombuffer(data, "<u8", -(-n // _SAMPLE), at)
        at += 8 * len(samples)
        low = (n * low_bits + 7) // 8
        return (cls(n, universe, low_bits, bytes(data[at + upper:at + upper + low]),
                    bytes(data[at:at + upper]), samples), at + upper + low)


class Segment:
    """One segment: ``ids_of(i)`` reads a document's ids through ``select``."""

    def __init__(self, data: memoryview, at: int = 0):
        magic, version, self.width, self.slice, self.number, self.docs, self.nulls, self.n_ids, least = \
            _HEADER.unpack_from(data, at)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token file")
        self.bounds, at = EliasFano.read(data, at + _HEADER.size)
        keys, at = EliasFano.read(data, at)
        self._least, self._keys = least, keys
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, at)
        self.end = at + self.n_ids * self.width

    def ids_of(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i):self.bounds.select(i + 1)]

    def doc_ids(self) -> list[int | None]:
        return [int(k) + self._least for k in self._keys.values().tolist()] + [None] * self.nulls


def segment_bytes(part: int, number: int, doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """Pack documents in ascending id order, null ids last."""
    known = [d for d in doc_ids if d is not None]
    sizes = np.fromiter((len(x) // width for x in ids), np.int64, len(ids))
    offsets = np.r_[0, np.cumsum(sizes)]
    least = known[0] if known else 0
    keys = np.array([d - least for d in known], np.uint64)
    total = int(offsets[-1])
    head = _HEADER.pack(MAGIC, 1, width, part, number, len(ids), len(ids) - len(known), total, least)
    return (head + EliasFano.of(offsets, total).to_bytes()
            + EliasFano.of(keys, int(keys[-1]) if known else 0).to_bytes() + b"".join(ids))


def segments(data: bytes) -> Iterator[Segment]:
    """The segments of one file."""
    view, at = memoryview(data), 0
    while at < len(data):
        segment = Segment(view, at)
        yield segment
        at = segment.end + 1


@lru_cache(maxsize=2)
def _encoder(path: str, width: int) -> ChunkEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    tokenizer, split = Tokenizer.from_file(path), WordSplit(path)
    model, code = tokenizer.model, {2: "H", 4: "I"}[width]
    names = {t.content for t in tokenizer.get_added_tokens_decoder().values()}

    def words(found):
        return [array.array(code, [t.id for t in model.tokenize(split.spelled(w))]).tobytes() for w in found]

    def special(text):
        if any(n in text for n in names):
            return [array.array(code, tokenizer.encode(text, add_special_tokens=False).ids).tobytes()]
        return split.words(text)

    return ChunkEncoder(words, special, batch=False)


def encode_ids(df: DataFrame, text: str, path: str, end_id: int, width: int, out: str = "ids") -> DataFrame:
    """Append the ids of the tokenizer file, ``end_id`` last, packed at ``width`` bytes each.

    The library encodes each distinct word once and remembers it; no word
    reaches over the split rules, so the ids are those of the whole text.
    """

    def make():
        encoder, end = _encoder(path, width), np.array([end_id], f"<u{width}").tobytes()
        return lambda texts: [pa.array([e + end for e in encoder.encode(texts)], pa.binary())]

    return map_text(df, text, make, [T.StructField(out, T.BinaryType())], limit=1 << 20)


def write_tokens(docs: DataFrame, folder: str, path: str, *, key: str = "doc_id", text: str = "text",
                 end_id: int = 2, width: int = 2, segment_ids: int = 1 << 20) -> None:
    """Encode every text and write token files in ascending key order, null keys last.

    A null text has the end id alone; rows of one key follow each other, in the
    order of a hash of their ids. Texts are encoded where they are read, very
    long ones whole, and only packed ids are shuffled: ranges of key and hash,
    one per task, so that rows of one key or without one spread over as many
    ranges as they fill. A task holds one segment of about ``segment_ids`` ids
    at a time. An empty table gives files without segments; columns beside
    those named are ignored.
    """
    parts = min(shuffle_partitions(docs), 10_000)
    rows = docs.select(quoted(key).cast("long").alias("key"), quoted(text).alias("text"))
    bounds = pair_bounds(rows, "key", parts)
    coded = encode_ids(rows, "text", path, end_id, width).drop("text").withColumn("tie", F.xxhash64("ids"))
    ranged = (coded.withColumn("part", range_of(F.col("key"), F.col("tie"), bounds))
              .repartitionById(len(bounds) + 1, "part")
              .sortWithinPartitions(F.col("part"), F.col("key").asc_nulls_last(), "tie", "ids"))

    def pack(batches):
        held, ids, size, at, number = [], [], 0, None, 0
        for batch in batches:
            for k, data, p in zip(*[batch.column(c).to_pylist() for c in ("key", "ids", "part")]):
                if held and (p != at or size + len(data) > segment_ids * width):
                    yield pa.RecordBatch.from_pydict({"blob": [segment_bytes(at, number, held, ids, width)]})
                    number = 0 if p != at else number + 1
                    held, ids, size = [], [], 0
                at = p
                held.append(k)
                ids.append(data)
                size += len(data)
        if held:
            yield pa.RecordBatch.from_pydict({"blob": [segment_bytes(at, number, held, ids, width)]})

    (ranged.mapInArrow(pack, "blob binary").select(F.col("blob").cast("string").alias("value"))
     .write.mode("overwrite").option("lineSep", "\n").option("compression", "none").text(folder))


def _read(spark: SparkSession, folder: str, make_rows, schema: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    names = T._parse_datatype_string(schema).names

    def run(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                for s in segments(data):
                    yield pa.RecordBatch.from_arrays(make_rows(s), names)

    return files.mapInArrow(run, schema)


def _document_rows(s: Segment) -> list[pa.Array]:
    bounds = np.concatenate([s.bounds.select_block(k) for k in range(len(s.bounds.samples))])
    data = s.ids.astype("<u4")
    cuts = bounds.tolist()
    crc = [zlib.crc32(data[a:b]) for a, b in zip(cuts, cuts[1:])]
    return [pa.array([s.slice] * s.docs, pa.int32()), pa.array([s.number] * s.docs, pa.int32()),
            pa.array(s.doc_ids(), pa.int64()), pa.array(bounds[:-1]), pa.array(np.diff(bounds)),
            pa.array(crc, pa.int64())]


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it. The files are read
    once, into a written table of narrow rows. Offsets add up in two levels,
    per slice and per segment inside a slice, so no window holds more rows than
    slices, or segments of one slice.
    """
    docs = durable(_read(spark, folder, _document_rows,
                         "part int, number int, doc_id long, offset long, n_tokens long, ids_crc32 long"), "token-documents")
    heads = docs.groupBy("part", "number").agg(F.sum("n_tokens").alias("ids"))
    before = F.sum("ids").over(Window.partitionBy("part").orderBy("number")) - F.col("ids")
    totals = heads.groupBy("part").agg(F.sum("ids").alias("of_part"))
    running = F.sum("of_part").over(Window.orderBy("part")) - F.col("of_part")
    base = (heads.withColumn("inside", before).join(totals.withColumn("outside", running), "part")
            .select("part", "number", (F.col("inside") + F.col("outside")).alias("base")))
    return (docs.join(base, ["part", "number"])
            .select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"))
