"""Homomorphic multiset fingerprints of documents.

A paragraph hashes to a wide vector: eight uniform lanes modulo 2**64, and 256
lanes modulo 2**32 that are a signed count sketch of its word triples (a text
of Spark's size has fewer words than their sign leaves room for). A
document's fingerprint is the lane-wise sum over its paragraphs. Sums do not
depend on order; adding or taking away a paragraph's vector updates one without
the rest of the text. The uniform lanes decide equality; the sketch lanes give
a likeness, as inner products of sketches estimate shared triples.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions.scalar import quoted
from wardlens.llm.common import map_text, pair_bounds, range_of, shuffle_partitions, slices

WIDE, SKETCH = 8, 256
_GRAM = 3
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


@lru_cache(maxsize=1)
def _hashes() -> WordHashes:
    return WordHashes()


def vectors(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Wide lanes (n x 8, uint64) and sketch lanes (n x 256, uint32) of each text."""
    digests, counts, words, lengths, of_doc = [], [], [], [], []
    for i, text in enumerate(texts):
        paragraphs = text.encode("utf-8", "surrogatepass").split(b"\n")
        counts.append(len(paragraphs))
        for p in paragraphs:
            digests.append(hashlib.blake2b(p, digest_size=8 * WIDE).digest())
            found = p.split()
            if found:
                words += found
                lengths.append(len(found))
                of_doc.append(i)
    n = len(texts)
    lanes = np.frombuffer(b"".join(digests), "<u8").reshape(-1, WIDE)
    starts = np.r_[0, np.cumsum(counts)[:-1]].astype(np.int64) if n else np.empty(0, np.int64)
    wide = np.add.reduceat(lanes, starts, axis=0) if n else np.empty((0, WIDE), np.uint64)
    sketch = np.zeros(n * SKETCH, np.int64)
    if words:
        hashed = _hashes().of(words)
        length = np.array(lengths)
        doc = np.repeat(np.array(of_doc), length)
        at = np.arange(len(words)) - np.repeat(np.cumsum(length) - length, length)
        total = np.repeat(length, length)
        with np.errstate(over="ignore"):
            feature = np.zeros(len(words), np.uint64)
            for k in range(_GRAM):  # a paragraph of fewer words is one shorter gram
                shifted = np.zeros(len(words), np.uint64)
                shifted[:len(words) - k] = hashed[k:]
                feature += np.where(at + k < total, shifted * _MULTIPLIERS[k], np.uint64(0))
            feature ^= feature >> np.uint64(31)
            feature *= np.uint64(0xD6E8FEB86659FD93)
            feature ^= feature >> np.uint64(32)
        whole = (at + _GRAM <= total) | ((at == 0) & (total < _GRAM))
        feature, doc = feature[whole], doc[whole]
        lane = doc * SKETCH + (feature & np.uint64(SKETCH - 1)).astype(np.int64)
        sign = ((feature >> np.uint64(40)) & np.uint64(1)).astype(np.int64) * 2 - 1
        sketch = np.bincount(lane, weights=sign, minlength=n * SKETCH).astype(np.int64)
    return wide, sketch.reshape(n, SKETCH).astype(np.uint32)


def to_text(wide: np.ndarray, sketch: np.ndarray) -> list[str]:
    """Fingerprints as base64 of their lanes, little endian."""
    return [base64.b64encode(w.astype("<u8").tobytes() + s.astype("<u4").tobytes()).decode()
            for w, s in zip(wide, sketch)]


def from_text(fingerprints: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [base64.b64decode(f) for f in fingerprints]
    data = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), 8 * WIDE + 4 * SKETCH)
    return (np.ascontiguousarray(data[:, :8 * WIDE]).view("<u8"),
            np.ascontiguousarray(data[:, 8 * WIDE:]).view("<u4"))


def fingerprint_of(text: str) -> str:
    return to_text(*vectors([text]))[0]


def combined(fingerprint: str, paragraph: str, sign: int = 1) -> str:
    """The fingerprint with one paragraph added (``sign=1``) or taken away (``sign=-1``)."""
    (w, s), (pw, ps) = from_text([fingerprint]), vectors([paragraph])
    return to_text(w + pw, s + ps)[0] if sign > 0 else to_text(w - pw, s - ps)[0]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Cosine of the sketches, from 0 to 1; 1 where all lanes are equal."""
    x, y = a[1].astype(np.int32).astype(np.float64), b[1].astype(np.int32).astype(np.float64)
    norm = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    cosine = np.divide((x * y).sum(1), norm, out=np.zeros(len(x)), where=norm > 0)
    same = (a[0] == b[0]).all(1) & (a[1] == b[1]).all(1)
    return np.where(same, 1.0, np.clip(cosine, 0.0, 1.0))


def fingerprint(df: DataFrame, text: str, out: str = "fingerprint") -> DataFrame:
    """Append the fingerprint of each text; null counts as empty, which is one empty paragraph."""
    def make():
        return lambda texts: [pa.array(to_text(*vectors([t or "" for t in texts])), pa.string())]

    return map_text(df, text, make, [T.StructField(out, T.StringType())])


@F.pandas_udf(T.DoubleType())
def likeness_of(a: pd.Series, b: pd.Series) -> pd.Series:
    """Likeness of two fingerprint columns."""
    return pd.Series(likeness(from_text(a), from_text(b)))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the next text's first."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_SCHEMA = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """Fingerprint each text, its edited text, and compare with the next row's.

    Returns the key and the columns of ``_SCHEMA``. Next means the following
    row by ascending key, null keys last and rows of one key by a hash of their
    text; the first row follows the last, and a single row follows itself. Null
    texts count as empty. An empty table gives an empty one. Very long texts
    are read whole, and columns beside those named are dropped.

    Rows are shuffled once, into ranges of key and text hash, so that rows of
    one key, or without one, spread over as many ranges as they fill; only
    rows equal in both stay together. The first row of each range is also sent to the range before it, so every row meets its
    successor inside one task.
    """
    source = df.select(quoted(key).cast("long").alias("key"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    bounds = pair_bounds(source, "key", min(shuffle_partitions(df), 5000))
    parts = len(bounds) + 1
    rows = source.withColumn("tie", F.xxhash64("text")).withColumn("part", range_of(F.col("key"), F.col("tie"), bounds))
    place = F.struct(F.col("key").isNull().alias("missing"), F.coalesce("key", F.lit(0)).alias("key"), "tie")
    firsts = {r["part"]: r["first"] for r in rows.groupBy("part").agg(F.min(place).alias("first")).collect()}
    filled = sorted(firsts)
    before = {p: filled[i - 1] for i, p in enumerate(filled)}
    known = F.array(*[F.struct(F.lit(firsts[p]["missing"] if p in firsts else None).cast("boolean").alias("missing"),
                               F.lit(firsts[p]["key"] if p in firsts else None).cast("long").alias("key"),
                               F.lit(firsts[p]["tie"] if p in firsts else None).cast("long").alias("tie"),
                               F.lit(before.get(p)).cast("int").alias("before")) for p in range(parts)])
    rows = rows.withColumn("known", F.element_at(known, F.col("part") + 1))
    is_first = ((F.col("known.missing") == F.col("key").isNull()) & (F.col("known.tie") == F.col("tie"))
                & (F.col("known.key") == F.coalesce("key", F.lit(0))))
    own = F.struct(F.col("part").alias("to"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("known.before").alias("to"), F.lit(True).alias("guest"))
    sent = (rows.withColumn("sent", F.explode(F.when(is_first, F.array(own, guest)).otherwise(F.array(own))))
            .select("key", "text", "tie", F.col("sent.to").alias("part"), F.col("sent.guest").alias("guest"))
            .repartitionById(parts, "part")
            .sortWithinPartitions("part", "guest", F.col("key").asc_nulls_last(), "tie")
            .select("key", "text", "guest"))

    def run(batches):
        held = None  # the last row of the slice before: key, text, vectors
        done = False
        for batch in batches:
            for part in slices(batch, 1):
                if done:
                    break
                keys, texts, guests = (part.column(i).to_pylist() for i in range(3))
                if guests[-1]:
                    stop = guests.index(True) + 1
                    keys, texts, done = keys[:stop], texts[:stop], True
                vec = vectors(texts)
                if held:
                    keys, texts = [held[0], *keys], [held[1], *texts]
                    vec = tuple(np.concatenate([h, v]) for h, v in zip(held[2], vec))
                held = (keys[-1], texts[-1], tuple(v[-1:] for v in vec))
                if len(keys) > 1:
                    yield _compared(keys[:-1], texts, vec)

    return sent.mapInArrow(run, f"key long, {_SCHEMA}").withColumnRenamed("key", key)


def _compared(keys: list, texts: list[str], vec: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    new = vectors(changed)
    own, following = tuple(v[:-1] for v in vec), tuple(v[1:] for v in vec)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
         pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed]),
         pa.array(to_text(*own)), pa.array(to_text(*new)), pa.array(likeness(own, new)),
         pa.array(likeness(own, following))],
        ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
