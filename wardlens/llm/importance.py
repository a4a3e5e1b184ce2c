"""Importance resampling towards a target text collection, by bit-sliced aggregation.

Word runs hash to buckets. A document's bucket counts become bit planes of one
bit per bucket, the integer gains of the buckets become signed bit planes, and
a weight is the sum of popcounts of their conjunctions times powers of two:
exact, and without a lookup per feature. The highest scores with Gumbel noise
are a draw without replacement in proportion to the weights.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions.scalar import quoted
from wardlens.llm.common import map_text, without
from wardlens.operators.order import ordered_index
from wardlens.session import durable

BUCKETS, LONGEST_RUN, MIN_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, "2024"
_CHUNK = 256  # documents whose planes are held at once
_BLANKS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_COUNTS = [T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()),
           T.StructField("buckets", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))]


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and anything outside ASCII, A-Z lower-cased; none for null."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_BLANKS).split() if text else []


def with_counts(df: DataFrame, text: str, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> DataFrame:
    """Append word and feature numbers and the counts of the buckets that occur, in ascending order."""
    def make():
        def work(texts: Sequence[str | None]):
            n_words, n_features, sizes, hashed, times = [], [], [], [], []
            for text in texts:
                words = words_of(text)
                runs = Counter(words)
                for n in range(2, longest + 1):
                    runs.update(b" ".join(words[i:i + n]) for i in range(len(words) - n + 1))
                n_words.append(len(words))
                n_features.append(sum(max(0, len(words) - n + 1) for n in range(1, longest + 1)))
                sizes.append(len(runs))
                hashed.append(np.fromiter(map(zlib.crc32, runs), np.int64, len(runs)))
                times.append(np.fromiter(runs.values(), np.int64, len(runs)))
            row = np.repeat(np.arange(len(texts)), sizes)
            keys, at = np.unique(row * buckets + np.concatenate(hashed or [row]) % buckets, return_inverse=True)
            counts = np.zeros(len(keys), np.int64)
            np.add.at(counts, at, np.concatenate(times or [row]))
            ends = np.searchsorted(keys, np.arange(len(texts) + 1) * buckets).astype(np.int32)
            return [pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()),
                    pa.ListArray.from_arrays(ends, (keys % buckets).astype(np.int32)),
                    pa.ListArray.from_arrays(ends, counts.astype(np.int32))]
        return work

    return map_text(df, text, make, _COUNTS)


def histogram(counted: DataFrame) -> DataFrame:
    """Features per bucket over all rows; partial sums leave each task as one row per bucket."""
    pair = F.explode(F.arrays_zip("buckets", "counts")).alias("pair")
    return (counted.select(pair).groupBy(F.col("pair.buckets").alias("bucket"))
            .agg(F.sum(F.col("pair.counts").cast("long")).alias("n")))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Integer log gain of each bucket, in thousandths, with one added to each count.

    Collects two histograms of at most ``buckets`` rows.
    """
    s, t = ({r["bucket"]: r["n"] for r in h.collect()} for h in (histogram(corpus), histogram(target)))
    all_s, all_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return [math.floor(1000 * math.log((t.get(b, 0) + 1.0) * all_s / ((s.get(b, 0) + 1.0) * all_t)))
            for b in range(buckets)]


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of non-negative integers, lowest first, each packed to 64-bit words along the last axis."""
    width = -len(values) % 64
    padded = np.pad(values, (0, width))
    depth = max(1, int(padded.max(initial=0)).bit_length())
    bits = (padded[None, :] >> np.arange(depth)[:, None]) & 1
    return np.packbits(bits.astype(bool), axis=1, bitorder="little").view(np.uint64)


def signed_planes(gain: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Planes of the positive and of the negative gains, and what a bit of each plane is worth."""
    g = np.asarray(gain, np.int64)
    up, down = planes(np.maximum(g, 0)), planes(np.maximum(-g, 0))
    worth = [1 << k for k in range(len(up))] + [-(1 << k) for k in range(len(down))]
    return np.concatenate([up, down]), np.asarray(worth, np.int64)


def bit_sliced(ends: np.ndarray, bucket: np.ndarray, count: np.ndarray, gain_planes: np.ndarray,
               worth: np.ndarray) -> np.ndarray:
    """Weights of documents given as bucket counts: plane AND plane, popcount, power-of-two sum."""
    weights, size = np.zeros(len(ends) - 1, np.int64), gain_planes.shape[1] * 64
    for first in range(0, len(weights), _CHUNK):
        last = min(first + _CHUNK, len(weights))
        inside = slice(ends[first], ends[last])
        row = np.repeat(np.arange(first, last), np.diff(ends[first:last + 1]))
        for k in range(int(count[inside].max(initial=0)).bit_length()):
            has = (count[inside] >> k) & 1 == 1
            docs, at = np.unique(row[has], return_inverse=True)
            bits = np.zeros((len(docs), size), bool)
            bits[at, bucket[inside][has]] = True
            plane = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
            for one, value in zip(gain_planes, worth):
                weights[docs] += np.bitwise_count(plane & one).sum(axis=1, dtype=np.int64) * (value << k)
    return weights


def with_weights(counted: DataFrame, gain: Sequence[int]) -> DataFrame:
    """Replace the bucket counts by the weight they give."""
    kept = without(counted, "buckets", "counts", "weight")
    source = counted.select(*[quoted(c) for c in kept], "buckets", "counts")

    def run(batches):
        gain_planes, worth = signed_planes(gain)
        for batch in batches:
            lists = [batch.column(len(kept) + i) for i in range(2)]
            flat = [x.flatten().to_numpy(zero_copy_only=False) for x in lists]
            ends = np.concatenate([[0], np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False))])
            weight = bit_sliced(ends, flat[0], flat[1], gain_planes, worth)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(weight, pa.int64())], [*kept, "weight"])

    schema = T.StructType([*source.schema.fields[:-2], T.StructField("weight", T.LongType())])
    return source.mapInArrow(run, schema)


def noise(key: str, seed: str = SEED):
    """Gumbel noise in thousandths, from a hash of seed and key; a null key hashes as empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(quoted(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, *, key: str = "doc_id", text: str = "text",
             target_text: str = "text", carry: Sequence[str] = (), buckets: int = BUCKETS, longest: int = LONGEST_RUN,
             min_words: int = MIN_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """Every row's ``n_features``, ``weight`` and ``score``, and ``rank`` where it is drawn.

    Of the N rows with at least ``min_words`` words the ``floor(percent * N /
    100)`` highest scores are drawn, equal scores by smaller key, rows without
    a key last; repeated rows follow each other. Null and empty texts weigh 0.
    Very long texts are read whole, as bucket counts of at most ``buckets``
    entries. An empty table gives no rows, an empty target only floors. Columns
    named in ``carry`` stay, others are dropped, so clashing names do no harm.
    Texts are read once; positions come from a range-partitioned sort of
    narrow rows.
    """
    named = docs.select(quoted(key), *[quoted(c) for c in carry], quoted(text).alias("__text"))
    counted = durable(with_counts(named, "__text", buckets, longest).drop("__text"), "bucket-counts")
    wanted = with_counts(target.select(quoted(target_text).alias("__text")), "__text", buckets, longest)
    gain = gains(counted, wanted, buckets)
    drawn = counted.where(F.col("n_words") >= min_words).count() * percent // 100
    weighed = durable(with_weights(counted, gain), "weights")  # the sort samples its input first
    scored = (weighed.withColumn("score", (F.col("weight") + noise(key, seed)).cast("long"))
              .withColumn("__short", F.col("n_words") < min_words).withColumn("__down", -F.col("score"))
              .withColumn("__unnamed", quoted(key).isNull()))
    placed = ordered_index(scored, ["__short", "__down", "__unnamed", key], "__rank")
    rank = F.when(~F.col("__short") & (F.col("__rank") <= drawn), F.col("__rank")).cast("long")
    return placed.select(quoted(key), *[quoted(c) for c in carry], "n_features", "weight", "score", rank.alias("rank"))
