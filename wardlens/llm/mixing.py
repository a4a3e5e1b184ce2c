"""Mixing sources to target weights: blocks, multinomial slots and index permutations.

Each source's texts form one stream of words, cut into blocks of a fixed
length. A source's target decides how many block slots it gets; slots are dealt
to output shards by multinomial draws, slot k of a source names a block through
a pseudorandom permutation of its block indexes, and blocks join by index.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlens.functions.scalar import quoted
from wardlens.llm.common import WORD, word_count
from wardlens.session import durable

BLOCK = 1024
MAX_REPEAT = 3
_STRATUM = 1 << 20


def default_weights(n: int) -> list[float]:
    """5, 2, 1, repeating."""
    return [float((5, 2, 1)[i % 3]) for i in range(n)]


def targets(sizes: Sequence[int], weights: Sequence[float], repeat: float = MAX_REPEAT) -> list[float]:
    """Share the sum of all sizes by weight, none above ``repeat`` times its size.

    What a source cannot take is shared among the others by weight, until none
    is above its bound.
    """
    left, result = float(sum(sizes)), [0.0] * len(sizes)
    free = {i for i, w in enumerate(weights) if w > 0}
    while free:
        total = sum(weights[i] for i in free)
        full = {i for i in free if left * weights[i] / total > repeat * sizes[i]}
        if not full:
            for i in free:
                result[i] = left * weights[i] / total
            break
        for i in full:
            result[i] = float(repeat * sizes[i])
        left -= sum(result[i] for i in full)
        free -= full
    return result


@dataclass(frozen=True)
class Source:
    """What the mix takes of one source. ``name`` is None for null.

    A pass takes every block of the stream once. All blocks are full but the
    tail; in pass p it comes at place ``tails[p]``, the others permuted around
    it, so the words taken before any place are known without a walk.
    """

    number: int
    name: str | None
    size: int
    target: float
    block: int
    tails: tuple[int, ...]

    @property
    def words(self) -> int:
        return round(self.target)

    @property
    def full(self) -> int:
        return self.size // self.block

    @property
    def blocks(self) -> int:
        return -(-self.size // self.block)

    def taken_before(self, turn: np.ndarray, place: np.ndarray) -> np.ndarray:
        late = place > np.array(self.tails, np.int64)[turn]
        missing = self.block - self.size % self.block if self.size % self.block else 0
        return turn * self.size + place * self.block - np.where(late, missing, 0)

    @property
    def slots(self) -> int:
        """Slots until the target is met: whole passes, then places of the last one."""
        if not self.size:
            return 0
        turn = self.words // self.size
        if turn * self.size == self.words:
            return turn * self.blocks
        low, high = 0, self.blocks
        while low < high:  # the first place with the target reached before it
            mid = (low + high) // 2
            if int(self.taken_before(np.array([turn]), np.array([mid]))[0]) < self.words:
                low = mid + 1
            else:
                high = mid
        return turn * self.blocks + low


def source_table(sized: DataFrame, weights: Mapping[str | None, float] | None = None, repeat: int = MAX_REPEAT,
                 block: int = BLOCK, seed: int = 17) -> list[Source]:
    """One entry per source: the mix's own parameter table, as long as the list of sources."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))  # Python compares by code point
    given = default_weights(len(rows)) if weights is None else [float(weights.get(r["source"], 0)) for r in rows]
    shares = targets([r["size"] for r in rows], given, repeat)
    return [Source(i, r["source"], r["size"], t, block,
                   tuple(np.random.default_rng([seed, i]).integers(0, -(-r["size"] // block) or 1, repeat + 1).tolist()))
            for i, (r, t) in enumerate(zip(rows, shares))]


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of each index under a pseudorandom permutation of 0..size-1 chosen by ``key``.

    A four-round Feistel network over the next even number of bits; indexes that
    land outside walk the cycle on.
    """
    index, size, key = (np.asarray(x).astype(np.uint64) for x in (index, size, key))
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2).astype(np.float64))).astype(np.int64) + 1) // 2)
    half = half.astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.copy(), np.arange(len(index))
    with np.errstate(over="ignore"):
        while len(todo):
            x, h, m, k = out[todo], half[todo], mask[todo], key[todo]
            left, right = x >> h, x & m
            for turn in range(4):
                mixed = (right + np.uint64(turn + 1)) * np.uint64(0x9E3779B97F4A7C15) ^ k
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & m)
            out[todo] = left << h | right
            todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def stream(sized: DataFrame, order: Sequence[str], rows_per_task: int = 5_000) -> DataFrame:
    """Add ``start``: where a row's ``size`` words lie in the stream of its ``source``.

    Rows of a source are dealt by hash into groups of about ``rows_per_task``
    and ordered inside a group, so a hot source spreads over many tasks; the
    groups' totals give each its start. Rows equal in ``order`` and size are
    interchangeable; where they are many they are numbered and dealt by number.
    """
    keyed = dealt(sized, order, rows_per_task)
    totals = keyed.groupBy("source", "__group").agg(F.sum("size").alias("__sum"))
    by_source = Window.partitionBy("source").orderBy("__group")
    starts = totals.select(F.col("source").alias("__source"), F.col("__group").alias("__at"),
                           (F.sum("__sum").over(by_source) - F.col("__sum")).alias("__before"))
    inside = (Window.partitionBy("source", "__group")
              .orderBy("__order", *[quoted(c) for c in order], "size", "__copy")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = keyed.withColumn("start", F.sum("size").over(inside) - F.col("size"))
    same = F.col("source").eqNullSafe(F.col("__source")) & (F.col("__group") == F.col("__at"))
    return (placed.join(starts, same).withColumn("start", F.col("start") + F.col("__before"))
            .drop("__order", "__copy", "__group", "__source", "__at", "__before"))


def dealt(sized: DataFrame, order: Sequence[str], rows_per_task: int) -> DataFrame:
    """Add ``__order``, ``__copy`` and ``__group``: the hash that rows are dealt by, and where it deals them."""
    keyed = sized.withColumn("__order", F.xxhash64(*[quoted(c) for c in order], F.col("size")))
    groups = max(1, -(-sized.count() // rows_per_task))
    keyed = _copies_numbered(keyed, rows_per_task // 2)
    mark = F.when(F.col("__copy") == 0, F.col("__order")).otherwise(F.xxhash64("__order", "__copy"))
    return keyed.withColumn("__group", F.pmod(mark, F.lit(groups)))


def _copies_numbered(keyed: DataFrame, most: int) -> DataFrame:
    """Add ``__copy``, which tells apart rows of one hash and source where more than ``most`` have it; else 0.

    Only such rows are written, with their positions: a row's number is its
    rank in its slice of the written table and the counts of the slices before.
    """
    hot = durable(keyed.groupBy("source", "__order").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
                  .select("__order").distinct().withColumnRenamed("__order", "__hot"), "hot-rows")
    if hot.isEmpty():
        return keyed.withColumn("__copy", F.lit(0).cast("long"))
    is_hot = F.col("__order") == F.col("__hot")
    rows = durable(keyed.join(hot, is_hot, "left_semi").withColumn("__position", F.monotonically_increasing_id()), "hot-copies")
    rows = rows.withColumn("__slice", F.shiftright("__position", 33))
    counts = rows.groupBy(F.col("__slice").alias("__s"), F.col("source").alias("__from"), F.col("__order").alias("__o")).agg(
        F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__from", "__o").orderBy("__s")) - F.col("__n")
    earlier = counts.withColumn("__earlier", before)
    rank = F.row_number().over(Window.partitionBy("__slice", "source", "__order").orderBy("__position"))
    same = ((F.col("__slice") == F.col("__s")) & (F.col("__order") == F.col("__o"))
            & F.col("source").eqNullSafe(F.col("__from")))
    numbered = rows.withColumn("__rank", rank).join(earlier, same).withColumn("__copy", F.col("__rank") + F.col("__earlier") - 1)
    rest = keyed.join(hot, is_hot, "left_anti").withColumn("__copy", F.lit(0).cast("long"))
    return rest.unionByName(numbered.select(*rest.columns))


def draw_blocks(spark: SparkSession, table: Sequence[Source], shard_slots: int = 4096,
                seed: int = 17) -> DataFrame:
    """``shard, slot, number, turn, block, words``: every block the mix takes, by output shard.

    The slots of all sources are cut into strata of about a million; a stratum
    has each source's slots in proportion. Inside it a shard's source counts
    are a multinomial draw without replacement over what the sources still
    have to give: they vary from shard to shard as drawn and add up to every
    target. Slot k of a source with B blocks is place ``k mod B`` of its pass
    ``k div B``, and each pass permutes the block indexes anew. The last slot
    is cut short where the target is met. Strata are drawn in parallel.
    """
    slots = np.array([s.slots for s in table], np.int64)
    strata = max(1, -(-int(slots.sum()) // _STRATUM))
    per_stratum = -(-(_STRATUM + len(table)) // shard_slots) + 1

    def blocks_of(s: Source, first: int, count: int) -> pd.DataFrame:
        k = np.arange(first, first + count)
        turn, place = k // s.blocks, k % s.blocks
        before = s.taken_before(turn, place)
        tail_at = np.array(s.tails, np.int64)[turn]
        has_tail = s.blocks > s.full
        index = place - (place > tail_at) if has_tail else place
        key = (np.uint64(seed) << np.uint64(44)) + (np.uint64(s.number) << np.uint64(8)) + turn.astype(np.uint64)
        block = permuted(np.minimum(index, max(0, s.full - 1)), np.full(count, max(1, s.full)), key)
        length = np.full(count, s.block)
        if has_tail:
            tail = place == tail_at
            block, length = np.where(tail, s.full, block), np.where(tail, s.size % s.block, length)
        return pd.DataFrame({"slot": k, "number": s.number, "turn": turn, "block": block,
                             "words": np.minimum(length, s.words - before)})

    def run(batches):
        for batch in batches:
            for g in batch["id"].tolist():
                start = slots * g // strata
                left = slots * (g + 1) // strata - start
                rng, shard = np.random.default_rng([seed, g]), g * per_stratum
                while left.sum():
                    drawn = rng.multivariate_hypergeometric(left, min(shard_slots, int(left.sum())), method="marginals")
                    for i in np.flatnonzero(drawn).tolist():
                        found = blocks_of(table[i], int(start[i]), int(drawn[i]))
                        found.insert(0, "shard", shard)
                        yield found
                    start, left, shard = start + drawn, left - drawn, shard + 1

    return (spark.range(strata, numPartitions=min(strata, 1000))
            .mapInPandas(run, "shard long, slot long, number int, turn int, block long, words long"))


class Mix:
    """The mix of a table of documents.

    Null and empty texts have no words and are taken zero times. Null is a
    source like any other, after the named ones. Repeated rows are documents of
    their own. A source of no words gets no target. An empty table gives empty
    results.
    """

    def __init__(self, docs: DataFrame, *, source: str = "source", text: str = "text",
                 order: Sequence[str] = ("doc_id",), weights: Mapping[str | None, float] | None = None,
                 repeat: int = MAX_REPEAT, block: int = BLOCK, shard_slots: int = 4096, seed: int = 17):
        keys = [quoted(c).alias(f"key_{i}") for i, c in enumerate(order)]
        self._keys = [f"key_{i}" for i in range(len(order))]
        self._sized = docs.select(*keys, quoted(source).alias("source"), word_count(quoted(text)).alias("size"),
                                  quoted(text).alias("text"))
        self._order, self._block = order, block
        spark = docs.sparkSession
        sizes = durable(self._sized.drop("text"), "mix-sizes")
        self.sources = source_table(sizes, weights, repeat, block, seed)
        self._names = spark.createDataFrame(
            [(s.number, s.name, s.size, s.target) for s in self.sources],
            "number int, name string, source_size long, target double")
        self._sizes = sizes
        self.draws = draw_blocks(spark, self.sources, shard_slots, seed)

    def _numbered(self, rows: DataFrame) -> DataFrame:
        """Rows with their source's facts; one small row per source."""
        return rows.join(self._names, F.col("source").eqNullSafe(F.col("name")), "left").drop("name")

    def spans(self) -> DataFrame:
        """``shard, slot, turn, number, start, low, high``: words taken of the row at ``start``, by place in the row.

        The real output in index form: joined to the texts by source and start
        it gives each shard's words, see ``texts``.
        """
        rows = self._numbered(stream(self._sizes, self._keys)).where(F.col("size") > 0)
        last = F.expr(f"(start + size - 1) div {self._block}")
        pieces = rows.select("number", "start", "size",
                             F.explode(F.sequence(F.expr(f"start div {self._block}"), last)).alias("block"))
        # The drawn table looks small to the planner but grows with the input: no broadcast.
        joined = pieces.hint("merge").join(self.draws.hint("merge"), ["number", "block"])
        low = F.greatest(F.col("start"), F.col("block") * self._block) - F.col("start")
        high = F.least(F.col("size"), F.col("block") * self._block + F.col("words") - F.col("start"))
        return (joined.select("shard", "slot", "turn", "number", "start", low.alias("low"), high.alias("high"))
                .where(F.col("high") > F.col("low")))

    def taken(self) -> DataFrame:
        """Per row: the order columns, ``size, source_size, target, taken``."""
        rows = self._numbered(stream(self._sizes, self._keys))
        uses = self.spans().groupBy("number", "start").agg(F.sum(F.col("high") - F.col("low")).alias("words"))
        # A row without words shares its start with the next one, which has some.
        has = F.when(rows["size"] > 0, rows["start"])
        joined = rows.join(uses.withColumnsRenamed({"number": "n", "start": "s"}).hint("merge"),
                           (rows["number"] == F.col("n")) & (has == F.col("s")), "left")
        return joined.select(*[F.col(k).alias(c) for k, c in zip(self._keys, self._order)],
                             "size", "source_size", "target", F.coalesce("words", F.lit(0)).alias("taken"))

    def texts(self) -> DataFrame:
        """One row per document and pass with words taken: order columns, ``source, turn, text``.

        A document taken whole keeps its text as it is; of one taken in part
        the words taken follow each other, one space between.
        """
        spans = (self.spans().groupBy("number", "start", "turn")
                 .agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans"),
                      F.sum(F.col("high") - F.col("low")).alias("words"))
                 .withColumnsRenamed({"number": "n", "start": "s"}))
        rows = self._numbered(stream(self._sized, self._keys)).where(F.col("size") > 0)
        joined = rows.join(spans, (F.col("number") == F.col("n")) & (F.col("start") == F.col("s")))
        words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
        part = F.array_join(F.flatten(F.transform(
            "spans", lambda x: F.slice(words, (x["low"] + 1).cast("int"), (x["high"] - x["low"]).cast("int")))), " ")
        return joined.select(*[F.col(k).alias(c) for k, c in zip(self._keys, self._order)], "source", "turn",
                             F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(part).alias("text"))
