"""Audit of how filters interact: what each removes, repeats or alone catches, in every order.

Rows reduce to bit combinations of the filters they fail. Copies are found by
an existential self-join: a row fails when a row with equal hash, equal text
and a smaller key exists. Its right side is folded to the least key per text,
so a group of copies costs its own size and no pairs are made.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.scalar import quoted
from wardlens.llm.common import WORD, with_possible
from wardlens.session import durable

MAX_FILTERS = 6  # orders grow as the factorial


def text_rules(text: Column) -> dict[str, Column]:
    """The four conditions on a text's own content, by letter; true where the text fails.

    A: under 100 words. B: distinct words under 80 % of the words. C: A-Z over
    10 % of the code points. D: any of ``#$%&*|``. Words are split once.
    """
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    counted = F.transform(F.array(words), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), F.size(F.array_distinct(w)).cast("long").alias("d"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("c"),
        text.rlike("[#$%&*|]").alias("m")))
    failed = F.transform(counted, lambda s: F.struct(
        (s["n"] < 100).alias("A"), (100 * s["d"] < 80 * s["n"]).alias("B"),
        (100 * s["c"] > 10 * F.length(text)).alias("C"), s["m"].alias("D")))[0]
    return {k: failed[k] for k in "ABCD"}


def copies_of_smaller(rows: DataFrame, hashes: DataFrame, key: str, text: str, hash_: str) -> DataFrame:
    """The rows whose text equals that of a row with a smaller key.

    ``hashes`` holds key and hash of every row, without texts: hashes that only
    one key has are settled there, and only texts that a filter of the others lets
    through are moved and compared.
    Rows without a key neither fail nor make others fail. Both right sides are
    written tables, so Spark plans their joins from true sizes.
    """
    repeated = durable(hashes.groupBy(hash_).agg(F.min(key).alias("__least"), F.max(key).alias("__most"))
                       .where("__least < __most").select(F.col(hash_).alias("__hash")), "repeated-hashes")
    possible = with_possible(rows.where(quoted(key).isNotNull()), hash_, repeated, "__hash").where("possible").drop("possible")
    candidates = possible.join(repeated, quoted(hash_) == F.col("__hash"), "left_semi")
    firsts = durable(candidates.groupBy(quoted(hash_).alias("__hash"), quoted(text).alias("__text"))
                     .agg(F.min(key).alias("__first")), "first-copies")
    return candidates.join(firsts, (quoted(hash_) == F.col("__hash")) & (quoted(text) == F.col("__text"))
                           & (F.col("__first") < quoted(key)), "left_semi")


def combinations(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text",
                 part: str = "lang") -> DataFrame:
    """Rows, good rows and toxic rows per part and combination of failed filters.

    Columns: ``part``, ``failed`` (bit i: the i-th of ABCDE), ``n``, ``good``,
    ``toxic``. Null texts are empty, a null part is the empty string. Very long
    texts are read whole. Repeated rows count each; a key labelled twice has
    the larger label, rows without a key have none. An empty table has no
    combinations. Columns beside those named are ignored.
    """
    whole = docs.select(quoted(key).alias("id"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"),
                        F.coalesce(quoted(part).cast("string"), F.lit("")).alias("part"))
    hashed = whole.withColumn("hash", F.xxhash64("text"))
    bits = [F.when(condition, F.lit(1 << i)).otherwise(0) for i, condition in enumerate(text_rules(F.col("text")).values())]
    facts = durable(hashed.select("id", "hash", "part", reduce(lambda a, b: a + b, bits).alias("failed")), "filter-facts")
    copies = copies_of_smaller(hashed, facts, "id", "text", "hash")
    marks = facts.withColumn("n", F.lit(1)).unionByName(
        copies.select("id", "hash", "part", F.lit(1 << len(bits)).alias("failed"), F.lit(0).alias("n")))
    per_row = marks.groupBy("id", "hash", "part").agg(F.bit_or("failed").alias("failed"), F.sum("n").alias("n"))
    truth = (labels.where(quoted(key).isNotNull()).groupBy(quoted(key).alias("id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                  F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    labelled = per_row.join(truth, "id", "left")
    return labelled.groupBy("part", "failed").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("good", "toxic")])


def interactions(combined: DataFrame, letters: str = "ABCDE", lost: Mapping[str, str] | None = None) -> DataFrame:
    """What each filter does at each place of each order, per part; zeros included.

    From the bit combinations alone: one row per part and combination meets the
    orders in a generator, so the work does not depend on the number of rows
    behind them.
    """
    if len(letters) > MAX_FILTERS:
        raise ValueError(f"at most {MAX_FILTERS} filters: {len(letters)}! orders are too many")
    lost = lost or {"good_lost": "good", "toxic_lost": "toxic"}
    orders = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    placed = (combined.withColumn("filter_order", F.explode(orders))
              .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters))))))

    def mask(within: Column) -> Column:
        return reduce(lambda a, b: a + b, [F.when(within.contains(c), F.lit(1 << i)).otherwise(0)
                                           for i, c in enumerate(letters)])

    placed = (placed.withColumn("filter", F.expr("substring(filter_order, step, 1)"))
              .withColumn("own", mask(F.col("filter")))
              .withColumn("before", mask(F.expr("substring(filter_order, 1, step - 1)"))))
    failed, own, before = F.col("failed"), F.col("own"), F.col("before")
    fails, gone = failed.bitwiseAND(own) != 0, failed.bitwiseAND(before) != 0

    def total(condition: Column, of: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(of)).otherwise(0)).cast("long")

    counted = placed.groupBy("part", "filter_order", "step", "filter").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"), total(failed == own).alias("unique_fails"),
        *[total(fails & ~gone, of).alias(name) for name, of in lost.items()])
    shares = (counted.groupBy(F.col("part").alias("__part"), F.col("filter").alias("__filter"))
              .agg(F.sum("removed").cast("long").alias("shapley")))
    return (counted.join(shares, (F.col("part") == F.col("__part")) & (F.col("filter") == F.col("__filter")))
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *lost, "shapley"))
