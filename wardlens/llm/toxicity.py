"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding undoes common disguises: case, accents, letters of other scripts that
look Latin, digits and signs that stand for letters, invisible characters. The
automaton finds lexicon terms at word starts, in the folded text and in the text
with its accents kept, and across single signs inside words; hits inside
exception phrases do not count. The weighted hits, alone and by length, give the
score.
"""

from __future__ import annotations

import re
import string
import unicodedata
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions.scalar import quoted
from wardlens.llm.common import map_text, without
from wardlens.llm.labelled import fit_logistic, labelled_rows
from wardlens.session import durable

SAMPLE = 12_000
THRESHOLD = 0.7
_SEED_WEIGHT = 3.0
POWER = 1.0  # of the log odds in a term's weight; fewest wrong decisions of ``power_errors`` on sf0.1
_STARTS = (3, 4, 5, 6)  # letters of a word's starts that are tried as terms, beside the whole word
_DOCUMENTS = 3  # a term needs so many toxic documents
_LIFT = 2.0  # and odds above so many times those of any word

# Common insults that count before anything is learned.
SEEDS = ("idiot", "moron", "stupid", "imbecile", "loser", "scum", "trash", "worthless", "pathetic", "disgusting",
         "clown", "retard", "dumbass", "bastard", "bitch", "asshole", "motherfuck", "fuck")
# Phrases in which a term is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "trash collection", "clown fish", "clownfish", "class clown")
# Letters that look Latin, and signs that stand for letters.
LOOKALIKES = {"а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m",
              "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѡ": "w", "ɡ": "g", "ı": "i",
              "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
              "υ": "u", "χ": "x", "ω": "w", "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "i", "đ": "d"}
# L, 1 and i look alike, so they are one letter.
SIGNS = {"0": "o", "1": "i", "l": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "€": "e"}
# Signs that may cut a word in two, of which some stand for i; and others that read as a hyphen.
_CUTS = "".join(c for c in string.punctuation if c not in SIGNS)
_STROKES = "!|"
_HYPHENS = (0xB7, *range(0x2010, 0x2016), 0x2018, 0x2019, 0x2022, 0x2027)
_REACH = 32  # letters of a term that are looked for across signs


def _table() -> dict[int, str | None]:
    table: dict[int, str | None] = {c: " " for c in range(128) if not chr(c).isalnum() and chr(c) not in _CUTS}
    table.update({ord(a): b for a, b in [*LOOKALIKES.items(), *SIGNS.items()]})
    table.update({c: None for c in (0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF)})
    table.update({c: " " for c in (*range(0x2010, 0x2060), 0xA0, 0xA1, 0xAB, 0xB7, 0xBB, 0xBF)})
    table.update(dict.fromkeys(_HYPHENS, "-"))
    return table


_FOLD = _table()
_MARK = re.compile("[\u0300-\u036f]+")
_DROPPED = {ord(c): None for c in _CUTS}
_STROKED = _DROPPED | {ord(c): "i" for c in _STROKES}
# Bytes below 128 fold and part words by table; letters outside ASCII that fold are few, so they are looked for.
_BYTES = bytes(ord(_FOLD.get(b, chr(b))) if b < 128 else b for b in range(256))
_SPACED = bytes(32 if chr(b) in _CUTS else b for b in range(256))
_FOREIGN = re.compile("[" + "".join(chr(c) for c in _FOLD if c >= 128) + "]")
_CUT, _LETTER = f"[{re.escape(_CUTS)}]", rf"[^\s{re.escape(_CUTS)}]"
# Words cut by single signs, or led by a stroke; possessive, so long words are read once.
_CUT_WORDS = re.compile(f"(?<!{_LETTER})(?:[{_STROKES}]{_LETTER}++(?:{_CUT}{_LETTER}++)*+"
                        f"|{_LETTER}++(?:{_CUT}{_LETTER}++)++)")
_FIRST_CUT = re.compile(_CUT)
_NOT = re.compile(f"{_CUT}t(?!{_LETTER})")  # the end of can't


def fold_signed(text: str) -> str:
    """Folded text with a space before it, each accent behind its letter, and the signs that may cut words."""
    low = text.lower()
    if not low.isascii():
        low = unicodedata.normalize("NFKD", low)
    folded = _by_bytes(low, _BYTES)
    return " " + (folded if folded.isascii() else _FOREIGN.sub(lambda m: _FOLD[ord(m[0])] or "", folded))


def _by_bytes(text: str, table: bytes) -> str:
    """``text`` with its ASCII characters replaced by table; far faster than str.translate outside ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(table).decode("utf-8", "surrogatepass")


def fold_marked(text: str) -> str:
    """Folded text with a space before every word, each accent behind its letter."""
    return _by_bytes(fold_signed(text), _SPACED)


def unmarked(folded: str) -> str:
    return folded if folded.isascii() else _MARK.sub("", folded)


def fold(text: str) -> str:
    """Folded text with a space before every word."""
    return unmarked(fold_marked(text))


@dataclass(frozen=True)
class Lexicon:
    """Terms, each the start of a word, with weights; exception phrases; the margin's coefficients."""

    weights: Mapping[str, float]
    exceptions: Sequence[str] = EXCEPTIONS
    coefficients: tuple[float, float, float] = (0.6, 0.4, -3.0)
    seeds: Sequence[str] = field(default=SEEDS)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in sorted(self.weights.items(), key=lambda x: x[1]):  # of terms that fold alike, the heaviest
            folded = fold_marked(term)
            found.add_word(folded, (len(folded) - 1, weight))
        for phrase in self.exceptions:
            for ending in (" ", "s ", "es "):
                folded = fold(phrase) + ending
                found.add_word(folded, (len(folded) - 1, None))
        found.make_automaton()
        return found


def _marked_hits(marked: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, float]]:
    """Start, length without accents, and weight of the hits whose term has accents."""
    found = ((end - length + 1, length, weight) for end, (length, weight) in automaton.iter(marked)
             if weight is not None)
    plain = ((start, len(unmarked(marked[start:start + length])), length, weight) for start, length, weight in found)
    return [(start, short, weight) for start, short, length, weight in plain if short < length]


def _cut_hits(signed: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, float]]:
    """Start, length and weight of the hits that go over a sign inside a word: dropped, or a stroke read as i."""
    hits = []
    for run in _CUT_WORDS.finditer(signed):
        word = run.group()
        for at in (0, *[m.end() for m in _FIRST_CUT.finditer(word, 1)]):
            piece = word[at:at + 4 * _REACH]
            first = _FIRST_CUT.search(piece)
            if not first:
                continue
            tables = [_DROPPED] if first.start() else []
            if any(c in piece for c in _STROKES):
                tables.append(_STROKED)
            for table in tables:
                read, before = piece.translate(table), piece[:first.start()]
                for letters, cut in {(read, len(before)), (unmarked(read), len(unmarked(before)))}:
                    hits += [(run.start() + at, length, weight) for end, (length, weight)
                             in automaton.iter(" " + letters)
                             if weight is not None and end == length and length > cut]
    return hits


def _weighted_hits(signed: str, automaton: ahocorasick.Automaton) -> tuple[float, int]:
    """Sum of the weights of hits outside exceptions, the heaviest per word start; and their number."""
    hits: dict[int, tuple[int, float]] = {}
    safe = []
    marked = _by_bytes(signed, _SPACED)
    plain, folded = unmarked(signed), unmarked(marked)
    found = [(end - length + 1, length, weight) for end, (length, weight) in automaton.iter(folded + " ")]
    others = _cut_hits(signed, automaton)
    if len(folded) < len(marked):
        others += _marked_hits(marked, automaton)
    at = before = 0
    for start, length, weight in sorted(others):
        before += len(unmarked(marked[at:start]))
        at = start
        found.append((before, length, weight))
    for start, length, weight in found:
        if weight is None:
            if not _NOT.match(plain, start + length - 1):
                safe.append((start, start + length - 1))
        elif weight >= hits.get(start, (0, 0.0))[1]:
            hits[start] = (length, weight)
    if safe:
        hits = {s: h for s, h in hits.items() if not any(a <= s and s + h[0] - 1 <= b for a, b in safe)}
    return sum(w for _, w in hits.values()), len(hits)


def features(text: str | None, automaton: ahocorasick.Automaton) -> tuple[float, float, int]:
    """Weighted hits and weighted hits per hundred words, both on a log scale; the number of hits."""
    if not text:
        return 0.0, 0.0, 0
    weight, n = _weighted_hits(fold_signed(text), automaton) if len(automaton) else (0.0, 0)
    weight = max(0.0, weight)
    per_hundred = 100 * weight / max(10, len(text.encode("utf-8", "surrogatepass").split()))
    return float(np.log1p(weight)), float(np.log1p(per_hundred)), n


def _words(text: str) -> list[tuple[str, str]]:
    """The folded words of a text, each with accents and without."""
    pairs = [(w, unmarked(w)) for w in fold_marked(text).split()]
    return [p for p in pairs if p[1]]


def _starts(marked: str, plain: str) -> set[str]:
    """A word's starts, with accents and without, and the empty one that every word has."""
    found = {""}
    if len(plain) >= _STARTS[0]:
        found.update([plain, *[plain[:k] for k in _STARTS]])
        if len(marked) > len(plain):
            letters = [i for i, c in enumerate(marked) if not _MARK.match(c)] + [len(marked)]
            found.update([marked, *[marked[:letters[min(k, len(plain))]] for k in _STARTS]])
    return found


def learn_terms(rows: DataFrame, text: str) -> dict[str, float]:
    """Terms over-represented in toxic rows, with their log odds.

    Terms are whole words and their starts, with their accents or without. A
    clean document counts a term as often as it occurs, so one that is rare in
    clean text may still count. Toxic documents count it once for each
    different word with its neighbours: copies and shared passages repeat
    these, so their harmless words gather no weight. A term is kept where so
    large a toxic share of its places would be unlikely for any of the terms
    tried, were its odds ``_LIFT`` times those of all words (Chernoff's bound).
    A start goes where one longer term has nearly all of its places; of the
    terms left that begin alike, the one with the strongest evidence stays.
    """
    source = rows.select(quoted(text).alias("text"), F.col("label"))
    sizes = source.agg(F.sum("label").alias("toxic"), F.count("label").alias("n")).first()
    n_toxic, n = int(sizes["toxic"] or 0), int(sizes["n"])
    if not n_toxic or n_toxic == n:
        return {}

    def places(batches):
        for batch in batches:
            for t in batch.column(0).to_pylist():
                terms, at = [], []
                words = _words(t or "")
                plain = ["", *[w for _, w in words], ""]
                for i, word in enumerate(words):
                    found = _starts(*word)
                    terms += found
                    at += [xxhash.xxh3_64_intdigest(" ".join(plain[i:i + 3]).encode("utf-8", "replace"))] * len(found)
                doc = xxhash.xxh3_64_intdigest((t or "").encode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms, pa.string()), pa.array(np.array(at, np.uint64).view(np.int64)),
                     pa.array(np.full(len(at), doc, np.uint64).view(np.int64))], ["term", "place", "doc"])

    def count(batches):
        for batch in batches:
            words: Counter = Counter()
            for t in batch.column(0).to_pylist():
                words.update(_words(t or ""))
            seen: Counter = Counter()
            for word, times in words.items():
                for term in _starts(*word):
                    seen[term] += times
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["of", "clean"])

    toxic = (source.where("label > 0").mapInArrow(places, "term string, place long, doc long")
             .groupBy("term", "place").agg(F.min("doc").alias("doc"))
             .groupBy("term").agg(F.count(F.lit(1)).alias("toxic"), F.count_distinct("doc").alias("docs")))
    clean = (source.where("label = 0").mapInArrow(count, "of string, clean long")
             .groupBy("of").agg(F.sum("clean").alias("clean")))
    terms = durable(toxic.join(clean, F.col("term") == F.col("of"), "left")
                    .select("term", "toxic", "docs", F.coalesce("clean", F.lit(0)).alias("clean")), "toxic-terms")
    every = terms.where("term = ''").first()
    if every is None:
        return {}
    n_toxic, n_clean = every["toxic"], every["clean"]
    least = float(np.log(max(terms.count(), 2)))
    chance = _LIFT * (n_toxic + 1) / (_LIFT * (n_toxic + 1) + n_clean + 1)
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    evidence = (F.col("toxic") * F.log(share / chance)
                + F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - chance))).otherwise(0.0))
    likely = terms.where((F.col("term") != "") & (F.col("docs") >= _DOCUMENTS) & (share > chance) & (evidence >= least))
    kept = {r["term"]: r for r in likely.select("*", evidence.alias("evidence")).collect()}  # few of a bounded sample's
    for term in sorted(kept, key=len, reverse=True):
        for k in range(1, len(term)):
            if term in kept and term[:k] in kept and kept[term]["toxic"] >= 0.9 * kept[term[:k]]["toxic"]:
                del kept[term[:k]]
    chosen: dict[str, float] = {}
    begun: set[str] = set()
    for term in sorted(kept, key=lambda t: (-kept[t]["evidence"], t)):
        if term not in begun and not any(term[:k] in chosen for k in range(1, len(term))):
            begun.update(term[:k] for k in range(1, len(term)))
            chosen[term] = float(np.log((kept[term]["toxic"] + 0.5) / (n_toxic + 1))
                                 - np.log((kept[term]["clean"] + 0.5) / (n_clean + 1)))
    return chosen


def weights_of(log_odds: Mapping[str, float], power: float = POWER, seeds: Sequence[str] = SEEDS) -> dict[str, float]:
    """Weights of learned terms and of seeds that were not learned.

    A power above one lets one sure hit outweigh several that clean documents
    have too; eight is the largest weight.
    """
    learned = {t: float(np.clip(x, 0.0, 8.0) ** power / 8 ** (power - 1)) for t, x in log_odds.items()}
    return {fold(s).strip(): _SEED_WEIGHT for s in seeds} | learned


def _fitted(rows: DataFrame, weights: Mapping[str, float], exceptions: Sequence[str], bound: int) -> Lexicon:
    """The weights with a margin fitted on at most ``bound`` labelled rows."""
    lexicon = Lexicon(weights, exceptions)
    x = (with_features(rows, "text", lexicon).select("hit_weight", "hit_density", "label").limit(bound)
         .toPandas().to_numpy(float))
    if not len(x) or x[:, 2].min() == x[:, 2].max():
        return lexicon
    slopes, intercept = fit_logistic(x[:, :2], x[:, 2])
    return Lexicon(weights, exceptions, (float(slopes[0]), float(slopes[1]), intercept))


def _sample(docs: DataFrame, labels: DataFrame, text: str, label: str, bound: int) -> DataFrame:
    return durable(labelled_rows(docs, labels, label, bound).select(quoted(text).alias("text"), "label"), "toxic-sample")


def learn(docs: DataFrame, labels: DataFrame, *, text: str = "text", label: str = "toxic", bound: int = SAMPLE,
          exceptions: Sequence[str] = EXCEPTIONS, power: float = POWER) -> Lexicon:
    """Learn terms and the margin on at most ``bound`` labelled rows that are not held out.

    Null and empty texts teach the margin alone; very long texts are read
    whole. A null label is no label, a key labelled twice has the larger one,
    repeated rows teach once each. Without rows of both classes, as in empty
    tables, the seeds and fixed coefficients remain. Other columns are ignored.
    """
    rows = _sample(docs, labels, text, label, bound)
    return _fitted(rows, weights_of(learn_terms(rows, "text"), power), exceptions, bound)


def power_errors(docs: DataFrame, labels: DataFrame, powers: Sequence[float] = (1.0, 1.25, 1.5, 1.75, 2.0, 3.0), *,
                 folds: int = 3, text: str = "text", label: str = "toxic", bound: int = SAMPLE,
                 threshold: float = THRESHOLD) -> dict[float, tuple[int, int, float]]:
    """Toxic rows missed, clean rows called toxic, and mean log loss of each power.

    Cross-validated on the rows that labels may teach from; equal texts share a
    fold. Held-out rows play no part.
    """
    rows = _sample(docs, labels, text, label, bound)
    fold_of = F.pmod(F.xxhash64("text"), F.lit(folds))
    totals = {power: np.zeros(4) for power in powers}
    for k in range(folds):
        rest, tested = rows.where(fold_of != k), rows.where(fold_of == k)
        log_odds = learn_terms(rest, "text")
        for power in powers:
            scored = score(tested, _fitted(rest, weights_of(log_odds, power), EXCEPTIONS, bound), threshold=threshold)
            toxic, p = F.col("label") > 0, F.greatest(F.least("score", F.lit(1 - 1e-6)), F.lit(1e-6))
            totals[power] += [x or 0 for x in scored.agg(
                F.count_if(toxic & (F.col("predicted") == 0)), F.count_if(~toxic & (F.col("predicted") == 1)),
                F.sum(-F.log(F.when(toxic, p).otherwise(1 - p))), F.count(F.lit(1))).first()]
    return {power: (int(t[0]), int(t[1]), float(t[2] / max(1, t[3]))) for power, t in totals.items()}


_FIELDS = [T.StructField("hit_weight", T.DoubleType()), T.StructField("hit_density", T.DoubleType()),
           T.StructField("hits", T.IntegerType())]


def with_features(df: DataFrame, text: str, lexicon: Lexicon) -> DataFrame:
    """Append ``hit_weight, hit_density, hits``; 0 for null and empty texts."""
    def make():
        automaton = lexicon.automaton()

        def work(texts):
            rows = [features(t, automaton) for t in texts]
            return [pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.float64()),
                    pa.array([r[2] for r in rows], pa.int32())]

        return work

    return map_text(df, text, make, _FIELDS)


def score(docs: DataFrame, lexicon: Lexicon, *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with ``hits``, ``score`` from 0 to 1, and ``predicted``: 1 from ``threshold`` on.

    Only the text decides: null and empty texts get the score of a text
    without hits. Rows are scored one by one, so repeated rows score alike and
    an empty table stays empty; very long texts are read whole, at a cost in
    proportion to their length. Length is words between ASCII white space.
    Columns of the result's names are replaced.
    """
    a, b, c = lexicon.coefficients
    source = docs.select(*[quoted(x) for x in without(docs, "score", "predicted")])
    margin = F.lit(a) * F.col("hit_weight") + F.lit(b) * F.col("hit_density") + F.lit(c)
    return (with_features(source, text, lexicon)
            .withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
            .drop("hit_weight", "hit_density"))
