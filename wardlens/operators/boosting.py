"""Boosted trees of MLlib's algorithm, grown by tasks that keep their rows.

MLlib submits a job of two stages for every level of every tree, thousands of
them in a row, and on most tables a level's work is far below what its job
costs. Here one job grows the whole ensemble. Rows are binned once, by MLlib's
own split points, and dealt over tasks that hold them as bytes; a level costs a
pass over them, and an exchange of histograms where there are several tasks.

What is grown is MLlib's ensemble: the same rows drawn per round and the same
features per node from the same random numbers, sums added in the same order,
ties settled alike. It is written in MLlib's saved form and loaded from there.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.functions.scalar import quoted
from wardlens.session import local_folder, scratch_path

BLOCK = 1024  # rows that are dealt together
TASK_CELLS = 4_000_000  # bins (rows times features) below which a second task does not pay
EXACT_ROWS = 20_000  # rows up to which all sums are added up from rows, in MLlib's order
LARGE = 2000  # drawn rows from which, in larger tables, a node's sums give one child's as the rest of the other's
_LANES = 4
_CHUNK_ROWS = 16_384  # rows of a pass over all features
_PATIENCE = 3600  # seconds that a task waits for another's sums
_EPSILON = 2.0 ** -52
_INVALID = -1.7976931348623157e308
_BLOCKS = "part int, start long, bins binary, label binary, weight binary"
_NODES = ("tree int, id int, prediction double, impurity double, stats array<double>, count long, gain double, "
          "left int, right int, feature int, threshold double")


# Random numbers of the JVM: java.util.Random and Spark's XORShiftRandom.

def _u64(x: int) -> int:
    return x & 0xFFFFFFFFFFFFFFFF


class JavaRandom:
    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _next(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        top = self.state >> 16
        return top - (1 << 32) if top >> 31 else top

    def next_long(self) -> int:
        """As an unsigned number."""
        return _u64((self._next() << 32) + self._next())


def _murmur(words: tuple[np.ndarray, ...], seed: np.ndarray) -> np.ndarray:
    """Hash of 32-bit words, each an array in 64 bits."""
    low = np.uint64(0xFFFFFFFF)

    def rotated(x, by):
        return ((x << np.uint64(by)) | (x >> np.uint64(32 - by))) & low

    h = seed
    for k in words:
        k = rotated((k * np.uint64(0xCC9E2D51)) & low, 15)
        h = rotated(h ^ ((k * np.uint64(0x1B873593)) & low), 13)
        h = (h * np.uint64(5) + np.uint64(0xE6546B64)) & low
    h = h ^ np.uint64(4 * len(words))
    h = ((h ^ (h >> np.uint64(16))) * np.uint64(0x85EBCA6B)) & low
    h = ((h ^ (h >> np.uint64(13))) * np.uint64(0xC2B2AE35)) & low
    return h ^ (h >> np.uint64(16))


def hashed_seeds(seeds: np.ndarray) -> np.ndarray:
    """First states of Spark's generator for unsigned seeds."""
    swapped = seeds.astype("<u8").byteswap()  # the hash reads the bytes of a big-endian number as little-endian words
    words = (swapped & np.uint64(0xFFFFFFFF), swapped >> np.uint64(32))
    low = _murmur(words, np.full(len(seeds), 0x3C074A61, "uint64"))
    return (_murmur(words, low) << np.uint64(32)) | low


def _stepped(state: np.ndarray) -> np.ndarray:
    state = state ^ (state << np.uint64(21))
    state = state ^ (state >> np.uint64(35))
    return state ^ (state << np.uint64(4))


def _unit(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A double in [0, 1) from two successive states."""
    high = (first & np.uint64((1 << 26) - 1)) << np.uint64(27)
    return (high + (second & np.uint64((1 << 27) - 1))).astype(float) * 2.0 ** -53


class _Jumps:
    """2^k steps of the generator at once: it is linear over bits, so a jump is a table per byte."""

    def __init__(self):
        self.tables, self.columns = [], _stepped(np.uint64(1) << np.arange(64, dtype="uint64"))

    def table(self, k: int) -> np.ndarray:
        while len(self.tables) <= k:
            if self.tables:
                self.columns = self._by(self.tables[-1], self.columns)
            table = np.zeros((8, 256), "uint64")
            for byte in range(8):
                for bit in range(8):
                    table[byte, 1 << bit:2 << bit] = table[byte, :1 << bit] ^ self.columns[8 * byte + bit]
            self.tables.append(table)
        return self.tables[k]

    @staticmethod
    def _by(table: np.ndarray, state: np.ndarray) -> np.ndarray:
        out = table[0][state & np.uint64(255)]
        for byte in range(1, 8):
            out ^= table[byte][(state >> np.uint64(8 * byte)) & np.uint64(255)]
        return out

    def jumped(self, state: np.ndarray, k: int) -> np.ndarray:
        return self._by(self.table(k), state)


_LANE = 16  # states of a lane, stepped one after the other; lanes are reached by jumps


class Draws:
    """Which rows a round draws: row i of partition p by number i of the generator seeded with the round and p.

    ``start`` is the place of a block's first row in its partition. A block's
    numbers are reached by jumps, so a task can hold any blocks.
    """

    def __init__(self, part: np.ndarray, start: np.ndarray, rows: np.ndarray):
        self.part, self.start, self.jumps = part, start, _Jumps()
        self.kept = np.arange(BLOCK)[None] < rows[:, None]

    def __call__(self, seed: int, fraction: float) -> np.ndarray:
        if not len(self.part):
            return np.zeros(0, bool)
        parts, where = np.unique(self.part, return_inverse=True)
        seeds = np.array([_u64(seed + int(p) + 1) for p in parts], "uint64")
        state, ahead, k = hashed_seeds(seeds)[where], self.start * 2, 0
        while (ahead >> k).any():
            far = ((ahead >> k) & 1).astype(bool)
            state[far] = self.jumps.jumped(state[far], k)
            k += 1
        lanes = state[:, None]
        for k in range((2 * BLOCK // _LANE).bit_length() - 1):
            far = self.jumps.jumped(lanes, k + _LANE.bit_length() - 1)
            lanes = np.concatenate([lanes, far], axis=1)
        drawn = np.empty((*lanes.shape, _LANE // 2), bool)
        for pair in range(_LANE // 2):
            first = _stepped(lanes)
            lanes = _stepped(first)
            drawn[:, :, pair] = _unit(first, lanes) < fraction
        return drawn.reshape(len(lanes), BLOCK)[self.kept]


def feature_subsets(seeds: list[int], features: int, wanted: int) -> np.ndarray:
    """Per node: the reservoir sample of features of its seed, in the sample's order."""
    state = hashed_seeds(np.array(seeds, "uint64"))
    out, at = np.tile(np.arange(wanted), (len(seeds), 1)), np.arange(len(seeds))
    for item in range(wanted, features):
        first = _stepped(state)
        state = _stepped(first)
        place = (_unit(first, state) * float(item + 1)).astype("int64")
        inside = place < wanted
        out[at[inside], place[inside]] = item
    return out


def java_exp(x: np.ndarray) -> np.ndarray:
    """The exponential of fdlibm, which the JVM uses; other libraries differ in the last bit."""
    k = np.where(np.abs(x) > 0.5 * 0.6931471805599453, np.trunc(1.4426950408889634 * x + np.where(x < 0, -0.5, 0.5)), 0.0)
    k = np.where((np.abs(x) > 0.5 * 0.6931471805599453) & (np.abs(x) < 1.5 * 0.6931471805599453), np.sign(x), k)
    high, low = x - k * 6.93147180369123816490e-01, k * 1.90821492927058770002e-10
    r = high - low
    t = r * r
    c = r - t * (1.66666666666666019037e-01 + t * (-2.77777777770155933842e-03 + t * (
        6.61375632143793436117e-05 + t * (-1.65339022054652515390e-06 + t * 4.13813679705723846039e-08))))
    near = 1.0 - ((r * c) / (c - 2.0) - r)
    far = 1.0 - ((low - (r * c) / (2.0 - c)) - high)
    with np.errstate(over="ignore", under="ignore"):
        y = np.ldexp(np.where(k == 0, near, far), np.clip(k, -1080, 1080).astype("int32"))
    y = np.where(np.abs(x) < 2.0 ** -28, 1.0 + x, y)
    return np.where(x > 7.09782712893383973096e+02, np.inf, np.where(x < -7.45133219101941108420e+02, 0.0, y))


# Growing.

@dataclass(frozen=True)
class Growth:
    """What a task must know: the settings, and each feature's split points."""

    thresholds: tuple[np.ndarray, ...]
    rounds: int
    step: float
    depth: int
    row_fraction: float
    features_per_node: int
    min_rows: int
    seed: int
    memory: int
    shortened: bool


class Layout:
    """Where features' bins and splits lie in a histogram.

    Features are counted in groups of ``lanes``: additions that follow each
    other then go to different cells, and none waits for the one before it.
    A group that is not full ends with one cell for its missing features.
    """

    def __init__(self, thresholds: tuple[np.ndarray, ...]):
        splits = np.array([len(t) for t in thresholds])
        self.bins = splits + 1
        self.lanes = min(_LANES, len(splits))
        groups = -(-len(splits) // self.lanes)
        # Wide features apart from each other, so that groups are alike.
        order = np.argsort(-self.bins, kind="stable")
        self.group, self.lane = np.empty(len(splits), int), np.empty(len(splits), int)
        self.group[order], self.lane[order] = np.arange(len(splits)) % groups, np.arange(len(splits)) // groups
        self.offset, self.start = np.zeros(len(splits), int), np.zeros(len(splits), int)
        self.groups, self.width = [], 0  # first cell and cells of each group
        for g in range(groups):
            mine, cells = np.flatnonzero(self.group == g), 0
            for f in mine:
                self.offset[f], cells = cells, cells + int(self.bins[f])
            self.start[mine] = self.width + self.offset[mine]
            self.groups.append((self.width, cells + (len(mine) < self.lanes)))
            self.width += self.groups[-1][1]
        self.code = np.min_scalar_type(max(cells for _, cells in self.groups) - 1)
        self.usable = np.flatnonzero(splits)  # features with a split
        self.place = np.full(len(splits), -1)
        self.place[self.usable] = np.arange(len(self.usable))
        of = np.repeat(self.usable, splits[self.usable])
        self.first = np.r_[0, np.cumsum(splits[self.usable])[:-1]].astype(int)  # a usable feature's first split
        self.splits = splits[self.usable]
        self.left = self.start[of] + np.arange(len(of)) - self.first[self.place[of]]
        self.total = self.start[of] + splits[of]
        self.carry = [self.start[self.bins > k] + k for k in range(1, int(self.bins.max(initial=1)))]


def impurity(weight: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Variance; zero without rows."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(weight == 0, 0.0, (squares - (total * total) / weight) / weight)


def best_splits(sums: np.ndarray, layout: Layout, subsets: np.ndarray, parent: np.ndarray | None,
                min_rows: int) -> dict[str, np.ndarray]:
    """Per node the split of the highest gain, the first one in the order of its features.

    ``sums`` has weight, weighted label, weighted squared label and count per
    node and bin, and is changed. ``parent`` are the nodes' own four sums, none
    for a root, which takes them from its first split.
    """
    nodes = sums.shape[1]
    for columns in layout.carry:
        sums[:, :, columns] += sums[:, :, columns - 1]
    left = sums[:, :, layout.left]
    right = sums[:, :, layout.total] - left
    places = layout.place[subsets]
    if parent is None:
        usable = places[0][places[0] >= 0]
        one = layout.first[usable[0]] if len(usable) else None
        parent = (left[:, :, one] + right[:, :, one]) if one is not None else sums[:, :, layout.bins[subsets[0, 0]] - 1 + layout.start[subsets[0, 0]]]
    own = impurity(parent[0], parent[1], parent[2])
    both = left[0] + right[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = own[:, None] - left[0] / both * impurity(*left[:3]) - right[0] / both * impurity(*right[:3])
    gain[(left[3] < min_rows) | (right[3] < min_rows) | (gain < 0)] = _INVALID
    at = np.arange(nodes)
    if len(layout.usable):
        best = np.maximum.reduceat(gain, layout.first, axis=1)
        among = np.where(places >= 0, np.take_along_axis(best, np.maximum(places, 0), axis=1), -np.inf)
        chosen = among.argmax(axis=1)
        top = among[at, chosen]
        place = np.maximum(places[at, chosen], 0)
        cells = layout.first[place][:, None] + np.arange(layout.splits.max())
        inside = np.arange(layout.splits.max()) < layout.splits[place][:, None]
        split = np.where(inside, gain[at[:, None], np.minimum(cells, gain.shape[1] - 1)], -np.inf).argmax(axis=1)
        cell = layout.first[place] + split
        pick, feature = (left[:, at, cell], right[:, at, cell]), layout.usable[place]
    else:
        top, split, feature = np.full(nodes, -np.inf), np.zeros(nodes, int), np.zeros(nodes, int)
        pick = (np.zeros((4, nodes)), np.zeros((4, nodes)))
    return {"gain": top, "valid": top > _INVALID, "feature": feature, "split": split, "own": parent,
            "impurity": own, "left": pick[0], "right": pick[1]}


class Grown:
    """A tree as it grows: one list entry per node, children after their parents."""

    def __init__(self):
        self.sums, self.impurity, self.gain, self.level = [None], [0.0], [-1.0], [0]
        self.feature, self.split, self.left, self.right, self.valid = [-1], [-1], [-1], [-1], [True]

    def add(self, sums: np.ndarray, impure: float, level: int) -> int:
        for column, value in ((self.sums, sums), (self.impurity, impure), (self.gain, -1.0), (self.level, level),
                              (self.feature, -1), (self.split, -1), (self.left, -1), (self.right, -1), (self.valid, True)):
            column.append(value)
        return len(self.sums) - 1

    def values(self) -> np.ndarray:
        sums = np.array(self.sums)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(sums[:, 0] == 0, 0.0, sums[:, 1] / sums[:, 0])

    def rows(self, tree: int, thresholds: tuple[np.ndarray, ...]) -> list[tuple]:
        """Nodes in MLlib's saved order, a parent before its left branch; equal sibling leaves merge."""
        values, out = self.values(), []
        leaf = [l < 0 for l in self.left]
        for i in range(len(leaf) - 1, -1, -1):
            if not leaf[i]:
                a, b = self.left[i], self.right[i]
                leaf[i] = leaf[a] and leaf[b] and values[a] == values[b]
                if leaf[i]:
                    values[i] = values[a]
        stack = [(0, -1, False)]
        while stack:
            i, above, is_right = stack.pop()
            if above >= 0:
                out[above][8 if is_right else 7] = len(out)
            sums = self.sums[i]
            impure = self.impurity[i] if self.valid[i] else -1.0
            row = [tree, len(out), float(values[i]), float(impure), [float(v) for v in sums[:3]], int(sums[3]), -1.0, -1, -1, -1, None]
            if not leaf[i]:
                row[6], row[9] = float(self.gain[i]), int(self.feature[i])
                row[10] = float(thresholds[self.feature[i]][self.split[i]])
                stack += [(self.right[i], len(out), True), (self.left[i], len(out), False)]
            out.append(row)
        return out


class Rows:
    """A task's rows: the cells of their bins by groups of features, labels of -1 and 1, weights."""

    def __init__(self, blocks: list[tuple], layout: Layout):
        blocks.sort(key=lambda b: (b[0], b[1]))
        bins = [np.frombuffer(b[2], "uint8").reshape(len(layout.bins), -1) for b in blocks]
        self.label = np.concatenate([np.frombuffer(b[3]) for b in blocks]) if blocks else np.zeros(0)
        self.weight = np.concatenate([np.frombuffer(b[4]) for b in blocks]) if blocks else np.zeros(0)
        sizes = np.array([x.shape[1] for x in bins], "int64")
        self.cells = np.empty((len(layout.groups), len(self.label), layout.lanes), layout.code)
        for g, (_, cells) in enumerate(layout.groups):
            self.cells[g] = cells - 1
            for f in np.flatnonzero(layout.group == g):
                at = 0
                for x in bins:
                    self.cells[g, at:at + x.shape[1], layout.lane[f]] = x[f] + layout.offset[f]
                    at += x.shape[1]
        self.draws = Draws(np.array([b[0] for b in blocks], "int64"), np.array([b[1] for b in blocks], "int64"), sizes)

    def histograms(self, rows: np.ndarray, slot: np.ndarray, nodes: int, label: np.ndarray, counted: bool,
                   layout: Layout) -> np.ndarray:
        """Weight, weighted label, weighted squared label and count per node and bin, added in the rows' order.

        A complex number carries two sums through one pass. Uncounted, the
        weight stands for the count.
        """
        one = [np.zeros(nodes * cells, complex) for _, cells in layout.groups]
        two = [np.zeros(nodes * cells, complex if counted else float) for _, cells in layout.groups]
        for low in range(0, len(rows), _CHUNK_ROWS):
            some, at = rows[low:low + _CHUNK_ROWS], slot[low:low + _CHUNK_ROWS, None]
            weight, y = self.weight[some], label[some]
            weighted = weight * y
            squared = weighted * y
            first = np.repeat(weight + 1j * weighted, layout.lanes)
            second = np.repeat(squared + 1j if counted else squared, layout.lanes)
            for g, (_, cells) in enumerate(layout.groups):
                cell = (at * cells + np.take(self.cells[g], some, axis=0)).ravel()
                np.add.at(one[g], cell, first)
                np.add.at(two[g], cell, second)
        out = np.empty((4, nodes, layout.width))
        for a, b, (start, cells) in zip(one, two, layout.groups):
            for k, sums in enumerate((a.real, a.imag, b.real, b.imag if counted else a.real)):
                out[k, :, start:start + cells] = sums.reshape(nodes, cells)
        return out


def grow_tree(data: Rows, growth: Growth, layout: Layout, label: np.ndarray, seed: int, summed) -> tuple[Grown, np.ndarray]:
    """One tree on the rows that the seed draws, and the leaf value of every row.

    A node's sums are added up from its rows, so that ties between splits are
    settled as MLlib settles them. Tables of more than ``EXACT_ROWS``, which
    MLlib adds up in changing orders if they have several partitions, do so
    for the smaller child of a large node; the other's sums are what is left
    of the node's. Both give the same splits but for ties.
    """
    features = len(layout.bins)
    drawn = data.draws(seed, growth.row_fraction) if growth.row_fraction < 1.0 else np.ones(len(label), bool)
    node, tree, random, stack = np.zeros(len(label), int), Grown(), JavaRandom(seed), [0]
    live, sums_of, parent_of = np.arange(len(label)), {}, {}
    # Without a least number of rows a part is empty where its weight is zero.
    counted = growth.shortened or summed is not None or growth.min_rows > 1 or not (data.weight > 0).all()
    least = growth.min_rows if counted else 5e-324
    while stack:
        group, chosen = _next_group(stack, growth, layout, random, features)
        small, rest = [], {}
        for j, i in enumerate(group):
            above = parent_of.get(i)
            other = None if above is None else tree.left[above] + tree.right[above] - i
            if above in sums_of and other in group and (tree.sums[i][3], i) > (tree.sums[other][3], other):
                rest[j] = (above, group.index(other))
            else:
                small.append(j)
        slot_of, nth_of = np.full(len(tree.sums), -1), np.full(len(group), -1)
        slot_of[group], nth_of[small] = np.arange(len(group)), np.arange(len(small))
        slot, mine = slot_of[node[live]], live
        if stack:  # a part of the nodes
            mine, slot = live[slot >= 0], slot[slot >= 0]
        took = drawn[mine]
        seen, at = mine[took], slot[took]
        if rest:
            at = nth_of[at]
            seen, at = seen[at >= 0], at[at >= 0]
        found = data.histograms(seen, at, len(small), label, counted, layout)
        if summed:
            found = summed(found)
        if rest:
            sums = np.empty((4, len(group), layout.width))
            sums[:, small] = found
            for j, (above, other) in rest.items():
                sums[:, j] = sums_of[above] - sums[:, other]
        else:
            sums = found
        kept = {}
        if growth.shortened:
            size = sums[3, :, layout.start[0]:layout.start[0] + layout.bins[0]].sum(axis=1)
            kept = {i: sums[:, j].copy() for j, i in enumerate(group) if size[j] >= LARGE}
        parent = None if group == [0] else np.array([tree.sums[i] for i in group]).T
        best = best_splits(sums, layout, chosen, parent, least)
        left_of, right_of = np.full(len(group), -1), np.full(len(group), -1)
        li, ri = impurity(*best["left"][:3]), impurity(*best["right"][:3])
        for j, i in enumerate(group):
            if i == 0:
                tree.sums[0] = best["own"][:, 0]
                if not counted:
                    tree.sums[0][3] = drawn.sum()
            tree.impurity[i], tree.gain[i], tree.valid[i] = best["impurity"][j], best["gain"][j], bool(best["valid"][j])
            if best["gain"][j] <= 0 or tree.level[i] == growth.depth:
                continue
            tree.feature[i], tree.split[i] = int(best["feature"][j]), int(best["split"][j])
            level = tree.level[i] + 1
            tree.left[i] = left_of[j] = tree.add(best["left"][:, j], li[j], level)
            tree.right[i] = right_of[j] = tree.add(best["right"][:, j], ri[j], level)
            if level < growth.depth:
                more = [c for c, impure in ((tree.left[i], li[j]), (tree.right[i], ri[j])) if abs(impure) >= _EPSILON]
                stack += more
                if len(more) == 2 and i in kept:
                    sums_of[i], parent_of[more[0]], parent_of[more[1]] = kept[i], i, i
        split, moved = left_of >= 0, mine
        if not split.all():
            moved, slot = mine[split[slot]], slot[split[slot]]
        if len(moved):
            feature = best["feature"][slot]
            over = data.cells[layout.group[feature], moved, layout.lane[feature]] > best["split"][slot] + layout.offset[feature]
            node[moved] = np.where(over, right_of[slot], left_of[slot])
        if not counted:
            for i, n in enumerate(np.bincount(node[moved[drawn[moved]]], minlength=len(tree.sums)).tolist()):
                if n:
                    tree.sums[i][3] = n
        waiting = np.zeros(len(tree.sums), bool)
        waiting[stack] = True
        if not waiting[node[live]].all():
            live = live[waiting[node[live]]]
        for above in {parent_of.pop(i) for i in group if i in parent_of}:
            if tree.left[above] not in parent_of and tree.right[above] not in parent_of:
                sums_of.pop(above, None)
    return tree, tree.values()[node]


def _next_group(stack: list[int], growth: Growth, layout: Layout, random: JavaRandom, features: int) -> tuple[list[int], np.ndarray]:
    """Nodes off the stack, as many as MLlib takes in a pass of its memory, and each one's features."""
    some, group, chosen, used = growth.features_per_node < features, [], [], 0
    if 24 * layout.width * len(stack) <= growth.memory:  # all of them, whatever their features
        group, stack[:] = stack[::-1], []
        if not some:
            return group, np.repeat(np.arange(features)[None], len(group), axis=0)
        return group, feature_subsets([random.next_long() for _ in group], features, growth.features_per_node)
    while stack:
        mine = feature_subsets([random.next_long()], features, growth.features_per_node)[0] if some else np.arange(features)
        size = 24 * int(layout.bins[mine].sum())
        if group and used + size > growth.memory:
            break
        group.append(stack.pop())
        chosen.append(mine)
        used += size
    return group, np.array(chosen)


def grow(data: Rows, growth: Growth, layout: Layout, summed) -> Iterator[list[tuple]]:
    """The nodes of each tree of the ensemble."""
    label, margin = data.label, np.zeros(len(data.label))
    for nth in range(growth.rounds):
        tree, values = grow_tree(data, growth, layout, label, growth.seed + nth, summed)
        yield tree.rows(nth, growth.thresholds)
        margin = values if nth == 0 else margin + values * growth.step
        label = -(-4.0 * data.label / (1.0 + java_exp(2.0 * data.label * margin)))


# As a Spark job.

def _binned(thresholds: tuple[np.ndarray, ...]):
    def run(batches):
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(thresholds))
            label = 2.0 * batch.column(1).to_numpy(zero_copy_only=False) - 1.0
            weight = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
            bins = np.stack([np.searchsorted(t, values[:, f]).astype("uint8") for f, t in enumerate(thresholds)])
            low, out = 0, []
            while low < batch.num_rows:
                high = min(low + BLOCK, batch.num_rows)
                out.append((part, start, bins[:, low:high].tobytes(), label[low:high].tobytes(), weight[low:high].tobytes()))
                start, low = start + high - low, high
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                    names=["part", "start", "bins", "label", "weight"])

    return run


class Exchange:
    """Adds up the histograms of tasks that run at the same time, through files of a folder that all of them reach.

    Every task adds all tasks' sums in the tasks' order, so all go on with the
    same numbers. Where every task has written a step's file, all have read
    those of the step before. (A barrier of Spark takes a second.)
    """

    def __init__(self, folder: str, task: int, tasks: int):
        self.folder, self.task, self.tasks, self.step = folder, task, tasks, 0

    def _path(self, step: int, task: int) -> str:
        return f"{self.folder}/{step}-{task}"

    def __call__(self, sums: np.ndarray) -> np.ndarray:
        path = self._path(self.step, self.task)
        sums.tofile(f"{path}.part")
        os.rename(f"{path}.part", path)
        total = np.zeros_like(sums)
        for task in range(self.tasks):
            total += sums if task == self.task else self._read(task).reshape(sums.shape)
        if self.step:
            os.unlink(self._path(self.step - 1, self.task))
        self.step += 1
        return total

    def _read(self, task: int) -> np.ndarray:
        path, until, pause = self._path(self.step, task), time.monotonic() + _PATIENCE, 0.0002
        while not os.path.exists(path):
            if time.monotonic() > until:
                raise TimeoutError(f"no sums of task {task} in {_PATIENCE} seconds")
            time.sleep(pause)
            pause = min(pause * 1.2, 0.005)
        return np.fromfile(path)


def _growing(shared, tasks: int, folder: str | None):
    types = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.int64(), pa.float64(),
             pa.int32(), pa.int32(), pa.int32(), pa.float64())
    names = [c.split()[0] for c in _NODES.split(", ")]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches):
        growth, task, exchange = shared.value, 0, None
        blocks = [tuple(r.values()) for b in batches for r in b.to_pylist()]
        if tasks > 1:
            context = BarrierTaskContext.get()
            task = context.partitionId()
            # The name is of this attempt: a stage that lost a task begins anew.
            mine = f"{folder}/{context.allGather(uuid.uuid4().hex)[0]}"
            os.makedirs(mine, exist_ok=True)
            exchange = Exchange(mine, task, tasks)
        kept = []
        layout = Layout(growth.thresholds)
        for nodes in grow(Rows(blocks, layout), growth, layout, exchange):
            if task == 0:
                kept += nodes
            if len(kept) > 20_000:
                yield batch(kept)
                kept = []
        if kept:
            yield batch(kept)

    return run


def _saved_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes as MLlib saves them."""
    inner = F.col("feature") >= 0
    split = F.struct(F.col("feature").alias("featureIndex"),
                     F.when(inner, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
                     F.lit(-1).alias("numCategories"))
    return nodes.select(F.col("tree").alias("treeID"), F.struct(
        "id", "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("count").alias("rawCount"), "gain",
        F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split")).alias("nodeData"))


def _save_settings(spark: SparkSession, booster, trees: int, features: int, path: str) -> None:
    """MLlib's saved form of an ensemble of the booster's settings, but for the nodes.

    A model of one leaf is saved; its tree's settings then stand for every tree.
    """
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    none = jvm.org.apache.spark.ml.param.ParamMap()
    calculator = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(gateway.new_array(jvm.double, 3), 0)
    leaf = jvm.org.apache.spark.ml.tree.LeafNode(0.0, 0.0, calculator)
    one = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, 1)
    uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID("dtr")
    one[0] = booster.copyValues(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel(uid, leaf, features), none)
    model = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        booster.uid(), one, gateway.new_array(jvm.double, 1), features, 2)
    booster.copyValues(model, none).write().save(f"{path}-one")
    settings = json.loads(spark.read.text(f"{path}-one/metadata").first()[0]) | {"numTrees": trees}
    spark.range(1).select(F.lit(json.dumps(settings)).alias("value")).coalesce(1).write.text(f"{path}/metadata")
    tree = spark.read.parquet(f"{path}-one/treesMetadata").first()[1]
    nth = F.col("id").cast("int")
    spark.range(0, trees, 1, 1).select(
        nth.alias("_1"), F.replace(F.lit(tree), F.lit(f'"{uid}"'), F.format_string(f'"{uid}_%d"', nth)).alias("_2"),
        F.when(nth == 0, 1.0).otherwise(float(booster.getStepSize())).alias("_3")).write.parquet(f"{path}/treesMetadata")


def _object(package, name: str):
    """A Scala object."""
    return getattr(getattr(package, f"{name}$"), "MODULE$")


def fit_trees(booster: GBTClassifier, vectors: DataFrame) -> GBTClassificationModel:
    """What ``booster.fit(vectors)`` gives, by one job.

    A task grows the ensemble alone up to ``TASK_CELLS`` bins, else as many as
    there are partitions and cores, which run at the same time and exchange sums
    in the scratch folder. Features are taken as numbers. Where that folder is no
    file system to Python, or executors come on demand, which bars such stages,
    large tables are left to MLlib.
    """
    spark = vectors.sparkSession
    jvm = spark._jvm
    booster._transfer_params_to_java()
    java, impl = booster._java_obj, jvm.org.apache.spark.ml.tree.impl
    instances = _object(jvm.org.apache.spark.ml.util, "DatasetUtils").extractInstances(java, vectors._jdf, jvm.scala.Option.apply(2))
    strategy = jvm.org.apache.spark.mllib.tree.configuration.Strategy.defaultStrategy("Regression")
    strategy.setMaxBins(booster.getMaxBins())
    strategy.setMinInstancesPerNode(booster.getMinInstancesPerNode())
    metadata = _object(impl, "DecisionTreeMetadata").buildMetadata(
        instances, strategy, 1, booster.getFeatureSubsetStrategy())
    features = metadata.numFeatures()
    parts = vectors.rdd.getNumPartitions()
    tasks = max(1, min(parts, spark.sparkContext.defaultParallelism, -(-metadata.numExamples() * features // TASK_CELLS)))
    folder = local_folder(spark, scratch_path(spark, "exchange")) if tasks > 1 else None
    if tasks > 1 and (folder is None or spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true"):
        return booster.fit(vectors)
    thresholds = tuple(np.array([s.threshold() for s in splits], float) for splits in _object(impl, "RandomForest").findSplits(
        instances, metadata, booster.getSeed()))
    growth = Growth(thresholds, booster.getMaxIter(), booster.getStepSize(), booster.getMaxDepth(), booster.getSubsamplingRate(),
                    metadata.numFeaturesPerNode(), booster.getMinInstancesPerNode(), booster.getSeed(), booster.getMaxMemoryInMB() << 20,
                    metadata.numExamples() > EXACT_ROWS)
    weight = quoted(booster.getWeightCol()) if booster.isDefined("weightCol") else F.lit(1.0)
    rows = vectors.select(vector_to_array(quoted(booster.getFeaturesCol())).alias("features"),
                          quoted(booster.getLabelCol()).cast("double").alias("label"), weight.cast("double").alias("weight"))
    blocks = rows.mapInArrow(_binned(thresholds), _BLOCKS).repartition(tasks)
    nodes = blocks.mapInArrow(_growing(spark.sparkContext.broadcast(growth), tasks, folder), _NODES, barrier=tasks > 1)
    path = scratch_path(spark, "ensemble")
    _save_settings(spark, java, growth.rounds, features, path)
    _saved_nodes(nodes).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)
