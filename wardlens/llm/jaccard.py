"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

Every distinct text has a signature of trees times depth MinHash values. In a
tree, texts sorted by their label form a prefix trie. Matches start at the full
label and are shortened, level by level, to the prefix length at which a pair
at the threshold is found in some tree with the wanted recall. Texts of a trie
node whose signatures look alike are linked; the components of those links are
the candidate classes. Inside a class all pairs are verified on their exact
shingle sets: links are counted, and the classes are the components of true
links.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions.scalar import quoted
from wardlens.llm.common import map_text
from wardlens.llm.components import components
from wardlens.llm.fingerprints import WordHashes
from wardlens.llm.linkage import column, linked, runs
from wardlens.session import durable

GRAM, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 16, 8, 0.999
_LOOKS_ALIKE = 0.6  # of signature values: more than five standard errors below the threshold
_NODE_BLOCK, _CLASS_BLOCK, _SHINGLE_BLOCK = 8192, 2048, 1_000_000

_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32) | np.uint32(1)
_OFFSETS = _RANDOM.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)
_POWERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                    0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9FB21C651E98DF25], np.uint64)


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold matches in some tree with the wanted recall."""
    for length in range(depth, 0, -1):
        if 1 - (1 - threshold ** length) ** trees >= recall:
            return length
    raise ValueError("the forest is too small for this recall")


def shingles(text: bytes, hashes: WordHashes, gram: int = GRAM) -> np.ndarray:
    """Sorted distinct hashes of word n-grams; a shorter text is one gram, an empty one has none."""
    words = text.split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h, size = hashes.of(words), min(gram, n)
    with np.errstate(over="ignore"):
        total = np.full(n - size + 1, size, np.uint64)
        for k in range(size):
            total += h[k:n - size + 1 + k] * _POWERS[k]
            total ^= total >> np.uint64(29)
        total *= np.uint64(0xD6E8FEB86659FD93)
        total ^= total >> np.uint64(32)
    return np.unique(total)


def signature(grams: np.ndarray) -> np.ndarray:
    """Sixteen bits of each MinHash value."""
    least = np.full(len(_FACTORS), 0xFFFFFFFF, np.uint32)
    low = (grams >> np.uint64(16)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(low), 4096):
            least = np.minimum(least, (low[i:i + 4096, None] * _FACTORS + _OFFSETS).min(0))
        return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(">u2")


def _text_key(text):
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def signed(docs: DataFrame, key: str, text: str, gram: int) -> DataFrame:
    """One row per distinct text: ``node, copies, least, grams, sign``."""
    def make():
        hashes = WordHashes()

        def work(texts):
            sets = [shingles((t or "").encode("utf-8", "surrogatepass"), hashes, gram) for t in texts]
            return [pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())]
        return work

    rows = docs.select(quoted(key).alias("id"), _text_key(quoted(text)).alias("node"), quoted(text).alias("text"))
    marked = map_text(rows, "text", make, [T.StructField("grams", T.LongType()), T.StructField("sign", T.BinaryType())],
                      limit=1 << 20)
    return (marked.drop("text").groupBy("node")
            .agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"),
                 F.first("grams").alias("grams"), F.first("sign").alias("sign")))


def _cells(rows: DataFrame, by: str) -> DataFrame:
    """Cut a large group into its ``blocks``, and send each row to every pair of blocks it is part of.

    A group of one block is one cell. Any two rows of a group meet in a cell,
    and no cell holds more than two blocks.
    """
    own = F.pmod(F.xxhash64(by), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    return (rows.withColumn("own", own).withColumn("other", other)
            .withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other"))
            .drop("blocks", "other"))


def trie_links(signs: np.ndarray, labels: np.ndarray, shortest: int, alike: int) -> list[tuple[int, int]]:
    """Links among the texts of one trie node, rows sorted by label.

    From the full label down to the shortest prefix, a text that is not yet
    linked is compared with the first of its prefix; linked ones are done, so
    a crowd of copies costs one comparison each. If some stay, they are
    compared with all others of the node, through found ones first.
    """
    n = len(signs)
    links, todo = [], np.arange(1, n)
    for depth in range(labels.shape[1], shortest - 1, -1):
        if not len(todo):
            return links
        change = np.r_[True, (labels[1:, :depth] != labels[:-1, :depth]).any(1)]
        head = np.flatnonzero(change)[np.cumsum(change) - 1][todo]
        near = (head != todo) & ((signs[todo] == signs[head]).sum(1) >= alike)
        links += zip(todo[near].tolist(), head[near].tolist())
        todo = todo[~near]
    if not len(todo):
        return links
    links, rest = [], np.arange(n)
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            at = front.pop()
            near = (signs[rest] == signs[at]).sum(1) >= alike
            links += [(i, at) for i in rest[near].tolist()]
            front += rest[near].tolist()
            rest = rest[~near]
    return links


def candidates(nodes: DataFrame, shortest: int) -> DataFrame:
    """``node, root`` of the texts that chains of look-alikes in shared trie nodes join to others."""
    placed = (nodes.where("sign is not null").withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))))
              .select("node", "tree", F.expr(f"substring(sign, tree * {2 * DEPTH} + 1, {2 * shortest})").alias("prefix")))
    shared = durable(placed.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                     .withColumn("blocks", F.ceil(F.col("n") / _NODE_BLOCK)), "jaccard-shared")
    signs = nodes.select("node", "sign")
    alike = int(np.ceil(_LOOKS_ALIKE * TREES * DEPTH))

    def find(parts):
        found = column(parts, "node")
        signs = np.frombuffer(b"".join(column(parts, "sign")), np.uint16).reshape(len(found), -1)
        labels = np.frombuffer(b"".join(column(parts, "label")), np.uint16).reshape(len(found), -1)
        return [(found[i], found[j]) for i, j in trie_links(signs, labels, shortest, alike)]

    def attach(cells):
        return cells.join(signs, "node").withColumn("label", F.expr(f"substring(sign, tree * {2 * DEPTH} + 1, {2 * DEPTH})"))

    return linked(placed.join(shared, ["tree", "prefix"]), ["tree", "prefix"], attach, ["label", "node"], lambda: find,
                  "rough", large=not shared.where("blocks > 1").isEmpty())


def shared_counts(sets: Sequence[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sorted sets.

    Shingles in few of the sets add to their pairs one by one; those in many
    are columns of a matrix multiplied with itself.
    """
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]], np.int64)
    flat, of = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, of = flat[order], of[order]
    start = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.empty(0, np.int64)
    count = np.diff(np.r_[start, len(flat)])
    shared = np.zeros(n * n, np.int64)
    for c in np.unique(count[(count > 1) & (count <= 16)]).tolist():
        rows = of[start[count == c][:, None] + np.arange(c)]
        i, j = np.triu_indices(c, 1)
        for at in range(0, len(rows), max(1, 2_000_000 // len(i))):
            block = rows[at:at + max(1, 2_000_000 // len(i))]
            np.add.at(shared, (block[:, i] * n + block[:, j]).ravel(), 1)
    shared = shared.reshape(n, n)
    shared = shared + shared.T
    many = np.flatnonzero(count > 16)
    for at in range(0, len(many), 2048):
        columns = many[at:at + 2048]
        matrix = np.zeros((n, len(columns)), np.float32)
        width = count[columns]
        place = np.repeat(start[columns], width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        matrix[of[place], np.repeat(np.arange(len(columns)), width)] = 1
        shared += (matrix @ matrix.T).astype(np.int64)
    shared[np.arange(n), np.arange(n)] = [len(s) for s in sets]
    return shared


def similar(sets: Sequence[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs have at least the threshold's Jaccard similarity, by whole-number arithmetic; none with itself."""
    t, size = Fraction(str(threshold)), np.array([len(s) for s in sets], np.int64)
    near = (t.numerator + t.denominator) * shared_counts(sets) >= t.numerator * (size[:, None] + size)
    np.fill_diagonal(near, False)
    return near


def _texts(docs: DataFrame, text: str) -> DataFrame:
    """Every distinct text once, copies folded by task before the shuffle."""
    return (docs.select(_text_key(quoted(text)).alias("node"), quoted(text).alias("text"))
            .groupBy("node").agg(F.first("text").alias("text")))


def _sizes(members: DataFrame) -> DataFrame:
    """``of, n, blocks`` of each class of several texts: how many, and how many blocks to cut it into."""
    blocks = F.greatest(F.ceil(F.col("n") / _CLASS_BLOCK), F.ceil(F.col("total") / _SHINGLE_BLOCK))
    return (members.groupBy(F.col("root").alias("of")).agg(F.count(F.lit(1)).alias("n"), F.sum("grams").alias("total"))
            .where("n > 1").select("of", "n", blocks.alias("blocks")))


def verified(docs: DataFrame, text: str, members: DataFrame, threshold: float, gram: int) -> DataFrame:
    """``node, links, peer`` for members of candidate classes: exact links by cell, and the least node they reach there.

    ``members`` has ``node, root, copies, grams``. Each text travels once; a
    class of many or long texts is cut into blocks.
    """
    wanted = members.join(_sizes(members), F.col("root") == F.col("of")).drop("of")
    cells = (_cells(_texts(docs, text).join(wanted, "node"), "node").select("root", "x", "y", "own", "node", "copies", "text")
             .repartition("root", "x", "y").sortWithinPartitions("root", "x", "y", "node"))

    def run(batches):
        hashes = WordHashes()
        out: list[tuple[bytes, int, bytes]] = []
        for parts in runs(batches, 3):
            found, copies, own = column(parts, 4), np.array(column(parts, 5), np.int64), np.array(column(parts, 3))
            near = similar([shingles(t.encode("utf-8", "surrogatepass"), hashes, gram) for t in column(parts, 6)], threshold)
            if own.min() != own.max():  # two blocks: each meets itself elsewhere
                near &= own[:, None] != own
            elif parts[0].column(1)[0].as_py() != parts[0].column(2)[0].as_py():
                near[:] = False
            peer = _reached(near)
            out += zip(found, (near @ copies).tolist(), [found[i] for i in peer])
            if len(out) >= 20_000:
                yield _link_rows(out)
                out = []
        yield _link_rows(out)

    return cells.mapInArrow(run, "node binary, links long, peer binary")


def connected(docs: DataFrame, text: str, members: DataFrame, threshold: float, gram: int) -> DataFrame:
    """``node, root`` of the members that chains of true links join to others, without counts of links."""
    sizes = durable(_sizes(members), "jaccard-sizes")
    rows = members.join(sizes, F.col("root") == F.col("of")).select(F.col("of").alias("class"), "node", "n", "blocks")

    def make():
        hashes = WordHashes()

        def find(parts):
            found = column(parts, "node")
            near = similar([shingles(t.encode("utf-8", "surrogatepass"), hashes, gram) for t in column(parts, "text")], threshold)
            return [(a, found[i]) for a, i in zip(found, _reached(near)) if a != found[i]]

        return find

    return linked(rows, ["class"], lambda cells: _texts(docs, text).join(cells, "node"), ["node"], make, "exact",
                  large=not sizes.where("blocks > 1").isEmpty())


def _reached(near: np.ndarray) -> list[int]:
    """Per row the first row of its component."""
    peer = [-1] * len(near)
    for start in range(len(near)):
        front = [start] if peer[start] < 0 else []
        while front:
            at = front.pop()
            if peer[at] < 0:
                peer[at] = start
                front += [j for j in np.flatnonzero(near[at]).tolist() if peer[j] < 0]
    return peer


def _link_rows(rows: list[tuple[bytes, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.binary())], ["node", "links", "peer"])


def classes(docs: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
            gram: int = GRAM, recall: float = RECALL, counted: bool = True) -> DataFrame:
    """One row per distinct text: ``node, copies, least, root, class_id, links``.

    ``node`` is the text's digest, ``least`` its least key, ``root`` the least
    node of its class, ``class_id`` the least key of the class, ``links`` the
    number of rows with another text that is similar, null unless ``counted``.
    """
    nodes = durable(signed(docs, key, text, gram), "jaccard-nodes")
    rough = candidates(nodes, prefix_length(threshold, recall=recall))
    members = durable(rough.join(nodes.select("node", "copies", "grams"), "node"), "jaccard-members")
    if counted:
        links = durable(verified(docs, text, members, threshold, gram), "jaccard-links")
        roots = components(links.where(F.col("links") > 0).select(F.col("node").alias("a"), F.col("peer").alias("b")), "exact")
        counts = links.groupBy("node").agg(F.sum("links").alias("links"))
        known = nodes.join(counts, "node", "left").withColumn("links", F.coalesce("links", F.lit(0)))
    else:
        roots, known = connected(docs, text, members, threshold, gram), nodes.withColumn("links", F.lit(None).cast("long"))
    all_nodes = (known.drop("sign", "grams").join(roots, "node", "left")
                 .withColumn("root", F.coalesce("root", "node")))
    ids = all_nodes.groupBy("root").agg(F.min("least").alias("class_id"))
    return all_nodes.join(ids, "root")


def join(docs: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
         gram: int = GRAM, recall: float = RECALL) -> DataFrame:
    """One row per document: the key, ``class_id, n_links, n_copies``.

    A link joins two documents whose sets of word n-grams have at least the
    threshold's Jaccard similarity; ``n_links`` counts a document's links,
    those to its exact copies included, ``n_copies`` the documents with its
    very text, itself included. ``class_id`` is the least key that chains of
    links reach, null if none of them has a key. Texts of fewer words than a
    gram are one gram. Null counts as empty text; empty texts are copies of
    each other. Repeated rows are documents of their own. An empty table gives
    an empty one.
    """
    found = durable(classes(docs, key=key, text=text, threshold=threshold, gram=gram, recall=recall), "jaccard-classes")
    rows = docs.select(quoted(key).alias("__key"), _text_key(quoted(text)).alias("node"))
    return (rows.join(found, "node")
            .select(F.col("__key").alias(key), "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"),
                    F.col("copies").alias("n_copies")))


def representatives(docs: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                    gram: int = GRAM, recall: float = RECALL) -> DataFrame:
    """One document of each class: that with the least key, all its columns unchanged.

    Null keys come last; among rows of the least key and text one stays.
    """
    found = classes(docs, key=key, text=text, threshold=threshold, gram=gram, recall=recall, counted=False)
    place = F.struct(F.col("least").isNull(), F.col("least"), F.col("node"))
    kept = found.groupBy("root").agg(F.min_by("node", place).alias("__node"), F.min_by("least", place).alias("__least"))
    kept = durable(kept.select("__node", "__least"), "jaccard-kept")
    rows = docs.withColumn("__of", _text_key(quoted(text)))
    return (rows.join(kept, (F.col("__of") == F.col("__node")) & quoted(key).eqNullSafe(F.col("__least")))
            .dropDuplicates(["__of"]).drop("__of", "__node", "__least"))
