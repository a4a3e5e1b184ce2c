"""Nulls, empty and very long texts, repeated rows, clashing columns and empty tables, for every operator and stage."""

import gzip
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from wardlens.llm import (bpe, common, fingerprints, jaccard, linkage, mixing, rules, sharding, sitequality, stats, tokenbin,
                          toxicity, warc)
from wardlens.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{i % 977} x{i}" for i in range(60_000))
PROSE = " ".join(f"plain{i}" for i in range(80))
CLASHES = ["size", "start", "number", "turn", "node", "part", "key", "label", "score", "hits", "kept", "rule", "ids",
           "decoded", "n_words", "shard", "slot", "fingerprint", "base_failed", "predicted", "words", "block", "of",
           "p", "n", "s", "root", "copies", "text_key"]
ROWS = [(1, PROSE, "en", "a", 1), (1, PROSE, "en", "a", 1), (1, PROSE, "en", "a", 1), (2, "", "en", "a", 0),
        (3, None, "en", None, None), (None, PROSE + " more", "de", None, 5), (None, None, None, None, None),
        (4, LONG, "fr", "b", 9), (5, " \n\t ", None, "b", 4), (6, "idiot <|endoftext|> ÉÀ ḯ 中文", "en", "c", 3),
        (7, PROSE.upper(), "en", "c", 3), (-8, "a\n" * 500, "en", "c", 1000), (2**60, "one", "en", "d", 3)]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module", params=["odd", "empty"])
def docs(spark, request):
    df = spark.createDataFrame(ROWS if request.param == "odd" else [], SCHEMA)
    return df.select("*", *[F.lit(7).alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 1), (3, None, None), (None, 1, 1), (6, 0, 1)], LABELS)


def texts(docs):
    return [r["text"] for r in docs.select("text").collect()]


def test_mix(docs):
    mix = mixing.Mix(docs, block=64)
    rows = mix.taken().collect()
    assert len(rows) == docs.count()
    assert all(r["size"] == 0 and r["taken"] == 0 or 0 <= r["taken"] <= 3 * r["size"] for r in rows)
    taken = sum(len(t.split()) for t in texts(mix.texts()))
    assert taken == sum(r["taken"] for r in rows)


def test_mix_order_of_sources_and_caps():
    assert mixing.targets([10, 1000], [5, 2]) == [30.0, 980.0]
    assert mixing.targets([], []) == []
    assert mixing.targets([0, 0], [5, 2]) == [0.0, 0.0]


def test_permutation_is_one():
    for n in (1, 2, 3, 10, 1000, 1023, 1025):
        assert sorted(mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 99))) == list(range(n))


def test_jaccard(docs):
    rows = jaccard.join(docs).collect()
    copies = Counter(t or "" for t in texts(docs))
    assert sorted(r["n_copies"] for r in rows) == sorted(c for c in copies.values() for _ in range(c))
    kept = jaccard.representatives(docs)
    assert kept.columns == docs.columns
    if rows:
        prose = next(r for r in rows if r["doc_id"] == 1)
        assert (prose["class_id"], prose["n_links"], prose["n_copies"]) == (1, 3, 3)  # two copies and the longer one
        assert sum(t == PROSE for t in texts(kept)) == 1 and kept.count() == 8


def test_jaccard_blocks(spark, monkeypatch):
    """Groups cut into blocks give the same links as whole ones."""
    rows = [(i, " ".join(f"w{j}" for j in range(100) if j != i % 40)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {tuple(r) for r in jaccard.join(docs).collect()}
    monkeypatch.setattr(jaccard, "_CLASS_BLOCK", 7)
    monkeypatch.setattr(jaccard, "_NODE_BLOCK", 5)
    assert {tuple(r) for r in jaccard.join(docs).collect()} == whole
    sets = [set(zip(*[t.split()[k:] for k in range(5)])) for _, t in rows]
    links = {i: sum(5 * len(a & b) >= 4 * len(a | b) for b in sets) - 1 for i, a in enumerate(sets)}
    assert {i: n for i, _, n, _ in whole} == links


@pytest.mark.parametrize("hubs", [0, 3, 64])
def test_large_groups_are_linked_whole(spark, monkeypatch, hubs):
    """Classes do not depend on blocks and hubs: a crowd, a chain that only neighbours link, and strays."""
    crowd = [" ".join(f"w{j}" for j in range(100) if j != i % 40) for i in range(90)]
    chain = [" ".join(f"c{j}" for j in range(10 * i, 10 * i + 200)) for i in range(30)]
    rows = list(enumerate([*crowd, *chain, "a stray text of six words", *crowd[:3], None, ""]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {r["doc_id"]: r["class_id"] for r in jaccard.join(docs).collect()}
    kept = {r["doc_id"] for r in jaccard.representatives(docs).collect()}
    assert kept == set(whole.values()) and len(kept) == 4
    monkeypatch.setattr(jaccard, "_CLASS_BLOCK", 7)
    monkeypatch.setattr(jaccard, "_NODE_BLOCK", 5)
    monkeypatch.setattr(linkage, "HUBS", hubs)
    assert {r["doc_id"]: r["class_id"] for r in jaccard.join(docs).collect()} == whole
    assert {r["doc_id"] for r in jaccard.representatives(docs).collect()} == kept


def test_second_pass_meets_what_hubs_leave_apart(spark):
    """Rows alike by a shared digit: links that no block of its own holds are found, at work that grows with the group."""
    rows = spark.range(3000).select(F.lit(1).alias("g"), F.encode(F.col("id").cast("string"), "utf-8").alias("node"),
                                    F.lit(3000).alias("n"), F.lit(30).alias("blocks"))
    cells = spark.sparkContext.accumulator(0)

    def make():
        def find(parts):
            found = linkage.column(parts, "node")
            cells.add(len(found))
            key = [int(x) // 10 if int(x) < 200 else -1 for x in found]  # a crowd of 2,800 and 20 classes of ten
            first = {}
            return [(x, first[k]) for x, k in zip(found, key) if first.setdefault(k, x) != x]
        return find

    got = linkage.linked(rows, ["g"], lambda c: c, ["node"], make, "test").collect()
    classes = {}
    for r in got:
        classes.setdefault(r["root"], set()).add(int(r["node"]))
    assert sorted(map(sorted, classes.values())) == [*[list(range(10 * i, 10 * i + 10)) for i in range(20)], list(range(200, 3000))]
    assert cells.value < 8 * 3000 + 64 * 60 + 200 * 60


def test_prefix_length():
    x = jaccard.prefix_length()
    assert 1 - (1 - 0.8 ** x) ** jaccard.TREES >= jaccard.RECALL > 1 - (1 - 0.8 ** (x + 1)) ** jaccard.TREES


def test_toxicity(docs, labels):
    scored = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)


def test_toxicity_disguises():
    lexicon = toxicity.Lexicon({"idiot": 8.0, "trash": 8.0})
    automaton = lexicon.automaton()
    for text in ("an IDIOT", "an 1d10t", "аn іdіоt", "an ıdíöt", "an id​iot", "ｉｄｉｏｔ", "you idiots!!"):
        assert toxicity.features(text, automaton)[2] == 1, text
    assert toxicity.features("put it in the trash can", automaton)[2] == 0
    assert toxicity.features("trash can and trash", automaton)[2] == 1
    assert toxicity.features("periidiot", automaton)[2] == 0
    assert toxicity.features(None, automaton) == toxicity.features("", automaton) == (0.0, 0.0, 0)


@pytest.mark.parametrize("text", ["1oser", "c1own", "worth1ess", "assho1e", "imbeci1e", "d!sgusting", "!diot",
                                  "f.u.c.k", "id-iot", "f|u|c|k", "d|sgusting", "you, i.d.1.o.t", "so.id-iot", "ídi-öt", "f‑u‑ck"])
def test_toxicity_disguised_seeds(text):
    """Look-alike letters and single signs inside a word hide no seed, and such a word is one hit."""
    automaton = toxicity.Lexicon({toxicity.fold(s).strip(): 3.0 for s in toxicity.SEEDS}).automaton()
    assert toxicity.features(f"such a {text} here", automaton)[2] == 1


def test_toxicity_length_is_words():
    """What separates words, and how often, does not change a score."""
    automaton = toxicity.Lexicon({"idiot": 8.0}).automaton()
    words = ["idiot"] + [f"word{i}" for i in range(400)]
    found = {toxicity.features(by.join(words), automaton) for by in (" ", "\n", "\t", "  ", " \r\n")}
    assert len(found) == 1 and found.pop()[2] == 1


def test_toxicity_power_errors(spark):
    """Cross-validation never reads held-out rows."""
    rows = [(i, f"plain words number {i} here" + (f" nasty thing{i}" if i % 2 else ""), i % 2) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2] if zlib.crc32(str(r[0]).encode()) % 3 != 1 else 1 - r[2]) for r in rows],
                                   "doc_id long, toxic int")
    errors = toxicity.power_errors(docs, labels, (1.0, 3.0), folds=2)
    assert set(errors) == {1.0, 3.0} and all(e[:2] == (0, 0) and e[2] < 0.1 for e in errors.values())


def test_toxicity_exceptions_are_whole_words():
    automaton = toxicity.Lexicon({"trash": 8.0}).automaton()
    for text in ("this trash can't", "this trash can’t talk", "the trash cannot", "a trash candidate"):
        assert toxicity.features(text, automaton)[2] == 1, text
    for text in ("a trash can", "two trash cans!", "the trash can's lid", "trash-can", "trash can, trash bag"):
        assert toxicity.features(text, automaton)[2] == 0, text


def test_toxicity_signs():
    automaton = toxicity.Lexicon({"idiot": 8.0, "loser": 8.0, toxicity.fold_marked("réeux").strip(): 2.0}).automaton()
    for text, n in (("idiot-loser", 2), ("!idiot! loser!!", 2), ("great!idiot", 1), ("don't id", 0), ("id iot", 0),
                    ("id--iot", 0), ("périd-iot", 0), ("ré-euxpa réeux reeux", 2), ("9 2 6", 0)):
        assert toxicity.features(text, automaton)[2] == n, text
    assert toxicity.fold("9rüp 6rip 2oo lI1") == " grup grip zoo iii"
    assert toxicity.features("a." * 200_000 + "i" * 200_000 + " i.d.i.o.t" * 20_000, automaton)[2] == 20_000


def test_fingerprints(docs):
    rows = fingerprints.with_next(docs, "doc_id", "text").collect()
    assert len(rows) == docs.count()
    assert len({r["fingerprint"] for r in rows}) == len({t or "" for t in texts(docs)})
    keys = [r["doc_id"] for r in rows]
    if rows:
        last = [r for r in rows if r["doc_id"] is None]
        assert len(last) == 2 and keys.count(1) == 3
    appended = fingerprints.fingerprint(docs, "text").withColumn("like", fingerprints.likeness_of("fingerprint", "fingerprint"))
    assert all(r["like"] == 1.0 for r in appended.collect())


@pytest.mark.parametrize("repeats", [40_000, 70_000, 140_000])
def test_fingerprint_of_many_repeats(spark, repeats):
    """Half of a text of one word, repeated beyond 16 bits, is still like the whole."""
    rows = [(1, "w " * repeats), (2, " ".join(f"other{i}" for i in range(50)) + " " * 10 * repeats)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    near = {r["doc_id"]: r["near_edited"] for r in fingerprints.with_next(df, "doc_id", "text").collect()}
    assert near[1] > 0.99
    whole = fingerprints.fingerprint_of("\n".join(["w " * repeats] * 2))
    assert fingerprints.combined(whole, "w " * repeats, -1) == fingerprints.fingerprint_of("w " * repeats)


def test_fingerprint_updates():
    whole = fingerprints.fingerprint_of("one two\nthree four five six\nseven")
    assert whole == fingerprints.fingerprint_of("seven\none two\nthree four five six")
    less = fingerprints.combined(whole, "three four five six", -1)
    assert less == fingerprints.fingerprint_of("one two\nseven") and whole == fingerprints.combined(less, "three four five six")


def test_single_row_follows_itself(spark):
    row = fingerprints.with_next(spark.createDataFrame([(1, "abcd")], "doc_id long, text string"), "doc_id", "text").first()
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and row["near_next"] == 1.0


def test_site_quality(docs, labels):
    rows = sitequality.score(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)


def test_rules(docs, labels):
    judged = rules.judge(docs, labels)
    assert judged.count() == docs.count()
    assert all(r["base_failed"] and not r["kept"] for r in judged.where("text is null or text = ''").collect())


def test_rules_are_learned():
    rng = np.random.default_rng(1)
    x = rng.random((900, 2))
    bad = (x[:, 0] > 0.8) | (x[:, 1] < 0.1)
    found = rules.learn(x, bad, ["a", "b"])
    predicted = np.zeros(900, bool)
    for r in found:
        predicted |= rules.covered(r, x, ["a", "b"])
    assert (predicted == bad).mean() > 0.98 and len(found) >= 2
    assert rules.learn(x, np.zeros(900, bool), ["a", "b"]) == []


def test_statistics_of_long_text():
    assert stats.repeat_words(np.zeros(5, np.int64), 1) == 5
    assert stats.text_stats(None) == stats.text_stats("")
    ids = np.array([0, 1, 2, 3, 0, 1, 2])
    assert stats.repeat_words(ids, 3_000_000) == stats.repeat_words(ids, 4) == 6


def test_bpe(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    for r in bpe.encode(docs, "text", PATH, "ids", "decoded").collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)
    both = bpe.decode(bpe.encode(docs, "text", PATH, "ids"), "ids", PATH, "decoded").collect()
    assert [r["decoded"] for r in both] == [r["decoded"] for r in bpe.encode(docs, "text", PATH, "ids", "decoded").collect()]


def test_token_files(spark, docs):
    folder = scratch_path(spark, "edge-tokens")
    tokenbin.write_tokens(docs, folder, PATH, segment_ids=1000)
    rows = tokenbin.read_documents(spark, folder).collect()
    assert len(rows) == docs.count()
    rows.sort(key=lambda r: (r["start"], r["n_tokens"]))
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:i]) for i in range(len(rows))]
    ids = [r["doc_id"] for r in rows]
    known = [i for i in ids if i is not None]
    assert known == sorted(known) and ids == known + [None] * (len(ids) - len(known))
    end = zlib.crc32(np.array([2], "<u4").tobytes())
    assert sum(r["ids_crc32"] == end for r in rows) == sum(not (t or "").strip() for t in texts(docs))


def test_elias_fano():
    rng = np.random.default_rng(3)
    for n, top in ((0, 0), (1, 0), (1, 10**15), (1000, 5), (1000, 10**6), (700, 2**50)):
        values = np.sort(rng.integers(0, top + 1, n))
        coded = tokenbin.EliasFano.of(values, top)
        back, at = tokenbin.EliasFano.read(memoryview(coded.to_bytes()), 0)
        assert at == len(coded.to_bytes()) and back.values().tolist() == values.tolist()
        assert [back.select(i) for i in range(n)] == values.tolist()
        assert [v for k in range(len(back.samples)) for v in back.select_block(k).tolist()] == values.tolist()
        if n >= 700:
            bits = 8 * (len(coded.low) + len(coded.upper)) / n
            assert bits <= 2 + max(0.0, np.log2(max(top, 1) / n)) + 1.1


def test_segment_select():
    ids = [np.arange(k, dtype="<u2").tobytes() for k in (3, 0, 5)]
    (s,) = tokenbin.segments(tokenbin.segment_bytes(0, 0, [-5, 9, None], ids, 2) + b"\n")
    assert [s.ids_of(i).tolist() for i in range(3)] == [[0, 1, 2], [], [0, 1, 2, 3, 4]] and s.doc_ids() == [-5, 9, None]


PAGES = [(3, "http://b.example.com/x", "p" * 200), (1, "http://b.example.com/x", "p" * 200), (1, "http://b.example.com/x", "p" * 200),
         (4, None, None), (None, "not a url: [", "p" * 200), (5, "https://a.example.com:99/?q=1\r\nX: y", "WARC/1.1\r\n\r\n\r\n" * 20),
         (6, "http://a.example.com", ""), (7, "http://c.example.com/", "short"), (8, "http://c.example.com/", "short"),
         (2**40, "http://c.example.com/é", "ü" * 50_000)]


@pytest.mark.parametrize("rows", [PAGES, []])
def test_warc(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select(
        "*", F.lit(1).alias("size"), F.lit("x").alias("digest"), F.lit(2).alias("first"), F.lit("y").alias("value"))
    folder = scratch_path(spark, "edge-warc")
    warc.write(pages, folder, records_per_file=3)
    index = warc.merged_index(spark, folder, entries_per_slice=3).orderBy("slice", "place").collect()
    order = [(r["url_key"], r["captured_at"], r["page_id"] is None, r["page_id"] or 0) for r in index]
    assert order == sorted(order) and len(index) == len(rows)
    assert Counter((r["page_id"], r["payload_digest"], r["payload_bytes"]) for r in index) == Counter(
        (i, hashlib.sha256((h or "").encode()).hexdigest(), len((h or "").encode())) for i, _, h in rows)
    if rows:
        kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in index)
        assert kinds[(1, "response", None)] == 2 and kinds[(3, "revisit", 1)] == kinds[(None, "revisit", 1)] == 1
        assert kinds[(7, "response", None)] == kinds[(8, "response", None)] == 1


def test_long_pages_share_fewer_files(spark):
    pages = spark.range(12, numPartitions=1).selectExpr("id AS page_id", "'a.org/' || id AS url", "repeat(id, 2000) AS HTML")
    folder = scratch_path(spark, "long-warc")
    warc.write(pages, folder, bytes_per_file=6000, html="HTML")
    files = spark.read.format("binaryFile").load(folder).select("length").collect()
    assert len(files) >= 6 and max(f["length"] for f in files) < 12_000
    index = warc.merged_index(spark, folder).collect()
    assert sorted(r["page_id"] for r in index) == list(range(12))
    assert all(r["payload_bytes"] == 2000 * len(str(r["page_id"])) for r in index)


def test_archive_members(spark):
    """Any gzip reader unpacks a file, and offset and length of an entry give its record alone."""
    pages = spark.createDataFrame([(i, f"https://www.b.org/{i}", "é\r\n\r\nWARC/1.1 " * (i % 3 * 20)) for i in range(30)],
                                  "page_id long, url string, html string")
    folder = scratch_path(spark, "members")
    warc.write(pages, folder, records_per_file=4)
    files = {r["path"].rsplit("/", 1)[-1]: bytes(r["content"]) for r in spark.read.format("binaryFile").load(folder).collect()}
    assert sum(gzip.decompress(data).count(b"WARC-Record-ID") for data in files.values()) == 30
    for e in warc.merged_index(spark, folder, entries_per_slice=7).collect():
        headers, block = warc.record(gzip.decompress(files[e["file"]][e["offset"]:e["offset"] + e["length"]]))
        assert headers["WARC-Record-ID"] == f"<urn:page:{e['page_id']}>"
        assert e["record_type"] == ("revisit" if e["page_id"] > 2 and e["page_id"] % 3 else "response")
        assert block.endswith(b"WARC/1.1 ") == (e["page_id"] in (1, 2))


@pytest.mark.parametrize("n", [0, 1, 40, 9000])
def test_hash_filter_lets_every_key_through(spark, n):
    keys = spark.range(n).select(F.xxhash64("id").alias("h"))
    rows = spark.range(20_000).select("id", F.xxhash64("id").alias("hash")).union(spark.sql("SELECT -1L, CAST(NULL AS LONG)"))
    marked = common.with_possible(rows, "hash", keys, "h").where("possible").collect()
    assert set(range(n)) <= {r["id"] for r in marked} and len(marked) <= n + 0.1 * 20_000


HOT = {"half without key": "IF(id % 2 = 0, NULL, id)", "one key": "IF(id % 10 < 6, 77, id)", "apart": "id",
       "few keys": "id % 3", "none": "CAST(NULL AS LONG)", "one at the end": "IF(id % 10 < 6, 9000000, id)"}


@pytest.mark.parametrize("case", HOT)
def test_hot_keys_fill_many_ranges(spark, case):
    """The largest of 40 ranges of key and hash holds little more than its share, and ranges are in order."""
    df = spark.range(20_000).select(F.expr(HOT[case]).cast("long").alias("key"), F.xxhash64("id").alias("tie"))
    bounds = common.pair_bounds(df, "key", 40)
    rows = df.withColumn("part", common.range_of(F.col("key"), F.col("tie"), bounds)).collect()
    sizes = Counter(r["part"] for r in rows)
    assert max(sizes.values()) <= 3 * 20_000 / 40 and len(sizes) > 25
    order = sorted((r["key"] is None, r["key"] or 0, r["tie"], r["part"]) for r in rows)
    assert [r[3] for r in order] == sorted(r[3] for r in order)


@pytest.mark.parametrize("case", HOT)
def test_hot_keys_keep_results(spark, case):
    """Fingerprints meet the next row and token files are in order, with rows of one key over many tasks."""
    df = spark.range(600).select(F.expr(HOT[case]).cast("long").alias("doc_id"), F.format_string("text %d of it", "id").alias("text"))
    rows = fingerprints.with_next(df, "doc_id", "text").collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in df.collect())
    ordered = [r["text"] for r in df.orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text")).collect()]
    changed = [fingerprints.edited(a, b) for a, b in zip(ordered, ordered[1:] + ordered[:1])]
    assert Counter(r["edited_sha256"] for r in rows) == Counter(hashlib.sha256(t.encode()).hexdigest() for t in changed)
    folder = scratch_path(spark, "hot-tokens")
    tokenbin.write_tokens(df, folder, PATH)
    found = sorted(tokenbin.read_documents(spark, folder).collect(), key=lambda r: r["start"])
    keys = [(r["doc_id"] is None, r["doc_id"] or 0) for r in found]
    assert keys == sorted(keys) and len(keys) == 600
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(found, found[1:]))


def test_hot_rows_are_dealt_by_number(spark):
    """One id and size in 60% of the rows: groups stay small, starts follow each other without gaps."""
    rows = spark.range(20_000).select(F.when(F.col("id") % 10 < 6, 5).otherwise(F.col("id")).alias("doc_id"),
                                      F.lit("s").alias("source"), F.when(F.col("id") % 10 < 6, 3).otherwise(F.col("id") % 7).alias("size"))
    groups = mixing.dealt(rows.repartition(6), ["doc_id"], 1000).groupBy("source", "__group").count().collect()
    assert max(r["count"] for r in groups) < 2000
    placed = sorted((r["start"], r["size"]) for r in mixing.stream(rows.repartition(6), ["doc_id"], 1000).collect() if r["size"])
    assert placed[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(placed, placed[1:]))


def test_loser_tree():
    rng = np.random.default_rng(5)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.integers(0, 50, rng.integers(0, 30)).tolist()) for _ in range(k)]
        merged = list(warc.LoserTree([iter([((x,), x) for x in r]) for r in runs]))
        assert merged == sorted(x for r in runs for x in r)


def test_sharding(docs):
    rows = docs.select("doc_id", "text", F.octet_length("text").alias("weight"), "shard", "slot", "n")
    placed = sharding.number_rows(sharding.assign(rows, "text", "weight", 3), "shard", ["doc_id"]).collect()
    home, slots = {}, {}
    for r in placed:
        assert home.setdefault(r["text"], r["shard"]) == r["shard"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(placed) == docs.count() and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_schedule():
    sizes = {"a": 7, "b": 6, "c": 5, "d": 4, "e": 3}
    placed = sharding.schedule(sizes.items(), 2)
    assert placed == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 0}


def test_pipeline_stages(spark, docs, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stage")
    spark.createDataFrame([(1, 1, 0), (6, 0, 1)], LABELS).write.parquet(f"{folder}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(folder))
        assert out.collect() is not None
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == corpus_pipeline.COLUMNS
