"""The registered text queries against plain Python on a small table."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from wardlens.llm import fingerprints, mixing, queries, rules, sitequality, stats, toxicity
from wardlens.session import scratch_path

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, medium):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}


def rows_of(spark, medium, name):
    return {r[0]: r for r in queries.QUERIES[name](spark, medium).collect()}


def test_mixing(spark, medium, docs):
    rows = rows_of(spark, medium, "op1_mixing")
    assert rows.keys() == docs.keys()
    size, taken = Counter(), Counter()
    for i, r in rows.items():
        assert r["size"] == len(WORDS.findall(docs[i]["text"]))
        assert 0 <= r["taken"] <= 3 * r["size"]
        size[docs[i]["source"]] += r["size"]
        taken[docs[i]["source"]] += r["taken"]
    names = sorted(size)
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, target = Fraction(sum(size.values())), set(names), {}
    while True:
        total = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / total > 3 * size[s]}
        if not over:
            target |= {s: left * weights[s] / total for s in open_}
            break
        for s in over:
            target[s] = Fraction(3 * size[s])
        left -= sum(target[s] for s in over)
        open_ -= over
    for i, r in rows.items():
        source = docs[i]["source"]
        assert r["source_size"] == size[source]
        assert r["target"] == pytest.approx(float(target[source]))
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    again = rows_of(spark, medium, "op1_mixing")
    assert {i: r["taken"] for i, r in rows.items()} == {i: r["taken"] for i, r in again.items()}


def grams(text, n=5):
    words = WORDS.findall(text)
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def linked(texts):
    """Number of similar other documents and least member of its class, of each document, from all pairs that share a gram."""
    sets = {i: grams(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    links, parent = Counter(), {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        shared = Counter(j for g in s for j in holders[g] if j != i)
        for j, n in shared.items():
            if 5 * n >= 4 * (len(s) + len(sets[j]) - n):
                links[i] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: links[i] for i in texts}, {i: find(i) for i in texts}


def test_ngram_jaccard(spark, medium, docs):
    rows = rows_of(spark, medium, "op2_ngram_jaccard")
    links, classes = linked({i: d["text"] for i, d in docs.items()})
    copies = Counter(d["text"] for d in docs.values())
    assert {i: r["n_links"] for i, r in rows.items()} == links
    assert {i: r["class_id"] for i, r in rows.items()} == classes
    assert {i: r["n_copies"] for i, r in rows.items()} == {i: copies[d["text"]] for i, d in docs.items()}


def test_pipeline_stages_by_brute_force(spark, medium, docs):
    """What each stage writes against plain Python on what the stage before it wrote."""
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    kept, written = spark.read.parquet(f"{medium}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage-test")
        stage(spark, kept, medium).write.parquet(path)
        written.append((kept, spark.read.parquet(path)))
        kept = written[-1][1]

    def rows(df):
        return sorted(map(tuple, df.collect()), key=repr)

    (before, after), *rest = written  # quality rules: base rules, then the decision list by hand
    sample = rules.with_stats(rules.labelled_rows(before, labels, "quality", rules.SAMPLE).select("doc_id", "text"), "text")
    learned, names = rules.fit(sample, labels), list(rules.shares())
    expected = []
    for d in before.collect():
        stat = dict(zip(stats.COUNTS, stats.text_stats(d["text"])))
        x = np.array([[math.log1p(stat["n_words"])] + [stat[a] / stat[b] if stat[b] else 0.0 for a, b in (
            ("word_chars", "n_words"), ("n_symbols", "word_chars"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"),
            ("n_distinct_words", "n_words"), ("n_capitals", "word_chars"), ("n_marks", "word_chars"))]])
        words = WORDS.findall(d["text"])
        if len(words) >= 50 and 2 * repeated(words) <= len(words) and not any(rules.covered(r, x, names)[0] for r in learned):
            expected.append(tuple(d))
    assert learned and rows(after) == sorted(expected, key=repr)

    (before, after), *rest = rest  # toxicity
    lexicon = toxicity.learn(before, labels)
    expected = [tuple(d) for d in before.collect() if plain_score(d["text"], lexicon) < 0.7]
    assert rows(after) == sorted(expected, key=repr) and len(expected) < before.count()

    (before, after), *rest = rest  # near copies: the least of each class by all pairs
    by_id = {d["doc_id"]: d for d in before.collect()}
    _, classes = linked({i: d["text"] for i, d in by_id.items()})
    assert rows(after) == sorted((tuple(by_id[i]) for i in set(classes.values())), key=repr) and len(set(classes.values())) < len(by_id)

    (before, after), (coded_from, coded) = rest  # mixing: whole words of the document, each source near its target
    by_id = {d["doc_id"]: (WORDS.findall(d["text"]), d) for d in before.collect()}
    size, taken, own = Counter(), Counter(), Counter()
    for words, d in by_id.values():
        size[d["source"]] += len(words)
    for r in after.collect():
        words, d = by_id[r["doc_id"]]
        mine = Counter(WORDS.findall(r["text"]))
        assert not mine - Counter(words) and (r["lang"], r["source"], r["n_chars"]) == (d["lang"], d["source"], len(r["text"]))
        taken[r["source"]] += mine.total()
        own[r["doc_id"]] += mine.total()
    assert all(n <= 3 * len(by_id[i][0]) for i, n in own.items())
    names = sorted(size)
    for name, target in zip(names, mixing.targets([size[n] for n in names], [(5, 2, 1)[k % 3] for k in range(len(names))])):
        assert abs(taken[name] - target) <= 1

    from tokenizers import Tokenizer  # bpe: the tokenizers library itself

    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.WORD_BPE))
    texts = [(r["doc_id"], r["text"]) for r in coded_from.collect()]
    found = tokenizer.encode_batch([t for _, t in texts], add_special_tokens=False)
    expected = Counter((i, len(e.ids), tuple(e.ids), tokenizer.decode(e.ids, skip_special_tokens=False)) for (i, _), e in zip(texts, found))
    assert Counter((r["doc_id"], r["n_tokens"], tuple(r["ids"]), r["decoded"]) for r in coded.collect()) == expected
    assert Counter((r["doc_id"], r["n_tokens"], tuple(r["ids"]), r["decoded"])
                   for r in corpus_pipeline.run(spark, medium).collect()) == expected


def plain_features(text, lexicon):
    """Weight and words of a text, by comparing every term at every place."""
    signed = toxicity.fold_signed(text or "")
    cuts, strokes, mark = set(toxicity._CUTS), set("!|"), re.compile("[\u0300-\u036f]")
    terms = [(toxicity.fold_marked(t)[1:], w) for t, w in lexicon.weights.items()]
    phrases = [toxicity.fold(p)[1:] + e for p in lexicon.exceptions for e in (" ", "s ", "es ")]
    hits, safe = {}, []
    for i in range(1, len(signed)):
        before, here = signed[i - 1], signed[i]
        if before not in cuts and before != " " or mark.match(here):
            continue
        spaced = "".join(" " if c in cuts else c for c in signed[i:i + 400]) + " "
        found = []
        for reading in {spaced, mark.sub("", spaced)}:
            found += [(len(mark.sub("", t)), w) for t, w in terms if reading.startswith(t)]
        for as_i in (False, True):
            read, at, crossed = "", i, False
            while at < len(signed) and signed[at] != " ":
                c = signed[at]
                if c in cuts:
                    if at + 1 >= len(signed) or signed[at + 1] in cuts or signed[at + 1] == " " or (at == i and not (as_i and c in strokes)):
                        break
                    crossed = crossed or len(mark.sub("", read))
                    crossed = 0 if at == i else crossed
                    read += "i" if as_i and c in strokes else ""
                    first = True
                else:
                    read, first = read + c, False
                at += 1
            if crossed is not False:
                for reading in {read, mark.sub("", read)}:
                    found += [(len(mark.sub("", t)), w) for t, w in terms
                              if reading.startswith(t) and len(mark.sub("", t)) > crossed]
        if found and (best := max(found, key=lambda f: (f[1], f[0]))):
            hits[i] = best
        plain = mark.sub("", spaced)
        for p in phrases:
            if plain.startswith(p):
                rest = mark.sub("", signed[i:])[len(p) - 1:]
                if not (rest[:1] in cuts and rest[1:2] == "t" and (len(rest) < 3 or rest[2] in cuts or rest[2].isspace())):
                    safe.append((i, len(p) - 1))
    total = 0.0
    for i, (length, weight) in hits.items():
        if not any(a <= i and len(mark.sub("", signed[a:i])) + length <= n for a, n in safe):
            total += weight
    return total, len(WORDS.findall(text or ""))


def plain_score(text, lexicon):
    weight, words = plain_features(text, lexicon)
    a, b, c = lexicon.coefficients
    return 1 / (1 + math.exp(-(a * math.log1p(weight) + b * math.log1p(100 * weight / max(10, words)) + c)))


def test_toxicity_scores_by_brute_force(spark, medium, docs):
    learned = toxicity.learn(spark.read.parquet(f"{medium}/documents.parquet"), spark.read.parquet(f"{medium}/labels.parquet"))
    wider = toxicity.Lexicon({**learned.weights, "the": 1.0, "ion": 0.5, "ré": 0.7, "re": 0.4, "ti": 0.3}, toxicity.EXCEPTIONS)
    extra = ["the trash can, a trash-can and trash", "id-iot f.u.c.k !diot i.d.i.o.t id--iot réeux ré-eux reeux", "", "a ", "trash can't"]
    texts = [docs[i]["text"] for i in sorted(docs)]
    texts = [t for t in texts if len(t) < 6000] + extra
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    for lexicon in (learned, wider):
        got = {r["id"]: r["score"] for r in toxicity.score(table, lexicon).collect()}
        for i, t in enumerate(texts):
            assert got[i] == pytest.approx(plain_score(t, lexicon), abs=1e-9), t[:200]


def test_toxicity_in_every_language(spark):
    """Held-out recall of each language, where starts of toxic words turn up in clean documents too."""
    folder = "/root/testdata/sf0.1"
    rows = rows_of(spark, folder, "op3_toxicity")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = defaultdict(list)
    for r in docs.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect():
        if rows[r["doc_id"]]["held_out"]:
            found[r["lang"], r["toxic"]].append(rows[r["doc_id"]]["predicted"])
    for lang in ("de", "en", "es", "fr"):
        toxic, clean = found[lang, 1], found[lang, 0]
        print(f"{lang}: {sum(toxic)} of {len(toxic)} toxic documents found, {sum(clean)} of {len(clean)} clean called toxic")
        assert sum(toxic) >= 0.85 * len(toxic), lang
        assert sum(clean) <= 0.02 * len(clean), lang


def test_warc(spark, medium):
    rows = rows_of(spark, medium, "op4_warc")
    pages = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{medium}/pages.parquet").collect()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    assert rows.keys() == pages.keys()
    for i, html in pages.items():
        revisit = len(html) >= 100 and first[html] != i
        assert tuple(rows[i])[1:] == (len(html), hashlib.sha256(html).hexdigest(),
                                      "revisit" if revisit else "response", first[html] if revisit else None)


def test_fingerprints(spark, medium, docs):
    rows = rows_of(spark, medium, "op5_fingerprints")
    ids = sorted(docs)
    for i, j in zip(ids, ids[1:] + ids[:1]):
        a, b, r = docs[i]["text"], docs[j]["text"], rows[i]
        half = len(a) // 2
        changed = a[:len(a) - half] + b[:half]
        assert r["n_chars"] == len(a)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == fingerprints.fingerprint_of(a)
        assert r["edited_fingerprint"] == fingerprints.fingerprint_of(changed)
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
    assert np.mean([rows[i]["near_edited"] > rows[i]["near_next"] for i in ids if len(docs[i]["text"]) > 300]) > 0.95
    by_text = defaultdict(set)
    for i in ids:
        by_text[docs[i]["text"]].add(rows[i]["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values())
    assert len({f for fs in by_text.values() for f in fs}) == len(by_text)


def test_site_quality(spark, medium, docs):
    rows = rows_of(spark, medium, "op6_site_quality")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{medium}/labels.parquet").collect()}
    assert rows.keys() == docs.keys()
    tested = [i for i in labels if rows[i]["held_out"]]
    good, bad = ([rows[i]["kept"] for i in tested if labels[i] == y] for y in (1, 0))
    assert np.mean(good) >= 0.95 and np.mean(bad) <= 0.1


def plain_strength(groups, least=1.0, most=1e6):
    """Prior strength of (n, sum, mean) groups by the method of moments."""
    between = sum(n * (s / n - m) ** 2 for n, s, m in groups)
    within, unit = sum(m * (1 - m) for *_, m in groups), sum(n * m * (1 - m) for n, _, m in groups)
    if len(groups) < 2 or not unit:
        return most
    spread = (between - within) / unit
    return min(max((1 - spread) / spread, least), most) if spread > 0 else most


def plain_posteriors(rows):
    """Host rate, path rate and score from (key, host, path, p, given) rows."""
    mean = min(max(sum(r[4] for r in rows) / len(rows), 1e-4), 1 - 1e-4)
    hosts, paths = defaultdict(list), defaultdict(list)
    for r in rows:
        hosts[r[1]].append(r[4])
        paths[r[1], r[2]].append(r[4])
    m = plain_strength([(len(v), sum(v), mean) for v in hosts.values()])
    rate = {h: (sum(v) + m * mean) / (len(v) + m) for h, v in hosts.items()}
    k = plain_strength([(len(v), sum(v), rate[h]) for (h, _), v in paths.items()])
    logit = lambda x: math.log(min(max(x, 1e-6), 1 - 1e-6) / (1 - min(max(x, 1e-6), 1 - 1e-6)))
    for key, h, path, p, given in rows:
        own = paths[h, path]
        path_rate = (sum(own) - given + k * rate[h]) / (len(own) - 1 + k)
        yield key, rate[h], path_rate, 1 / (1 + math.exp(-(logit(p) + logit(path_rate) - logit(mean))))


def test_site_posteriors_by_brute_force(spark, medium, docs):
    rows = rows_of(spark, medium, "op6_site_quality")
    taught = {r["doc_id"]: float(r["quality"]) for r in spark.read.parquet(f"{medium}/labels.parquet").collect()
              if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1}
    given = [(i, d["source"], d["lang"], rows[i]["document_score"], taught.get(i, rows[i]["document_score"])) for i, d in docs.items()]
    for key, host_rate, path_rate, combined in plain_posteriors(given):
        assert (rows[key]["host_rate"], rows[key]["path_rate"], rows[key]["score"]) == pytest.approx(
            (host_rate, path_rate, combined), rel=1e-9, abs=1e-9)


def test_sparse_sites_shrink_and_large_ones_do_not(spark):
    """Host and path of a URL: 300 bad pages speak for themselves, two do not; a bad path inside a good host counts."""
    sites = [("www.Good.org/a", 1, 400), ("bad.org/a", 0, 300), ("few.org/a", 0, 2), ("good.org/b", 0, 150), ("fine.org/a", 1, 400)]
    rows = [(f"https://{site}/{i}.html", quality) for site, quality, n in sites for i in range(n)]
    docs = sitequality.with_site(spark.createDataFrame(
        [(i, u, "some plain words of an article " * 5) for i, (u, _) in enumerate(rows)], "doc_id long, url string, text string"), "url")
    labels = spark.createDataFrame([(i, q) for i, (_, q) in enumerate(rows)], "doc_id long, quality int")
    scored = sitequality.score(docs, labels, host="host", path="path").join(docs, "doc_id").collect()
    host = {r["host"]: r["host_rate"] for r in scored}
    assert set(host) == {"good.org", "bad.org", "few.org", "fine.org"} and {r["path"] for r in scored} == {"a", "b"}
    assert host["bad.org"] < 0.3 and host["few.org"] > host["bad.org"] + 0.1 and host["fine.org"] > 0.8
    path = defaultdict(list)
    for r in scored:
        path[r["host"], r["path"]].append(r["path_rate"])
    assert max(path["good.org", "b"]) + 0.3 < min(path["good.org", "a"])


@pytest.fixture(scope="module")
def encoded(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.WORD_BPE))
    ids = sorted(docs)
    found = tokenizer.encode_batch([docs[i]["text"] for i in ids], add_special_tokens=False)
    return {i: (e.ids, tokenizer.decode(e.ids, skip_special_tokens=False)) for i, e in zip(ids, found)}


def test_token_files(spark, medium, docs, encoded):
    rows, start = rows_of(spark, medium, "op7_token_files"), 0
    for i in sorted(docs):
        ids = [*encoded[i][0], 2]
        assert tuple(rows[i]) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def repeated(words):
    windows = Counter(zip(words, words[1:], words[2:]))
    marked = [False] * len(words)
    for k in range(len(words) - 2):
        if windows[tuple(words[k:k + 3])] > 1:
            marked[k:k + 3] = [True] * 3
    return sum(marked)


def test_decision_list(spark, medium, docs):
    rows = rows_of(spark, medium, "op8_decision_list")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{medium}/labels.parquet").collect()}
    for i, d in docs.items():
        words, seen, dup = WORDS.findall(d["text"]), set(), 0
        for line in d["text"].split("\n"):
            if WORDS.search(line):
                dup += line in seen
                seen.add(line)
        again = repeated(words)
        failed = len(words) < 50 or 100 * again > 50 * len(words)
        r = rows[i]
        assert tuple(r)[1:7] == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", d["text"])), dup,
                                 again, failed)
        assert r["kept"] == (not failed and r["rule"] == 0)
    passed = [i for i in labels if not rows[i]["base_failed"] and zlib.crc32(str(i).encode()) % 3 == 1]
    good, bad = ([rows[i]["kept"] for i in passed if labels[i] == y] for y in (1, 0))
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.1


def test_bpe(spark, medium, docs, encoded):
    rows = rows_of(spark, medium, "op9_bpe")
    for i in docs:
        ids, text = encoded[i]
        assert tuple(rows[i]) == (i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                                  hashlib.sha256(text.encode()).hexdigest())


def test_sharding(spark, medium, docs):
    rows = rows_of(spark, medium, "op10_sharding")
    loads, slots, home = Counter(), defaultdict(list), {}
    for i, d in docs.items():
        data, r = d["text"].encode(), rows[i]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "bytes", None)
        assert home.setdefault(d["text"], r["shard"]) == r["shard"]
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sorted(loads) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads.values()) - min(loads.values()) <= 0.02 * sum(loads.values()) / 24
