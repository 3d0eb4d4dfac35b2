"""Operators against brute force on a small fixture of awkward rows, and on empty tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shoplens.llm.bpe_trie import decode_documents, encode_digests, encode_documents
from shoplens.llm.exact_dedup import drop_duplicates, exact_duplicates
from shoplens.llm.license_rules import CLAUSES, CONFIDENCE, FAMILIES, build_rules, compile_phrase
from shoplens.llm.license_scan import license_digest, scan_licenses
from shoplens.llm.line_quality import line_quality, remove_frequent_lines
from shoplens.llm.mixing import mix, mixed_sizes
from shoplens.llm.near_dedup import drop_near_duplicates, near_duplicates
from shoplens.llm.quality_classifier import keep_good, score_quality, tree_rules
from shoplens.llm.token_counts import count_tokens
from shoplens.llm.token_output import ShardReader, token_positions, write_token_files
from shoplens.llm.toxicity import score_toxicity
from tests.llm.conftest import TEXTS

SPACES = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def library(tokenizer_path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path)


def key(r):
    return (r.doc_id is None, r.doc_id or 0)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_token_counts(docs, tokenizer_path, library):
    got = count_tokens(docs, tokenizer_path, entries=8).collect()
    want = Counter((i, len((t or "").encode()), len(ids_of(library, t))) for i, t, _ in TEXTS)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)


def test_bpe_digests(docs, tokenizer_path, library):
    got = encode_digests(docs, tokenizer_path).collect()
    want = Counter()
    for i, t, _ in TEXTS:
        ids = ids_of(library, t)
        text = library.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want


def test_bpe_round_trip(docs, tokenizer_path, library):
    once = encode_documents(docs, tokenizer_path, decoded_col="decoded")
    twice = decode_documents(once, tokenizer_path, out_col="again")
    assert once.columns == [*docs.columns, "token_ids", "decoded"]
    for r in twice.collect():
        assert r.token_ids == ids_of(library, r.text)
        assert r.decoded == r.again == library.decode(r.token_ids, skip_special_tokens=False)


def test_small_caches_change_nothing(docs, tokenizer_path, library, monkeypatch):
    from shoplens.llm import bpe_trie as B

    text = open(tokenizer_path, encoding="utf-8").read()
    monkeypatch.setattr(B, "MAX_NODES", 5)
    monkeypatch.setattr(B, "MAX_PAIRS", 3)
    words = sorted({w.lower() for _, t, _ in TEXTS for w in re.findall("[A-Za-z]+", t or "")})
    got = B.TrieEncoder(text).encode_words(words)
    assert all(list(got[w]) == ids_of(library, w) for w in words)


def test_token_files(docs, tokenizer_path, library):
    got = sorted(token_positions(docs, tokenizer_path, shards=3, sequence_length=64).collect(), key=lambda r: r.start)
    want = sorted((i is not None, i or 0, np.array([*ids_of(library, t), 1], "<u4").tobytes()) for i, t, _ in TEXTS)
    assert [r.doc_id for r in got] == [w[1] if w[0] else None for w in want]
    start = 0
    for r, (_, _, raw) in zip(got, want):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(raw) // 4, zlib.crc32(raw))
        start += len(raw) // 4


def test_sequences_are_views(docs, tokenizer_path):
    manifest = write_token_files(docs, tokenizer_path, shards=1, sequence_length=64).collect()
    reader = ShardReader(manifest[0].uri)
    n = -(-manifest[0].n_ids // 64)
    tokens, mask = reader.sequence(0)
    assert len(tokens) == len(mask) == 64 and not tokens.flags.owndata and mask.true_count == 64
    _, mask = reader.sequence(n - 1)
    assert mask.true_count == manifest[0].n_ids - 64 * (n - 1)


def test_exact_duplicates(docs):
    best, size = {}, Counter()
    for i, t, _ in TEXTS:
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
        size[t or ""] += 1
    want = Counter()
    for i, t, _ in TEXTS:
        keep = None if best[t or ""] < 0 else best[t or ""]
        want[i, keep, size[t or ""], i == keep, hashlib.sha256((t or "").encode()).hexdigest()] += 1
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_duplicates(docs).collect())
    assert got == want


def test_drop_duplicates_keeps_one_of_each(docs):
    got = drop_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted(r.text or "" for r in got.collect()) == sorted({t or "" for _, t, _ in TEXTS})


def brute_components(size, threshold=80):
    sets = []
    for _, t, _ in TEXTS:
        w = SPACES.findall((t or "").translate(LOW))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    root = list(range(len(sets)))
    for _ in sets:
        for a in range(len(sets)):
            for b in range(len(sets)):
                if sets[a] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    out = Counter()
    for a, (i, _, _) in enumerate(TEXTS):
        ids = [TEXTS[b][0] for b in range(len(sets)) if root[b] == root[a] and TEXTS[b][0] is not None]
        comp = min(ids) if ids else None
        out[i, len(sets[a]), comp, i == comp] += 1
    return out


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(docs, size):
    got = Counter(tuple(r) for r in near_duplicates(docs, shingle_words=size).collect())
    assert got == brute_components(size)


def test_near_duplicates_in_small_blocks(spark, monkeypatch):
    """A family whose members are linked through each other, spread over many blocks."""
    from shoplens.llm import near_dedup as N

    monkeypatch.setattr(N, "BLOCK_ROWS", 2)
    words = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(12):
        words = words[:]
        words[k * 11] = f"new{k}"
        words[k * 11 + 5] = f"other{k}"
        texts.append((100 - k, " ".join(words)))
    got = N.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), shingle_words=4).collect()
    assert {r.component_id for r in got} == {89}


def test_the_estimate_loses_fewer_pairs_than_the_bands():
    from shoplens.llm import near_dedup as N

    p = N.THRESHOLD / 100
    lost = sum(math.comb(N.BINS, k) * p**k * (1 - p) ** (N.BINS - k) for k in range(N.CUT))
    assert lost < (1 - p**N.ROWS) ** N.BANDS
    # sketches that agree on 104 bins, the first band among them, of sets at exactly 0.8
    one = np.arange(N.BINS, dtype="<u2")
    two = np.where(one < 104, one, one + 1000).astype("<u2")
    texts = [" ".join(f"w{i}" for i in range(94)), " ".join(f"w{i}" if i < 84 else f"n{i}" for i in range(94))]
    ids = [b"a", b"b"]
    fixed = {"bucket": [1, 1], "block": [0, 0], "cls": ids, "sketch": [one.tobytes(), two.tobytes()]}
    (found,) = N._forest(iter([pa.RecordBatch.from_pydict(fixed)]))
    assert found.to_pylist() == [{"a": b"b", "b": b"a"}]
    elements, ptr = N.shingle_sets(pa.array(texts), 5)
    more = {"out_block": [0, 0], "band": [0, 0], "component": ids, "outsider": [False, True], "as_outsider": [False, True]}
    more |= {"n": np.diff(ptr), "parity": N.parities(elements, ptr)}
    for best in (True, False):
        (found,) = N._across(N.THRESHOLD, best)(iter([pa.RecordBatch.from_pydict(fixed | more)]))
        assert found.to_pylist() == [{"a": b"b", "b": b"a"}]


def test_a_template_family_moves_few_texts(spark, monkeypatch):
    """Pages of one template share buckets without being links: few of their texts are fetched."""
    from shoplens.llm import near_dedup as N

    template = [f"t{i}" for i in range(140)]
    pages = [(k, " ".join([*template, *(f"p{k}_{i}" for i in range(60))])) for k in range(400)]
    fetched = []
    confirmed = N.NearDuplicates.confirmed

    def counting(self, pairs, classes):
        fetched.append(pairs.count())
        return confirmed(self, pairs, classes)

    monkeypatch.setattr(N.NearDuplicates, "confirmed", counting)
    got = near_duplicates(spark.createDataFrame(pages, "doc_id long, text string")).collect()
    assert len(got) == 400 and all(r.kept for r in got)
    assert sum(fetched[1:]) <= len(pages), fetched


def test_drop_near_duplicates(docs):
    got = drop_near_duplicates(docs).collect()
    ids = sorted((r.doc_id for r in got if r.doc_id is not None))
    assert ids == [1, 2, 3, 4, 8, 10, 11, 12, 13, 14] and len(got) == len(ids) + 1


def test_mix(docs):
    rows = mixed_sizes(docs).collect()
    sizes = [len(SPACES.findall(t or "")) for _, t, _ in TEXTS]
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((i, n) for (i, _, _), n in zip(TEXTS, sizes))
    by_source = Counter()
    for (_, _, s), n in zip(TEXTS, sizes):
        by_source[s] += n
    names = sorted((s for s in by_source if s is not None)) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes)
    while over := [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 3 * by_source[s]]:
        s = over[0]
        target[s], left = 3 * by_source[s], left - 3 * by_source[s]
        open_.discard(s)
    target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
    taken = Counter()
    source_of = {(i, n): s for (i, _, s), n in zip(TEXTS, sizes)}
    for r in rows:
        s = source_of[r.doc_id, r["size"]]
        assert r.source_size == by_source[s] and abs(r.target - target[s]) < 1e-6 and r.taken <= 3 * r["size"]
        taken[s] += r.taken
    # a source is off by half of one document (and its repeats) at most
    largest = {s: max(2 * n for (_, _, x), n in zip(TEXTS, sizes) if x == s) for s in names}
    assert all(2 * abs(taken[s] - target[s]) <= largest[s] + 2 for s in names)
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    words, texts, rounds = Counter(), {(i, t or "") for i, t, _ in TEXTS}, Counter()
    for r in mixed.collect():
        assert (r.doc_id, r.text or "") in texts, "a text that was cut"
        words[r.source] += len(SPACES.findall(r.text or ""))
        rounds[r.doc_id, r.text] += 1
    assert all(words[s] == taken[s] for s in names)
    # documents without words come as often as the whole epochs of their source, or once more
    whole = {s: round(target[s]) // by_source[s] for s in names}
    assert all(whole[s] <= rounds[i, t] <= whole[s] + 1 for i, t, s in TEXTS if not SPACES.search(t or ""))


def test_a_source_without_words_keeps_its_documents(spark):
    docs = spark.createDataFrame([(1, "", "e"), (2, None, "e"), (3, "a b c", "f")], "doc_id long, text string, source string")
    assert sorted(r.doc_id for r in mix(docs).collect()) == [1, 2, 3]
    assert {r.doc_id: r.taken for r in mixed_sizes(docs).collect()} == {1: 0, 2: 0, 3: 3}


def test_license_digest(docs):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    want = Counter()
    for i, t, _ in TEXTS:
        w = word.findall((t or "").translate(LOW))
        at, labels = [], set()
        for p, label in phrases.items():
            p = p.split()
            found = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            at += found
            labels |= {label} if found else set()
        want[i, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))] += 1
    got = license_digest(scan_licenses(docs)).collect()
    assert Counter(tuple(r)[:6] for r in got) == want
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)


def test_contained_detections_are_suppressed(spark):
    text = "Licensed under the Apache License, Version 2.0 and SPDX-License-Identifier: GPL-3.0-only"
    found = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().detections
    kept = {d.rule for d in found if d.kept}
    assert "apache software? license version|v 2 0" in kept and "base apache license" not in kept
    assert any(d.rule == "base apache license" and not d.kept for d in found)


def test_optional_words_present_and_absent():
    phrases = [(r, r.name.removeprefix("base ").split()) for r in build_rules()]
    for rule, words in phrases:
        optional = [k for k, w in enumerate(words) if w.endswith("?")]
        for present in itertools.product([False, True], repeat=len(optional)):
            out = {k for k, p in zip(optional, present) if not p}
            text = " ".join(w.rstrip("?").split("|")[0] for k, w in enumerate(words) if k not in out).encode()
            for around in (b"%s", b"the %s of", b"(%s)", b"a\n%s."):
                low = around % text
                words_of = set(re.findall(rb"[0-9a-z\x80-\xff]+", low))
                assert rule.pattern.search(low).group() == text and set(rule.keywords) <= words_of, (rule.name, low)
    assert not compile_phrase("gnu? general public license").search(b"gnugeneral public license")


def test_long_names_without_their_first_word(spark):
    texts = {
        "under the lesser general public license version 2.1": "lgpl",
        "The Affero General Public License": "agpl",
        "Affero General Public License, version 2": "agpl",
        "library general public license 1.0 or later": "lgpl",
        "the free documentation license": "gfdl",
        "Open Font License 1.1": "ofl",
        "the general public license version 3": "gpl",
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for (text, label), row in zip(texts.items(), scan_licenses(docs).orderBy("doc_id").collect()):
        assert {d.label for d in row.detections if d.kept} == {label}, text
        assert row.score > 0


def test_line_quality_measures(docs):
    want = Counter()
    for i, t, _ in TEXTS:
        t = t or ""
        w = SPACES.findall(t)
        lines = [x for x in t.split("\n") if SPACES.search(x)]
        seen = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        cover = {k + j for k in range(len(w) - 4) if seen[tuple(w[k : k + 5])] > 1 for j in range(5)}
        failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
        want[i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover), failed] += 1
    assert Counter(tuple(r)[:7] for r in line_quality(docs).collect()) == want


def test_frequent_lines_go(spark):
    body = "\n".join(f"own{k} line{k} {{0}} number{k} {k} with{k} several{k} more{k} words{k}" for k in range(4))
    rows = [(i, body.format(i) + "\nShared  Footer LINE of the host", "h") for i in range(8)]
    rows += [(20, "shared footer line of the host", "h"), (21, rows[0][1], "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clean = {r.doc_id: r.text for r in remove_frequent_lines(docs, min_documents=3, max_share=0.1).collect()}
    assert sorted(clean) == [*range(8), 21]
    assert clean[3] == body.format(3) and clean[21] == rows[0][1]
    left = {r.doc_id: (r.words_left, r.kept) for r in line_quality(docs, min_documents=3, max_share=0.1).collect()}
    assert left[3] == (36, True) and left[21] == (42, True) and left[20][1] is False


def test_a_line_has_one_verdict_in_small_and_hot_hosts(spark):
    """The same lines in as many documents of a host of 10 and of one of 600."""
    rows = []
    for host, n in (("small", 10), ("hot", 600), (None, 12)):
        for i in range(n):
            own = " ".join(f"{host}{i}word{k}" for k in range(12))
            rows.append((len(rows), own + "\nfooter of six" * (i < 6) + "\nfooter of five" * (i < 5), host))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = {r.doc_id: (r.n_words, r.words_left) for r in line_quality(docs).collect()}
    clean = {r.doc_id: r.text for r in remove_frequent_lines(docs).collect()}
    assert len(left) == len(clean) == len(rows)
    for i, text, _ in rows:
        n = len(text.split())
        assert left[i] == (n, n - 3 * ("six" in text)) and clean[i] == text.replace("\nfooter of six", "")


@pytest.fixture(scope="module")
def labelled(spark):
    rows, labels = [], []
    for i in range(400):
        bad, toxic = i % 4 == 0, i % 5 == 0
        words = [f"w{(i * 7 + k * 3) % 90}" for k in range(40)]
        if toxic:
            words[5:5] = ["vilest", "vilely"]
        rows.append((i, " ".join(x + "###" if bad else x for x in words)))
        labels.append((i, 0 if bad else 1, int(toxic)))
    labels += [(None, 1, 1), (7, None, None), (9999, 1, 1)]
    docs = spark.createDataFrame(rows + [(None, None), (1000, "")], "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifiers_on_held_out_rows(labelled):
    docs, labels = labelled
    quality = {r.doc_id: r for r in score_quality(docs, labels).collect()}
    toxic = {r.doc_id: r for r in score_toxicity(docs, labels).collect()}
    assert len(quality) == len(toxic) == 402
    for i in range(400):
        assert quality[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert toxic[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert quality[i].predicted == int(i % 4 != 0) and toxic[i].predicted == int(i % 5 == 0)
    assert 0 <= quality[None].score <= 1 and 0 <= toxic[1000].score <= 1
    kept = {r.doc_id for r in keep_good(docs, labels).collect()}
    assert {i for i in range(400) if i % 4} <= kept and not kept & {i for i in range(400) if i % 4 == 0}


def test_toxicity_in_blocks(labelled):
    docs, labels = labelled
    one = {r.doc_id: round(r.score, 9) for r in score_toxicity(docs, labels).collect()}
    many = {r.doc_id: round(r.score, 9) for r in score_toxicity(docs, labels, block_steps=2).collect()}
    assert one == many


def test_large_toxicity_weights_stay_off_the_driver(labelled, monkeypatch):
    docs, labels = labelled
    docs = docs.withColumn("text", F.expr("if(doc_id % 5 = 0, concat(text, ' snarly gruesome'), text)"))
    docs = docs.unionByName(docs.where("doc_id is null or doc_id in (5, 6)"))
    one = Counter((r.doc_id, round(r.score, 9)) for r in score_toxicity(docs, labels).collect())

    def refuse(self):
        raise AssertionError("the weights came to the driver")

    for collect in ("toPandas", "toArrow"):
        monkeypatch.setattr(type(docs), collect, refuse)
    many = Counter((r.doc_id, round(r.score, 9)) for r in score_toxicity(docs, labels, block_steps=1).collect())
    assert one == many and sum(one.values()) == 405


def test_single_class_gives_the_smoothed_share(labelled):
    docs, labels = labelled
    good = labels.where(F.col("quality") == 1).withColumn("toxic", F.lit(0))
    n = good.where(F.col("doc_id").isNotNull()).where("doc_id < 400 and crc32(string(doc_id)) % 3 != 1").count()
    assert score_quality(docs, good).first().score == pytest.approx((n + 1) / (n + 2))
    assert score_toxicity(docs, good).first().predicted == 0


def test_tree_rules_take_the_tightest_bounds():
    text = "Tree\n  If (feature 0 <= 5.0)\n   If (feature 0 <= 3.0)\n    Predict: 0.0\n   Else (feature 0 > 3.0)\n    Predict: 1.0\n"
    assert [r.bounds for r in tree_rules(text)] == [
        (("words", "<=", 5.0),), (("words", "<=", 3.0),), (("words", "<=", 5.0), ("words", ">", 3.0)),
    ]


def test_empty_tables(spark, nothing, tokenizer_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (
        count_tokens(nothing, tokenizer_path), encode_digests(nothing, tokenizer_path),
        encode_documents(nothing, tokenizer_path), token_positions(nothing, tokenizer_path, shards=2),
        exact_duplicates(nothing), drop_duplicates(nothing), near_duplicates(nothing), drop_near_duplicates(nothing),
        mixed_sizes(nothing), mix(nothing), license_digest(scan_licenses(nothing)), line_quality(nothing),
        remove_frequent_lines(nothing), score_quality(nothing, labels), score_toxicity(nothing, labels),
    ):
        assert out.count() == 0


def _toxicity_by_hand(rows, labels, words_of, left_out):
    """Length-normalised parts of the differences from the formulas, document by document, counts anew for each."""
    train = {i: labels[i] for i, _ in rows if i in labels and zlib.crc32(str(i).encode()) % 4 != 2}
    base = (sum(train.values()) + 1) / (len(train) + 2)
    holds = {i: {w[:k] + ("" if len(w) > k else "|") for w in words_of[i] for k in (4, 6, 10**9)} for i, _ in rows}

    def share(step, before, skip):
        n = [train[i] for i in train if i != skip and step in holds[i]]
        if not n:
            return before, 0
        off = sum(n) - len(n) * before
        z2 = off**2 / (len(n) * before * (1 - before) + 1)
        part = sum(z2 > b for b in (1, 4, 16, 64)) + 5 * (off < 0)
        return min(max(before + z2 / (z2 + 60) * (sum(n) / len(n) - before), 1e-3), 1 - 1e-3), part

    out = {}
    for i, _ in rows:
        skip, total = i if left_out and i in train else None, np.zeros(10)
        for w in words_of[i]:
            now = base
            for k in (4, 6, 10**9):
                step = w[:k] + ("" if len(w) > k else "|")
                then, part = share(step, now, skip)
                total[part] += math.log(then / (1 - then)) - math.log(now / (1 - now))
                now = then
                if len(w) <= k:
                    break
        out[i] = total / (len(words_of[i]) + 5)
    return out


def _toxic_rows(n, seed):
    rng = np.random.default_rng(seed)
    rows, labels = [], {}
    for i in range(n):
        words = [f"{'bcdfgk'[k % 6]}ord{k}" for k in rng.integers(0, 80, 12)]
        toxic = rng.random() < 0.2
        if toxic:
            words.insert(3, f"vile{rng.integers(0, 9)}mark")
        if rng.random() < 0.1:
            words.append("viledge")
        rows.append((i, " ".join(words)))
        if rng.random() < 0.9:
            labels[i] = int(toxic)
    return rows, labels


@pytest.mark.parametrize("block_steps", [2_000_000, 10])
def test_toxicity_by_hand(spark, monkeypatch, block_steps):
    """Scores are one logistic curve over the differences that the formulas give."""
    monkeypatch.setattr("shoplens.llm.toxicity.LEAST_WEIGHT", 0.0)
    rows, labels = _toxic_rows(160, 3)
    want = _toxicity_by_hand(rows, labels, {i: t.split() for i, t in rows}, False)
    got = score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"), block_steps=block_steps)
    got = {r.doc_id: math.log(r.score / (1 - r.score)) for r in got.collect()}
    parts = np.array([[*want[i], 1.0] for i in want])
    logits = np.array([got[i] for i in want])
    fitted = parts @ np.linalg.lstsq(parts, logits, rcond=None)[0]
    assert np.abs(fitted - logits).max() < 1e-3 * np.abs(logits).max()
    toxic = [got[i] for i in want if labels.get(i) == 1]
    assert min(toxic) > np.median(logits)


def test_counts_leave_the_document_out(spark, monkeypatch):
    from shoplens.llm import toxicity as X

    monkeypatch.setattr(X, "LEAST_WEIGHT", 0.0)
    rows, labels = _toxic_rows(80, 4)
    seen = []
    differences = X._differences

    def noted(rows, weights, table):
        out = differences(rows, weights, table)
        seen.append({r.id: np.array(r.parts) / (r.n_words + 5) for r in out.collect()})
        return out

    monkeypatch.setattr(X, "_differences", noted)
    score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"))
    by_hand = _toxicity_by_hand(rows, labels, {i: t.split() for i, t in rows}, True)
    assert seen[0] and all(np.abs(by_hand[i] - d).max() < 1e-5 for i, d in seen[0].items())


def test_rare_toxic_expressions_are_found(spark):
    """2,000 rows, one in nine toxic by one of 60 words that no ordinary row has."""
    rng = np.random.default_rng(1)
    rows, labels, marks = [], [], {}
    for i in range(2000):
        words = [f"{'bcdfgklm'[k % 8]}{'aeiou'[k % 5]}n{k}" for k in rng.integers(0, 600, 30)]
        toxic = i % 9 == 0
        if toxic:
            marks[i] = f"zq{rng.integers(0, 60)}vile"
            words.insert(int(rng.integers(0, 30)), marks[i])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    got = {r.doc_id: r for r in score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    known = {marks[i] for i in marks if not got[i].held_out}
    known = [i for i in marks if got[i].held_out and marks[i] in known]
    wrong = [i for i in got if got[i].held_out and i not in marks and got[i].predicted]
    assert len(known) > 30 and sum(got[i].predicted for i in known) >= 0.8 * len(known)
    assert len(wrong) <= 0.03 * len(rows) / 4


def test_license_spellings(spark):
    texts = {
        "SPDX-License-Identifier: Apache-2.0": "apache",
        "// SPDX-License-Identifier: GPL-2.0-or-later": "gpl",
        "SPDX-License-Identifier: LGPL-2.1-only": "lgpl",
        "Apache-2.0": "apache",
        "under GPLv2+ or so": "gpl",
        "GPLv3": "gpl",
        "license: MIT": "mit",
        "License = BSD-3-Clause": "bsd",
        "the band has all rights reserved for two seats": "",
        "Redistribution and use in source and binary forms, with or without modification, are permitted. All rights reserved.": "bsd",
        "mitten licensed apachean": "",
    }
    for label, names, versions in FAMILIES:
        for short in [n for n in names if " " not in n]:
            texts |= {f"SPDX-License-Identifier: {short.upper()}-{v.replace(' ', '.')}": label for v in versions}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_digest(scan_licenses(docs)).collect()}
    assert got == dict(enumerate(texts.values()))


def test_license_rules_without_gate(spark):
    """Labels, suppression and score against every rule tried on every text and all pairs of detections."""
    rules = build_rules()
    assert len({r.name for r in rules}) == len(rules) and len(CLAUSES) > 200
    rng = np.random.default_rng(2)

    def spelled(phrase):
        words = []
        for w in phrase.split():
            if w.endswith("?") and rng.random() < 0.5:
                continue
            words.append(str(rng.choice(w.rstrip("?").split("|"))))
        return str(rng.choice([" ", "-", ".\n"])).join(words)

    names = [r.name.removeprefix("base ") for r in rules]
    texts = [spelled(n) for n in names]  # every rule once
    for _ in range(120):
        parts = [spelled(names[k]) for k in rng.integers(0, len(names), 4)] + ["some words", "the license of the program"]
        texts.append(" ".join(parts[k] for k in rng.permutation(len(parts))).title())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in scan_licenses(docs).collect():
        low = texts[row.doc_id].encode().lower()
        found = [(m.start(), m.end(), k) for k, r in enumerate(rules) for m in r.pattern.finditer(low)]
        assert found
        kept = [
            (a, b, k) for a, b, k in found
            if not any(
                (x, y, j) != (a, b, k) and x <= a and b <= y and rules[j].priority >= rules[k].priority
                and ((x, y) != (a, b) or rules[j].priority > rules[k].priority or j < k)
                for x, y, j in found
            )
        ]
        assert sorted((d.start, d.end, d.rule) for d in row.detections) == sorted((a, b, rules[k].name) for a, b, k in found)
        assert sorted((d.start, d.end, d.rule) for d in row.detections if d.kept) == sorted((a, b, rules[k].name) for a, b, k in kept)
        sure = {}
        for _, _, k in kept:
            sure[rules[k].label] = max(sure.get(rules[k].label, 0), CONFIDENCE[rules[k].priority])
        assert abs(row.score - (1 - math.prod(1 - x for x in sure.values()))) < 1e-9


def test_dedup_shuffles_no_texts(docs, monkeypatch):
    """Beyond a broadcast the same rows come out, and no exchange of the report carries a text."""
    want = Counter(map(str, exact_duplicates(docs).collect()))
    kept = Counter(map(str, drop_duplicates(docs).collect()))
    monkeypatch.setattr("shoplens.llm.common.BROADCAST_BYTES", 0)
    report = exact_duplicates(docs)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join" in line]
    assert joins and "broadcast" not in plan
    for side in (report._jdf.queryExecution().executedPlan().toString()).split("Exchange")[1:]:
        assert " text#" not in side.split("\n")[1], side[:300]
    assert Counter(map(str, report.collect())) == want
    assert Counter(map(str, drop_duplicates(docs).collect())) == kept


def _statistics_by_hand(text):
    words = SPACES.findall(text)
    lines = text.split("\n")
    n = max(len(words), 1)
    uppers = re.findall(r"[A-ZÀ-ÖØ-Þİ]{2,}", text)
    return (
        len(words),
        len(text) / n if words else 0,
        sum(c in "#*$%&|<>" for c in text) / n,
        sum(c in "0123456789" for c in text) / n,
        len(uppers) / n,
        sum(c in "!?" for c in text) / n,
        sum(c in ".,;:" for c in text) / n,
        len(set(words)) / n,
        len(set(lines)) / len(lines),
        len(words) / len(lines),
    )


def test_quality_by_hand(spark, docs, labelled):
    """Statistics, rules and scores recomputed; printed trees agree with what the forest predicts."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    from shoplens.llm import quality_classifier as X

    rows = X.with_statistics(docs.select(F.coalesce("text", F.lit("")).alias("text"), F.col("text").alias("t")), "t").collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        want = _statistics_by_hand(r.t or "")
        assert all(abs(r[name] - w) < 1e-9 for name, w in zip(X.STATISTICS, want)), (r, want)

    own, labels = labelled
    table = X.with_statistics(X.labelled(own.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text")), labels, "quality"), "id", "label").cache()
    model = X.fit(table)
    assert model.rules
    scored = table.select("*", model.score().alias("score")).collect()
    for r in scored:
        total = model.intercept
        for rule, weight in model.rules:
            total += weight * all(r[name] <= v if side == "<=" else r[name] > v for name, side, v in rule.bounds)
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-9

    vectors = table.select("label", array_to_vector(F.array(*X.STATISTICS)).alias("features"))
    forest = RandomForestClassifier(labelCol="label", numTrees=5, maxDepth=3, seed=3).fit(vectors)
    for tree in forest.trees:
        rules = X.tree_rules(tree.toDebugString)
        # of the paths that hold for a row the longest is its leaf's; rows of one leaf are predicted alike
        predicted = {}
        for r in table.collect():
            hold = [k for k, rule in enumerate(rules) if all(r[n] <= v if s == "<=" else r[n] > v for n, s, v in rule.bounds)]
            values = [r[n] for n in X.STATISTICS]
            predicted.setdefault(tuple(hold), set()).add(tree.predict(Vectors.dense(values)))
        assert all(len(p) == 1 for p in predicted.values())
        assert len(rules) <= 14


def test_line_quality_kept_by_hand(spark):
    """The verdict from counts of distinct texts per host and line."""
    rng = np.random.default_rng(4)
    footers = [f"Footer {k} of  the HOST {k}" for k in range(6)]
    rows = []
    for i in range(160):
        host = ["h", "g", None][int(rng.integers(0, 3))]
        body = [" ".join(f"{host}{i}w{rng.integers(0, 60)}" for _ in range(int(rng.integers(3, 14)))) for _ in range(int(rng.integers(0, 4)))]
        lines = body + [footers[int(k)] for k in rng.integers(0, 6, int(rng.integers(0, 8)))]
        rows.append((i, "\n".join(lines), host))
    rows += [(200, rows[0][1], rows[0][2]), (None, None, "h"), (201, rows[1][1], rows[1][2])]
    seen = Counter()
    for text, host in {(t or "", h) for _, t, h in rows}:
        for line in {" ".join(SPACES.findall(x.translate(LOW))) for x in text.split("\n")} - {""}:
            seen[host, line] += 1
    want = Counter()
    for i, text, host in rows:
        text = text or ""
        words = SPACES.findall(text)
        left = sum(len(SPACES.findall(x)) for x in text.split("\n") if seen[host, " ".join(SPACES.findall(x.translate(LOW)))] <= 5)
        windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        cover = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
        failed = len(words) < 10 or 100 * len(cover) > 20 * len(words)
        want[i, failed, not failed and left >= 10 and left >= 0.3 * len(words), left] += 1
    got = line_quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert Counter((r.doc_id, r.base_failed, r.kept, r.words_left) for r in got) == want
    assert 10 < sum(n for (_, _, kept, _), n in want.items() if kept) < len(rows) - 10
    assert list(got[0].asDict())[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
