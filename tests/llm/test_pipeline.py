"""The corpus pipeline: every stage against brute force on the rows that the stage before it kept."""

from __future__ import annotations

import glob
import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as P
from shoplens.llm import quality_classifier as Q
from shoplens.llm.common import prepare
from shoplens.spark import ensure_checkpoint_dir
from tests.llm.test_ngram_join import brute as similar_texts

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def made() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(12)
    docs, labels = [], []

    def add(text, source):
        docs.append((len(docs), text, "en", source, None if text is None else len(text)))

    for i in range(160):
        words = [f"w{rng.randrange(800)}" for _ in range(rng.randint(12, 60))]
        if i % 4 == 0:
            words = [w + "###" for w in words]
        add(" ".join(words) + ".", rng.choice(["a", "b", "c", "d", None]))
        labels.append((i, int(i % 4 != 0), 0))
    good = [d[1] for d in docs if d[0] % 4]
    for text in good[:20]:
        add(text, rng.choice("ab"))  # copies
    for text in good[20:40]:
        words = text.split()
        add(" ".join([*words[:-1], "changed."]), "c")  # near copies if long enough
    for text in (None, "", " \n ", "It's <|endoftext|> 42", "x" * 3000):
        add(text, rng.choice("ab"))
    docs += [(None, good[50], "en", "a", 1), (None, None, "en", None, None), (None, "no id here but some words", "en", "a", 1)]
    docs.append(docs[1])
    return docs, labels


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first and after every stage."""
    prepare(spark)
    docs, labels = made()
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    out = [now.collect()]
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, now, folder).write.parquet(f"{folder}/stage{k}")
        now = spark.read.parquet(f"{folder}/stage{k}")
        out.append(now.collect())
        if k < len(P.STAGES) - 1:
            assert now.columns == spark.read.parquet(f"{folder}/documents.parquet").columns
    return folder, out


def test_order():
    assert [n for n, _ in P.STAGES] == ["quality classifier", "exact dedup", "near dedup", "source mix", "bpe encoding"]


def test_quality_classifier(spark, stages):
    folder, rows = stages
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scores = Q.score_quality(docs, labels).collect()
    assert Counter(r.doc_id for r in rows[1]) == Counter(r.doc_id for r in scores if r.score >= 0.5)
    assert not Counter(rows[1]) - Counter(rows[0])
    kept = {r.doc_id for r in rows[1]}
    assert not any(i in kept for i in range(0, 160, 4)) and all(i in kept for i in range(160) if i % 4)


def test_exact_dedup(stages):
    _, (_, before, after, *_) = stages
    best = defaultdict(list)
    for r in before:
        best[r.text or ""].append(r)
    want = Counter(max(own, key=lambda r: (r.doc_id is not None, r.doc_id or 0)).doc_id for own in best.values())
    assert Counter(r.doc_id for r in after) == want
    assert len({r.text or "" for r in after}) == len(after) < len(before)


def test_near_dedup(stages):
    _, (_, _, before, after, *_) = stages
    found = similar_texts([(r.doc_id, r.text) for r in before])
    want = Counter(i for i, _, component in found if i == component)
    assert Counter(r.doc_id for r in after) == want
    assert len(after) < len(before)


def test_mix(stages):
    _, (_, _, _, before, after, _) = stages
    texts, size, of_source = Counter((r.doc_id, r.text, r.source) for r in before), Counter(), defaultdict(list)
    for r in before:
        size[r.source] += len((r.text or "").split())
        of_source[r.source].append(len((r.text or "").split()))
    assert set((r.doc_id, r.text, r.source) for r in after) <= set(texts), "a text that was cut or made up"
    taken = Counter()
    for r in after:
        taken[r.source] += len((r.text or "").split())
    names = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(size.values())
    while over := [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 3 * size[s]]:
        s = over[0]
        target[s], left = 3 * size[s], left - 3 * size[s]
        open_.discard(s)
    target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
    for s in names:
        assert abs(taken[s] - target[s]) <= max(of_source[s]) / 2 + 1
    assert max(Counter((r.doc_id, r.text) for r in after).values()) <= 3


def test_bpe_encoding(stages, tokenizer_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path)
    _, (*_, before, after) = stages
    assert Counter((r.doc_id, r.text) for r in before) == Counter((r.doc_id, r.text) for r in after)
    for r in after:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        assert r.token_ids == ids and r.decoded == tok.decode(ids, skip_special_tokens=False)


def test_run_leaves_its_result_alone(spark, stages):
    folder, rows = stages
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{root}/*"))
    out = P.run(spark, folder)
    assert Counter(map(str, out.collect())) == Counter(map(str, rows[-1]))
    assert len(set(glob.glob(f"{root}/*")) - before) == 1


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
