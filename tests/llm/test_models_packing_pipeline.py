"""Held-out accuracy of the classifiers, packing as an exact round trip, the pipeline as a whole."""

from __future__ import annotations

import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from signalweave.llm import decontaminate, labelled, packing, quality_model, toxicity
from signalweave.llm.queries import ORACLE, QUERIES
from signalweave.llm.token_counts import vocabulary_path
from tests.compare import differences, oracle

FOLDER = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def area(scores, labels):
    """Chance that a row of label 1 scores above one of label 0."""
    order = np.argsort(scores)
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(len(scores))
    ones = np.asarray(labels) == 1
    n1, n0 = ones.sum(), (~ones).sum()
    return (ranks[ones].sum() - n1 * (n1 - 1) / 2) / (n1 * n0)


@pytest.mark.parametrize(
    ("name", "label", "folds", "out", "least"),
    [("op7_quality_model", "quality", 3, 1, 0.95), ("op10_toxicity", "toxic", 5, 0, 0.9)],
)
def test_held_out_accuracy(spark, name, label, folds, out, least):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == out) for r in rows)
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    assert area([s for s, _ in held], [y for _, y in held]) > least


def test_training_rows_leave_the_held_out_fold(spark):
    rows = labelled.training_rows(spark, FOLDER, "quality", 3, 1)
    ids = [r.doc_id for r in rows.select("doc_id").collect()]
    assert ids and not any(zlib.crc32(str(i).encode()) % 3 == 1 for i in ids)
    few = labelled.training_rows(spark, FOLDER, "quality", 3, 1, bound=50).count()
    assert 15 < few < 110


def test_scores_of_awkward_rows(awkward, empty):
    df, rows = awkward
    table, bias = np.zeros(1 << quality_model.HASH_BITS), 0.5
    got = {r.score for r in quality_model.score(df, table, bias).collect()}
    assert got == {1 / (1 + np.exp(-0.5))}
    assert quality_model.score(empty, table, bias).count() == 0
    at, w = np.array([1 << toxicity.HASH_BITS]), np.array([-1.0])
    scored = toxicity.score(df, at, w).collect()
    assert len(scored) == len(rows) and {round(r.score, 12) for r in scored} == {round(1 / (1 + np.e), 12)}
    assert toxicity.score(empty, at, w).count() == 0


def test_models_without_labelled_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, label int, shard int")
    at, w = toxicity.train(none)
    assert len(at) == len(w) == 0
    table, bias = quality_model.train(none, rounds=1)
    assert table.shape == (1 << quality_model.HASH_BITS,) and bias == 0


def test_a_word_scores_the_same_alone_and_among_others():
    words = [b"plain", b"x", "é!".encode()]
    rows, owner = quality_model.grams(words)
    for i, word in enumerate(words):
        alone, _ = quality_model.grams([word])
        assert sorted(rows[owner == i].tolist()) == sorted(alone.tolist())


def test_quality_of_very_long_texts_in_bounded_memory():
    """The same features in pieces as at once, also of one word without end; memory does not follow the text."""
    words = [b"w%d" % (i % 977) for i in range(7000)]
    text = b" ".join(words)
    rows = quality_model.grams(words)[0]
    at, n = quality_model.features(text)
    expected = np.unique(rows, return_counts=True)
    assert np.array_equal(at, expected[0]) and np.array_equal(n, expected[1])
    same = b"again " * 5000
    at, n = quality_model.features(same)
    assert n[at == quality_model.REPEAT].tolist() == [4 * 4999]
    tracemalloc.start()
    quality_model.features(b"x" * 3_000_000)
    quality_model.features(b"some words " * 300_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20


def test_ftrl_pass_equals_a_plain_loop():
    """The update of the published algorithm, coordinate by coordinate in double precision."""
    rows = pd.DataFrame({"at": [[0, 2], [1], [0, 1, 3], []] * 5, "label": [1, 0, 1, 0] * 5})
    got = toxicity.pass_over(np.zeros((2, 5)), rows, 0)
    z, n = [0.0] * 5, [0.0] * 5
    for at, label in zip(rows["at"], rows["label"]):
        w = {}
        for i in [*at, 4]:
            sign = (z[i] > 0) - (z[i] < 0)
            rate = (toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2
            w[i] = 0.0 if abs(z[i]) <= toxicity.L1 else -(z[i] - sign * toxicity.L1) / rate
        g = 1 / (1 + np.exp(-sum(w.values()))) - label
        for i in w:
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / toxicity.ALPHA
            z[i] = float(z[i] + g - sigma * w[i])
            n[i] = float(n[i] + g * g)
    assert np.allclose(got[0], z, atol=1e-12) and np.allclose(got[1], n, atol=1e-12)


def test_gradient_step_equals_differences_of_the_loss():
    """One step moves every parameter against the slope of the loss, taken by small differences."""
    model = np.random.default_rng(1).normal(size=((1 << 4) + 3, quality_model.WIDTH))
    model[-1, 2:] = 0
    at, n = np.array([2, 5, 9]), np.array([1, 2, 1])

    def loss(m):
        logits = m[-3:-1] @ ((n / n.sum()) @ m[at]) + m[-1, :2]
        return np.log(np.exp(logits).sum()) - logits[1]

    row = pd.DataFrame({"packed": [quality_model.packed(at, n)], "label": [1]})
    moved = quality_model.pass_over(model.copy(), row, 0) - model
    for i, j, rate in ((2, 0, 1.0), (5, 3, 1.0), (-3, 1, 0.1), (-2, 4, 0.1), (-1, 0, 0.01), (-1, 1, 0.01)):
        up, down = model.copy(), model.copy()
        up[i, j] += 1e-5
        down[i, j] -= 1e-5
        slope = (loss(up) - loss(down)) / 2e-5
        assert abs(moved[i, j] + quality_model.RATE * rate * slope) < 1e-4


def test_calibration_puts_the_decision_between_the_labels():
    logits, labels = np.array([-9.0, -8, -7, -6, -2, -1]), np.array([0, 0, 0, 0, 1, 1])
    scale, shift = toxicity.calibration(logits, labels)
    assert ((scale * logits + shift >= 0) == (labels == 1)).all()
    assert toxicity.calibration(logits, np.zeros(6)) == (1.0, 0.0)
    assert toxicity.calibration(logits[::-1], labels) == (1.0, 0.0)
    assert toxicity.calibration(np.zeros(0), np.zeros(0)) == (1.0, 0.0)


def check_packing(pieces, docs, limit):
    """Every id of every document in exactly one piece; sequences gapless and no longer than the limit."""
    library = Tokenizer.from_file(vocabulary_path(packing.VOCABULARY))
    expected = sorted(
        (str(i), bytes(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4"))) for i, t in docs
    )
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in pieces:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
        by_doc[str(r.doc_id)].append(r)
        sequences[r.sequence_id].append(r)
    whole = []
    for name, parts in by_doc.items():
        # Documents that share an id are told apart by their sizes and checksums only when unique.
        if len({p.doc_tokens for p in parts}) == 1 and sum(p.length for p in parts) == parts[0].doc_tokens:
            parts.sort(key=lambda p: p.start)
            assert [p.start for p in parts] == list(np.cumsum([0, *[p.length for p in parts]])[:-1])
            whole.append((name, b"".join(p.ids for p in parts)))
    unique = [e for e in expected if [n for n, _ in expected].count(e[0]) == 1]
    assert sorted(w for w in whole if w[0] in {n for n, _ in unique}) == unique
    assert sum(p.length for p in pieces) == sum(len(b) // 4 for _, b in expected)
    padding = 0
    for parts in sequences.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == list(np.cumsum([0, *[p.length for p in parts]])[:-1])
        size = sum(p.length for p in parts)
        assert size <= limit
        padding += 0 if size & (size - 1) == 0 else limit - size
    return padding, len(sequences)


def test_packing_is_an_exact_round_trip(make, awkward, empty):
    docs = [(i, " ".join(f"word{j % 7}" for j in range(i * 13 % 90))) for i in range(300)]
    for open_windows in (1, 3, 32):
        pieces = packing.pack(make(docs), limit=64, open_windows=open_windows).collect()
        padding, n = check_packing(pieces, docs, 64)
        assert padding <= n * packing.LEAST_PIECE
    df, rows = awkward
    check_packing(packing.pack(df).collect(), rows, packing.LIMIT)
    assert packing.pack(empty).count() == 0


def test_packing_wastes_little(spark):
    pieces = QUERIES["op6_packing"](spark, FOLDER)
    size = pieces.groupBy("sequence_id").agg(F.sum("length").alias("size"))
    got = [r.size for r in size.collect()]
    padded = sum(packing.LIMIT - s for s in got if s & (s - 1))
    assert padded < 0.005 * sum(got)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), oracle(FOLDER), ORACLE[name]) == []


def test_pipeline_stages(spark, tmp_path):
    """Each stage on what the one before kept; the columns stay until the last; decisions take effect."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        if i < 4:
            assert docs.columns == columns
            sizes.append(docs.count())
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] > sizes[4] > 0
    # Each stage is judged on its own input: line dedup may already have taken a passage out.
    before, after = (spark.read.parquet(str(tmp_path / i)) for i in "23")
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    dirty = {r.doc_id for r in decontaminate.contained_items(before, items).collect()}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - dirty
    assert corpus_pipeline.run(spark, SMALL).columns == docs.columns


def test_pipeline_of_awkward_rows(spark, awkward, tmp_path):
    docs, _ = awkward
    docs = docs.withColumn("n_chars", F.char_length("text"))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
    assert docs.count() == 0


def test_each_stage_takes_awkward_rows(spark, awkward, empty, tmp_path):
    """Every stage gets the awkward rows themselves, not what an earlier stage left of them."""
    docs, rows = awkward
    docs = docs.withColumn("n_chars", F.char_length("text"))
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        got[name] = spark.read.parquet(str(tmp_path / name))
        assert stage(spark, empty.withColumn("n_chars", F.char_length("text")), SMALL).count() == 0
        if name != "packing":
            assert got[name].columns == docs.columns
    assert got["quality_rules"].count() == 0
    lines = Counter((r.doc_id, r.text, r.n_chars) for r in got["line_dedup"].collect())
    assert sum(lines.values()) == len(rows)
    assert lines[2, None, None] == lines[3, "", 0] == lines[None, "a text without an id", 20] == 1
    assert lines[1, rows[0][1], len(rows[0][1])] == lines[1, "", 0] == 1
    near = Counter((r.doc_id, r.text) for r in got["simhash_near_dedup"].collect())
    assert near[rows[0]] == near[rows[2]] == near[rows[3]] == 1
    assert sum(n for (i, _), n in near.items() if i in (2, 3, 4)) == 1
    clean = Counter((r.doc_id, r.text) for r in got["decontamination"].collect())
    assert clean == Counter(rows)
    pieces = got["packing"].groupBy("doc_id").agg(F.countDistinct("sequence_id").alias("n"), F.sum("length").alias("size")).collect()
    assert {r.doc_id for r in pieces} == {i for i, _ in rows}
    assert all(r["size"] == 1 for r in pieces if r.doc_id in (2, 3))
