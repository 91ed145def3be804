"""Rows and lines that an operator used to leave out or take for others."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from signalweave.llm import labelled, pii, quality_model


def texts(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_pipeline_removes_repeats_of_short_lines(spark, make):
    """Exact copies of any line with a word; edits only as the length allows; marks and blanks stay."""
    rows = [
        (1, "All rights reserved.\n---\nYes\n\nPart 1\nLicensed under CC BY-NC 4.0."),
        (2, "All rights reserved.\n---\nYet\n\nPart 2\nLicensed under CC BY-NC 4.0"),
        (3, "Yes\nAll rights reserved\n---\n\nAll rights deserve.\n第一\nYes"),
        (4, "第一\nAll lights reserved\nof its own"),
    ]
    expected = [
        (1, rows[0][1]),
        (2, "---\nYet\n\nPart 2"),
        (3, "---\n\nAll rights deserve.\n第一"),
        (4, "of its own"),
    ]
    assert texts(corpus_pipeline.drop_repeated_lines(spark, make(rows), "")) == Counter(expected)


def prose(seed, n=60):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(10_000)}" for _ in range(n))


def test_pipeline_keeps_one_row_per_group_whatever_the_ids(spark, make, awkward):
    """Different texts without an id, or of one id, all stay; of each group of copies exactly one row does."""
    clean = [(None, prose(i)) for i in range(20)] + [(7, prose(30)), (7, prose(31))]
    # The group's least id has a text of another group too.
    copies = [(5, prose(40)), (5, prose(41)), (6, prose(41)), (None, prose(41)), (8, prose(40)), (8, prose(40))]
    lone = [(None, prose(50)), (None, prose(50)), (None, prose(50)), (None, None), (None, ""), (9, None)]
    left = corpus_pipeline.drop_near_duplicates(spark, make(clean + copies + lone), "")
    assert left.columns == awkward[0].columns
    expected = [*clean, *copies[:2], lone[0], (9, None)]
    assert texts(left) == Counter(expected)
    df, rows = awkward
    # Both texts of id 1 are groups of their own; 2, 3 and 4 have no word and are one group.
    assert texts(corpus_pipeline.drop_near_duplicates(spark, df, "")) == Counter(rows[i] for i in (1, 2, 3, 4, 7, 8))


def test_pipeline_removes_lines_that_repeat_without_an_id(spark, make):
    """Rows of one id, of none, and rows that are equal in all: a line stays in the first of them only."""
    line, near = "a line of some length that stands in many rows", "a line of some length that stends in many rows"
    rows = [(None, f"{line}\nown {i}xx{i}{i}") for i in range(6)] + [(3, f"{line}\n{prose(i)}") for i in range(3)]
    rows += [(3, near), (None, near), (None, "equal in all"), (None, "equal in all"), (None, None)]
    left = corpus_pipeline.drop_repeated_lines(spark, make(rows), "").collect()
    assert len(left) == len(rows) and Counter(r.doc_id for r in left) == Counter(i for i, _ in rows)
    lines = Counter(x for r in left for x in (r.text or "").split("\n"))
    assert lines[line] == 1 and lines[near] == 0 and lines["equal in all"] == 1
    assert [r.doc_id for r in left if line in (r.text or "")] == [3]
    assert all(lines[x] == 1 for _, t in rows for x in (t or "").split("\n") if x and x != near)
    assert [r.text for r in left].count(None) == 1


def test_pipeline_drops_contaminated_rows_only(spark, make, tmp_path):
    """A row that contains an item takes no clean row of its id, or without one, along."""
    items = [(i, prose(100 + i, 20)) for i in range(3)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(None, prose(i)) for i in range(10)] + [(1, prose(20)), (2, prose(21)), (None, None), (1, None), (None, "")]
    dirty = [(None, f"{prose(30)} {items[0][1]}"), (1, f"{items[1][1]} {prose(31)}"), (1, items[2][1]), (1, items[2][1])]
    left = corpus_pipeline.drop_contaminated(spark, make(clean + dirty), str(tmp_path))
    assert left.columns == make(clean).columns
    assert texts(left) == Counter(clean)


@pytest.mark.parametrize(
    ("kind", "hidden"),
    [
        ("email", "alice@example dot com"),
        ("email", "alice@mail dot example dot com"),
        ("email", "alice@example[dot]com"),
        ("email", "alice@example (dot) com"),
        ("email", "alice at example[dot]com"),
        ("email", "alice at example (dot) com"),
        ("email", "jane (dot) doe at mail.example {punkt} com"),
        ("email", "name@host[.]com"),
        ("email", "x.42 at mail8[.]example[.]com"),
        ("ip", "192[.]168[.]0[.]1"),
        ("ip", "192 (dot) 168 (dot) 0 (dot) 1"),
    ],
)
def test_spelled_and_bracketed_dots_are_found_without_a_bracketed_at(kind, hidden):
    for before, after in (("", ""), ("é😀 write to: ", ", please"), ("(", ")")):
        text = f"{before}{hidden}{after}"
        base, every = pii.all_spans(text)
        whole = (kind, len(before), len(before) + len(hidden))
        assert whole in every and whole not in base, (text, every)


def test_bracketed_dots_alone_hide_nothing():
    for text in ("see [.] and (dot) there", "a(.)b matches any", "found at once (dot)", "version 1[.]2", "x -.- y @ home"):
        assert pii.disguised_spans(text) == [], text


def test_quality_learns_from_the_whole_bounded_sample(monkeypatch):
    """The common bound holds, and what is stored of a row gives its features back."""
    bounds = []
    monkeypatch.setattr(labelled, "training_rows", lambda *a: bounds.append((a + (labelled.SAMPLE_ROWS,))[5]))
    monkeypatch.setattr(quality_model, "train", lambda rows: (_ for _ in ()).throw(KeyError))
    with pytest.raises(KeyError):
        quality_model.quality_query(None, "")
    assert bounds == [12_000]
    for text in ("", "a", "é é é " * 50_000, prose(1, 5000)):
        at, n = quality_model.features(text.encode())
        got = quality_model.unpacked(quality_model.packed(at, n))
        assert np.array_equal(got[0], at) and np.array_equal(got[1], n)
