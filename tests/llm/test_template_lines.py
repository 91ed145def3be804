"""Lines of one template: the pairs that are compared follow the lines, and none that is near is lost."""

from __future__ import annotations

import random

import pytest

from signalweave.llm import line_dedup
from tests.llm import test_near_duplicates as plain
from tests.llm.test_near_duplicates import plain_line_dedup

LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"


def word(draw, size):
    return "".join(draw.choice(LETTERS) for _ in range(size))


def compared(monkeypatch, df):
    """The number of pairs whose texts are compared."""
    sizes, plain = {}, line_dedup.stored

    def noted(table, purpose):
        out = plain(table, purpose)
        if purpose in ("line-pairs", "line-meetings"):
            sizes[purpose] = out.filter("b IS NOT NULL").count()
        return out

    monkeypatch.setattr(line_dedup, "stored", noted)
    line_dedup.without_repeated_lines(df, least=None, by_row=True).collect()
    return max(sizes.values())


@pytest.mark.parametrize(
    "template", ["Order number {} was shipped from our central warehouse today", "Part {:.3} of the batch goes to room {:.3} of the second floor now"]
)
def test_template_lines_do_not_meet_in_all_pairs(make, monkeypatch, template):
    draw = random.Random(3)
    counts = (500, 1000, 2000) if "number" in template else (300, 900)
    sizes = []
    for n in counts:
        rows = [(i, template.format(word(draw, 6), word(draw, 3))) for i in range(n)]
        sizes.append(compared(monkeypatch, make(rows)))
        monkeypatch.undo()
    if "number" in template:
        assert all(size <= n for size, n in zip(sizes, counts)), sizes
    else:
        # A character of each word may differ: about 2 x 3 x 36 x 3 x 36 of the 36^6 lines are near any line.
        assert all(size < 0.05 * n * (n - 1) / 2 for size, n in zip(sizes, counts)), sizes


@pytest.mark.parametrize("limits", [(48, 24), (3, 1), (0, 0)])
def test_near_lines_of_templates_are_found(make, monkeypatch, limits):
    monkeypatch.setattr(line_dedup, "STRETCH", limits[0])
    monkeypatch.setattr(line_dedup, "SEGMENT", limits[1])
    monkeypatch.setattr(line_dedup, "CROWDED", 3)
    draw = random.Random(5)
    forms = ["Order {} was sent to {} today by rail", "{} and no more than {}", "the last word here is {}{}"]
    rows = [(i, draw.choice(forms).format(draw.choice("abcd") * draw.randint(0, 3) + word(draw, 1), draw.randint(8, 1020))) for i in range(160)]
    got = line_dedup.without_repeated_lines(make(rows), edits=2, least=8).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(plain_line_dedup(rows, 2, 8), key=str)


def text_around(draw, before, after):
    return word(draw, before) + "{}" + word(draw, after)


def test_long_strings_of_a_template_do_not_meet_in_all_pairs(make, monkeypatch):
    """The lines differ in 60 characters that lie in two neighbouring segments."""
    draw = random.Random(4)
    form = text_around(draw, 198, 202)
    for n in (300, 600):
        assert compared(monkeypatch, make([(i, form.format(word(draw, 60))) for i in range(n)])) <= n
        monkeypatch.undo()


@pytest.mark.parametrize("limits", [(16, 48, 24), (3, 16, 14)])
def test_near_lines_with_long_strings_are_found(make, monkeypatch, limits):
    """Long strings that share nothing, that share a long middle, and that are apart in two segments."""
    for name, value in zip(("CROWDED", "STRETCH", "SEGMENT"), limits):
        monkeypatch.setattr(line_dedup, name, value)
    whole = plain.distance

    def distance(a, b):
        """The edit distance, of which equal ends are no part."""
        least = min(len(a), len(b))
        start = next((i for i in range(least) if a[i] != b[i]), least)
        end = next((i for i in range(least - start) if a[-1 - i] != b[-1 - i]), least - start)
        return whole(a[start : len(a) - end], b[start : len(b) - end])

    monkeypatch.setattr(plain, "distance", distance)
    draw = random.Random(6)
    one, two, three = text_around(draw, 198, 202), text_around(draw, 150, 150), text_around(draw, 60, 30)
    middle, far = word(draw, 44), word(draw, 150)
    lines = []
    for i in range(20):
        for line in (
            one.format(word(draw, 60)), two.format(word(draw, 8) + middle + word(draw, 8)),
            three.format(word(draw, 26) + far + word(draw, 26)),
        ):
            lines.append(line)
            if i % 3 == 0:
                lines += [plain.edited(draw, line, n, "ab") for n in (1, 2, 3)]
    rows = list(enumerate(lines))
    got = line_dedup.without_repeated_lines(make(rows), edits=2, least=8).collect()
    expected = plain_line_dedup(rows, 2, 8)
    assert sum(t == "" for _, t in expected) > 30
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(expected, key=str)
