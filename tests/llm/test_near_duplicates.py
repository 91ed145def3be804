"""SimHash, line dedup, passage removal and decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from signalweave.llm import components, decontaminate, line_dedup, simhash, suffix_dedup


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, linked):
    """Smallest id reachable from each index."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in linked:
        root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        r = find(i)
        least[r] = min((v for v in (least.get(r), x) if v is not None), default=None)
    return [least[find(i)] for i in range(len(ids))]


def test_fingerprints_equal_their_definition(awkward):
    df, rows = awkward
    got = [(r.doc_id, r.fp % (1 << 64)) for r in simhash.fingerprints(df).collect()]
    assert sorted(got, key=str) == sorted([(i, plain_fingerprint(t or "")) for i, t in rows], key=str)


def test_components_equal_brute_force(make, empty):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randint(0, 12))) for _ in range(60)]
    for t in list(texts):
        for _ in range(draw.randint(0, 3)):
            parts = (t + " ").split(" ") * 8
            parts[draw.randrange(len(parts))] = "changed"
            texts.append(" ".join(parts))
    texts += [None, "", "   ", texts[0]]
    ids = [None if i == 7 else 500 - i for i in range(len(texts))]
    fps = [plain_fingerprint(t or "") for t in texts]
    linked = [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 4]
    assert len(linked) > 20
    expected = groups(ids, linked)
    got = simhash.near_duplicates(make(zip(ids, texts))).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted(zip(ids, expected), key=str)
    assert simhash.near_duplicates(empty).count() == 0


def test_links_of_dense_clusters_and_small_parts(spark, monkeypatch):
    """Fingerprints around a few centres; parts and memory so small that every split is taken."""
    draw = random.Random(5)
    fps = set()
    for _ in range(4):
        centre = draw.getrandbits(64)
        for _ in range(60):
            fps.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 6))))
    fps = sorted(fps)
    linked = [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 4]
    expected = groups(fps, linked)
    monkeypatch.setattr(simhash, "VARIANTS_AT_ONCE", 3000)
    signed = [f - (1 << 64) * (f >> 63) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(df, 1, rows_at_once=40).collect()
    place = {f: i for i, f in enumerate(signed)}
    got = groups(fps, [(place[e.a], place[e.b]) for e in edges])
    assert got == expected
    assert all(bin((e.a ^ e.b) % (1 << 64)).count("1") <= 64 for e in edges)
    with pytest.raises(ValueError):
        simhash.links(df, 1, max_bits=3)


def test_keep_one_of_each_group(awkward):
    df, _ = awkward
    left = simhash.keep_one(df)
    assert left.columns == df.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([1, 2, None, 5, 6])


def test_connected_components(spark):
    draw = random.Random(6)
    pairs = [(draw.randrange(200), draw.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    expected = groups(list(range(400)), pairs)
    touched = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {i: expected[i] for i in touched}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def edited(draw, text, edits, letters="abé😀"):
    out = list(text)
    for _ in range(edits):
        at, kind = draw.randint(0, len(out)), draw.randint(0, 2)
        if kind == 0:
            out.insert(at, draw.choice(letters))
        elif out and kind == 1:
            out.pop(min(at, len(out) - 1))
        elif out:
            out[min(at, len(out) - 1)] = draw.choice(letters)
    return "".join(out)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance_and_segments(spark, edits):
    draw = random.Random(edits)
    rows = []
    while len(rows) < 300:
        a = "".join(draw.choice("abé😀") for _ in range(draw.randint(edits + 1, 14)))
        b = edited(draw, a, draw.randint(0, edits + 2))
        if len(b) > edits and abs(len(a) - len(b)) <= edits:
            rows.append((a, b, distance(a, b)))
    df = spark.createDataFrame(rows, "a string, b string, d int")
    for r in line_dedup.edit_distances(df, "a", "b", edits).collect():
        assert r.edits_apart == r.d if r.d <= edits else r.edits_apart > edits, r
    long, short = F.expr("if(char_length(a) >= char_length(b), a, b)"), F.expr("if(char_length(a) >= char_length(b), b, a)")

    def meeting(index, probe):
        """The keys meet, and what must differ where both say so does."""
        a, b = index(short, F.char_length(short), edits), probe(long, F.char_length(long), edits)
        return F.exists(a, lambda x: F.exists(b, lambda y: (x.key == y.key) & (x.x.isNull() | ((x.x != y.x) & (x.y != y.y)))))

    near = df.filter((F.col("d") <= edits) & (F.col("a") != F.col("b")))

    def keys(line, kind):
        found = line_dedup.segment_keys(near.select(F.xxhash64("a", "b").alias("h"), line.alias("line"), F.char_length(line).alias("size")), edits)
        return found.filter(kind).select("h", "key").distinct()

    filed, asked = keys(short, F.col("kind") == line_dedup.INDEX), keys(long, F.lit(True))
    assert filed.join(asked, ["h", "key"]).select("h").distinct().count() == near.select("a", "b").distinct().count()
    named = near.withColumnsRenamed({"a": "a_line", "b": "b_line"})
    assert line_dedup._likely(named, edits).count() == near.count()
    # Finer keys need segments of a character at least to say anything; they hold for all lengths.
    finer = meeting(line_dedup.finer_index_keys, line_dedup.finer_probe_keys)
    assert near.filter(~finer).count() == 0


def plain_line_dedup(rows, edits, least):
    last = line_dedup.LAST_ID
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(line) >= least:
                first[line] = min(first.get(line, last), last if i is None else i)
    order = sorted(first, key=lambda x: (first[x], x.encode()))
    near = {
        b for n, b in enumerate(order) if any(abs(len(a) - len(b)) <= edits and distance(a, b) <= edits for a in order[:n])
    }
    out = []
    for i, t in rows:
        seen, left = set(), []
        for line in (t or "").split("\n"):
            here = last if i is None else i
            if len(line) >= least and (line in seen or first[line] < here or line in near):
                continue
            seen.add(line)
            left.append(line)
        out.append((i, None if t is None else "\n".join(left)))
    return out


@pytest.mark.parametrize("crowded", [16, 0])
def test_line_dedup_equals_brute_force(make, empty, crowded, monkeypatch):
    monkeypatch.setattr(line_dedup, "CROWDED", crowded)
    draw = random.Random(8)
    base = ["".join(draw.choice("abcdé ") for _ in range(draw.randint(6, 30))) for _ in range(40)]
    rows = []
    for i in range(80):
        lines = []
        for _ in range(draw.randint(0, 6)):
            line = draw.choice(base)
            lines.append(edited(draw, line, draw.choice([0, 0, 1, 2, 3]), "xyé"))
        rows.append((None if i % 17 == 3 else i // 2, "\n".join(lines)))
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, rows[5][1]), (203, rows[5][1]), (204, "the only line of this text" * 2000)]
    got = line_dedup.without_repeated_lines(make(rows), edits=2, least=8, counts=("lines", "removed", "near"))
    expected = plain_line_dedup(rows, 2, 8)
    result = got.collect()
    assert sorted(((r.doc_id, r.text) for r in result), key=str) == sorted(expected, key=str)
    kept = {(r.doc_id, r.text): (r.lines, r.removed) for r in result}
    assert kept[200, None] == (0, 0) and kept[202, "\n\n"] == (3, 0)
    assert sum(r.removed for r in result) > 50
    left = line_dedup.without_repeated_lines(empty)
    assert left.columns == empty.columns and left.count() == 0
    with pytest.raises(ValueError):
        line_dedup.dropped_lines(make(rows), edits=5, least=5)


def test_a_frequent_line_takes_part_once(make, monkeypatch):
    monkeypatch.setattr(line_dedup, "FREQUENT", 4)
    common = "a line that stands in every one of the texts"
    rows = [(i, f"{common}\nand a line of its own, number {i:03d}xx{i * 7:05d}") for i in range(30)]
    rows.append((40, common.replace("every", "evary")))
    got = line_dedup.without_repeated_lines(make(rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(plain_line_dedup(rows, 2, 30), key=str)


def plain_passages(texts, length):
    strings = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if strings[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        left = bytes(x for x, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.fixture(scope="module")
def passages():
    draw = random.Random(9)
    words = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(2, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(draw.choice(words) for _ in range(n))

    base, texts = [prose(80) for _ in range(10)], []
    for _ in range(70):
        kind = draw.random()
        if kind < 0.1:
            texts.append(draw.choice(base))
        elif kind < 0.6:
            text = list(draw.choice(base))
            for _ in range(draw.randint(0, 5)):
                text[draw.randrange(len(text))] = "z"
            texts.append(prose(draw.randint(0, 30)) + "".join(text) + prose(draw.randint(0, 20)))
        elif kind < 0.8:
            texts.append(draw.choice(["a", "ab "]) * draw.randint(0, 300))
        else:
            texts.append(prose(draw.randint(0, 100)))
    return [*texts, "", texts[3], texts[3], None]


@pytest.mark.parametrize(("length", "seed"), [(200, 40), (48, 16), (8, 8)])
def test_passages_equal_brute_force(make, passages, length, seed, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 300)
    df = make([(None if i % 9 == 0 else i // 2, t) for i, t in enumerate(passages)])
    got = suffix_dedup.without_repeats(df, length, seed).select(
        "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("removed"), F.size("spans") / 2, F.sha2("kept", 256)
    )
    expected = plain_passages([(t or "").encode() for t in passages], length)
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_passages_of_awkward_rows(awkward, empty):
    df, rows = awkward
    got = suffix_dedup.without_repeats(df)
    expected = plain_passages([(t or "").encode() for _, t in rows], 200)
    spans = got.select("n_bytes", (F.col("n_bytes") - F.length("kept")).alias("r"), F.size("spans") / 2, F.sha2("kept", 256))
    assert sorted(map(tuple, spans.collect())) == sorted(expected)
    assert suffix_dedup.without_repeats(empty).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.repeated_spans(df, 200, 41)


def plain_containment(docs, items):
    def shingles(words, k):
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}

    out = []
    for i, t in docs:
        words = decontaminate.words_of((t or "").encode())
        for item, u in items:
            own = decontaminate.words_of((u or "").encode())
            k = min(5, len(own))
            if k and k <= len(words):
                wanted = shingles(own, k)
                shared = len(wanted & shingles(words, k))
                if shared >= np.ceil(len(wanted) * 0.8 - 1e-9):
                    out.append((i, item, shared, len(wanted)))
    return out


def test_containment_equals_brute_force(spark, make, empty, clashing, monkeypatch):
    monkeypatch.setattr(decontaminate, "FILTER_BITS", 10)  # a full filter must change nothing
    draw = random.Random(11)
    words = [f"w{i}" for i in range(60)]

    def prose(n):
        return " ".join(draw.choice(words) for _ in range(n))

    items = [(i, prose(draw.randint(1, 30))) for i in range(30)] + [(30, None), (31, ""), (32, "!!"), (5, "w1 w2"), (None, "W3, w4")]
    docs = []
    for i in range(60):
        inside = draw.choice(items)[1] or ""
        parts = inside.split()
        for _ in range(draw.randint(0, 2)):
            if parts:
                parts[draw.randrange(len(parts))] = "other"
        docs.append((i // 2, prose(draw.randint(0, 200)) + " " + ", ".join(parts).upper() + ".\n" + prose(20)))
    docs += [(100, None), (101, ""), (None, docs[0][1]), (0, docs[0][1])]
    frame = clashing(spark.createDataFrame(items, "item_id long, text string"))
    got = decontaminate.contained_items(make(docs), frame)
    rows = [(r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in got.collect()]
    expected = plain_containment(docs, items)
    assert len(expected) > 40
    assert Counter(rows) == Counter(expected)
    dirty = {i for i, *_ in expected}
    left = decontaminate.without_contaminated(make(docs), frame)
    assert Counter(r.doc_id for r in left.collect()) == Counter(i for i, _ in docs if i not in dirty)
    none = frame.limit(0)
    assert decontaminate.contained_items(make(docs), none).count() == 0
    assert decontaminate.contained_items(empty, frame).count() == 0


@pytest.mark.parametrize("common", [None, 0, 2, 16])
def test_sketches_of_any_order_lose_no_item(make, spark, common):
    """Also where a phrase stands in all items and documents, which then must not make candidates of all pairs."""
    draw = random.Random(12)
    words = [f"w{i}" for i in range(3000)]

    def prose(n):
        return [draw.choice(words) for _ in range(n)]

    phrase = "which of the following answers is the right one here".split()
    items = [(i, " ".join(phrase + prose(draw.randint(10, 40)))) for i in range(40)]
    docs = [(i, " ".join(prose(50) + phrase + (items[i][1].split() if i < 40 else []) + prose(50))) for i in range(80)]
    own = decontaminate.item_shingles(spark.createDataFrame(items, "item_id long, text string"))
    hits = decontaminate.document_shingles(make(docs), decontaminate.shingle_filter(own), [5])
    sketch = decontaminate.sketches(own, common=common)
    found = decontaminate.candidates(hits, sketch)
    ids = hits.select("row", "doc_id").distinct().join(found, "row").join(own.selectExpr("row AS item_row", "item_id").distinct(), "item_row")
    pairs = {(r.doc_id, r.item_id) for r in ids.collect()}
    assert pairs >= {(i, i) for i in range(40)}
    if common == 16:
        assert len(pairs) == 40
