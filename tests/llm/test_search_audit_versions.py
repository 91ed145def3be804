"""Ranked search, filter audit and version sketches against SQL and brute force."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from itertools import permutations

import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as contract
from signalweave.llm import filter_audit, lexical_search, version_sketch
from tests.compare import differences, oracle

FOLDER = contract.SMALL
BLANKS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("module, query", [(filter_audit, "filter_audit_query"), (lexical_search, "search_query")])
def test_query_equals_sql(spark, module, query):
    assert differences(getattr(module, query)(spark, FOLDER), oracle(FOLDER), module.ORACLE) == []


# Ranked search


def brute_search(docs, items, top=10):
    def terms(text):
        return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))

    known = [(i, Counter(terms(t))) for i, t in docs]
    known = [(i, c, sum(c.values())) for i, c in known if c]
    n_docs, total = len(known), sum(n for _, _, n in known)
    df = Counter(t for _, c, _ in known for t in c)
    found = []
    for item, text in items:
        sums = []
        for i, c, n in known:
            m = 100 - 90 + 90 * n * n_docs // total
            score = 0
            for t in set(terms(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                sums.append((-score, math.inf if i is None else i))
        for rank, (score, i) in enumerate(sorted(sums)[:top], 1):
            found.append((str(item), rank, None if i == math.inf else i, -score))
    return sorted(found, key=str)


def searched(df):
    return sorted(((str(r["item_id"]), r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


AWKWARD_ITEMS = [
    (7, "second line of the TEXT"), (7, "eight nine ten é😀"), (None, "without an id, word word"), (8, None), (9, ""),
    (10, "never seen"), (11, "second line of the text"),
]


@pytest.mark.parametrize("owners, bits, bundle, block", [(4, 14, 256, 200_000), (3, 1, 2, 1), (1, 2, 1, 8)])
def test_search_of_awkward_rows(make, clashing, spark, awkward, monkeypatch, owners, bits, bundle, block):
    monkeypatch.setattr(lexical_search, "SLICE_BITS", bits)
    monkeypatch.setattr(lexical_search, "BUNDLE", bundle)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)
    docs, rows = awkward
    items = clashing(spark.createDataFrame(AWKWARD_ITEMS, "item_id long, text string"))
    got = lexical_search.ranked_search(docs, items, top=3, owners=owners)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert searched(got) == brute_search(rows, AWKWARD_ITEMS, 3)


def test_search_settles_ties_among_very_many_copies(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "SLICE_BITS", 5)
    rows = [(1000 - i, "a rare passage stands here") for i in range(300)]
    rows += [(2000 + i, f"other text {i} here with common words") for i in range(600)]
    items = [(1, "a rare passage here"), (2, "other text 17 rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lexical_search.ranked_search(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert searched(got) == brute_search(rows, items)
    assert [d for i, _, d, _ in sorted(searched(got), key=lambda x: x[1]) if i == "1"] == list(range(701, 711))


def test_search_of_empty_tables(spark, empty, make):
    items = spark.createDataFrame(AWKWARD_ITEMS, "item_id long, text string")
    assert lexical_search.ranked_search(empty, items).count() == 0
    assert lexical_search.ranked_search(make([(1, "some text")]), items.limit(0)).count() == 0
    assert lexical_search.ranked_search(make([(1, None), (2, "")]), items).count() == 0


def test_terms_are_those_of_the_pattern():
    text = "".join(map(chr, range(1, 300))) + " Straße ÉTÉ _x_ a-b 😀 \x7f0"
    pattern = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    assert [t.decode() for t in lexical_search.terms_of(text.encode())] == pattern.findall(lowered)


# Filter audit


def brute_audit(rows, labels):
    def words(t):
        return BLANKS.findall(t)

    known = {}
    for i, quality, toxic in labels:
        good, bad = known.get(i, (False, False))
        known[i] = (good or quality == 1, bad or toxic == 1)
    order = {None: math.inf}
    fails = []
    for i, text, source in rows:
        t, w = text or "", words(text or "")
        own = order.get(i, i)
        fails.append((source or "", known.get(i, (False, False)) if i is not None else (False, False), {
            f for f, x in zip("ABCDE", (
                len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                bool(re.search("[#$%&*|]", t)), any((o or "") == t and order.get(j, j) < own for j, o, _ in rows),
            )) if x
        }))
    out = {}
    for part in {p for p, _, _ in fails}:
        here = [(k, f) for p, k, f in fails if p == part]
        share = Counter()
        for o in permutations("ABCDE"):
            for step, x in enumerate(o, 1):
                before = set(o[: step - 1])
                removed = [k for k, f in here if x in f and not f & before]
                share[x] += len(removed)
                out[part, "".join(o), step] = [
                    sum(not f & (before | {x}) for _, f in here), len(removed),
                    sum(x in f and bool(f & before) for _, f in here), sum(f == {x} for _, f in here),
                    sum(g for g, _ in removed), sum(t for _, t in removed),
                ]
        for (p, o, step), values in out.items():
            if p == part:
                values.append(share[o[step - 1]])
    return out


def test_audit_of_awkward_rows_equals_all_orders(spark, make, awkward):
    base = [(i, t, s) for (i, t), s in zip(awkward[1], ["a", "b", None, "a", "", "b", "a", "a", "b"])]
    varied = " ".join(f"w{i}" for i in range(250))
    base += [(20, varied, "a"), (21, varied, "b"), (None, varied, "b"), (None, varied, "b"), (22, varied + " 5%", "a")]
    base += [(23, "LOUD " * 250, "a"), (24, varied + " " + "X" * 60, "b"), (20, varied, "a")]
    labels = [(20, 1, 0), (21, 1, 1), (21, 0, 0), (22, None, 1), (2, 1, None), (None, 1, 1), (24, 1, 0)]
    docs = make(base, "doc_id long, text string, source string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in filter_audit.audit(filter_audit.failures(docs, known)).collect()}
    assert got == brute_audit(base, labels)


def test_audit_of_an_empty_table(spark, make):
    docs = make([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.failures(docs, labels)).count() == 0


@pytest.mark.parametrize("n", [1, 3, 5])
def test_every_edge_lies_on_its_share_of_the_orders(n):
    passed = Counter((before, f) for _, _, before, f in filter_audit.steps("ABCDE"[:n]))
    assert {(s, f): w for s, f, w in filter_audit.lattice(n)} == passed
    forward, backward = filter_audit.path_counts(n)
    assert forward[-1] == backward[0] == math.factorial(n)


# Version sketches


def pieces(text):
    return {m.strip(" ") for m in re.findall(r"(?:[^\s.!?]+[^\S\n]*){1,8}", text, re.A)}


def brute_versions(rows):
    def key(row):
        i, t = row
        h = xxhash.xxh64_intdigest((t or "").encode(), seed=42)
        return (1 << 63) - 1 if i is None else i, h - (1 << 64) if h >> 63 else h

    rows = sorted(rows, key=key)
    found = []
    for (i, a), (_, b) in zip(rows, rows[1:] + rows[:1]):
        a, b = a or "", b or ""
        half = len(a) // 2
        new = a[: len(a) - half] + b[:half]

        def near(x, y):
            x, y = pieces(x), pieces(y)
            return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0

        found.append((i, len(a), hashlib.sha256(new.encode()).hexdigest(), round(near(a, new), 9), round(near(a, b), 9)))
    return sorted(found, key=str)


def versions(df):
    rows = version_sketch.version_likeness(df).collect()
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in rows]
    return sorted(got, key=str), rows


@pytest.mark.parametrize("ranged", [1000, 2])
def test_versions_of_awkward_rows(make, awkward, monkeypatch, ranged):
    monkeypatch.setattr(version_sketch, "RANGE_ROWS", ranged)
    docs, rows = awkward
    extra = [(10, "Same text here. It has two parts."), (11, "Same text here. It has two parts."), (12, "Same text here. Not more")]
    got, full = versions(docs.unionByName(make(extra)))
    assert got == brute_versions(rows + extra)
    prints = {r["doc_id"]: r["fingerprint"] for r in full if r["doc_id"] in (10, 11, 12)}
    assert prints[10] == prints[11] != prints[12]


def test_versions_of_many_equal_rows_lie_in_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(version_sketch, "RANGE_ROWS", 5)
    monkeypatch.setattr(version_sketch, "DRAWN", 4)
    rows = [(5, "the same row. again and again")] * 60 + [(i, f"row {i}. of its own {i * i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got, _ = versions(docs)
    assert got == brute_versions(rows)
    ranges = version_sketch.with_next(docs).filter("guest = 0 AND text = 'the same row. again and again'").select("range")
    assert ranges.distinct().count() > 2


def test_versions_of_few_or_no_rows(make):
    assert versions(make([]))[0] == []
    assert versions(make([(3, "alone. by itself")]))[0] == brute_versions([(3, "alone. by itself")])
    assert versions(make([(3, None)]))[0] == brute_versions([(3, None)])


def test_a_stuck_pair_is_peeled_from_a_larger_sketch_and_shows_its_digests(spark):
    sign = F.when(F.col("id") < 150, 1).otherwise(-1).cast("long")
    apart = spark.range(400).select(F.lit(1).alias("pair"), F.xxhash64("id").alias("key"), sign.alias("sign"))
    shared = apart.withColumn("key", F.xxhash64(F.lit("both"), "key"))
    units = apart
    for x in (1, -1):
        units = units.union(shared.withColumn("sign", F.lit(x).cast("long")))
    assert version_sketch.differences(units, ["pair"], 0).first()["stuck"] > 0
    large = version_sketch.differences(units, ["pair"], 1).first()
    assert (large["here"], large["there"], large["stuck"]) == (150, 250, 0)
    digests = version_sketch.recovered(units, ["pair"], 1).select("key", "n")
    wanted = spark.range(400).select(F.xxhash64("id").alias("key"), sign.alias("n"))
    assert digests.exceptAll(wanted).count() == 0 and digests.count() == 400
