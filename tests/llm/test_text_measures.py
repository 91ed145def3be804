"""Quality rules, token counts and personal data against plain versions of their definitions."""

from __future__ import annotations

import random
import re

import pytest
from tokenizers import Tokenizer

from signalweave.llm import packing, pii, quality_rules, token_counts


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    )


def test_measures_equal_their_definition():
    draw = random.Random(1)
    for _ in range(300):
        parts = ["a", "bé", "#", "c|", " ", "\n", "\x0b", " ", "😀", " a b c d e f g h ", "\nline x\n"]
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 40)))
        got = quality_rules.measure(text.encode())
        assert (got[0], got[1], got[2], got[4], got[5]) == plain_measures(text), text


def test_ledger_defines_every_awkward_row(awkward, empty):
    df, rows = awkward
    entries = quality_rules.ledger(df)
    assert entries.columns == ["doc_id", *[f.split()[0] for f in quality_rules.MEASURES.split(", ")], "failures"]
    got = sorted(((r.doc_id, r.n_words) for r in entries.collect()), key=str)
    assert got == sorted(((i, len((t or "").encode().split())) for i, t in rows), key=str)
    assert quality_rules.ledger(empty).count() == 0


def test_policies_and_ablations_are_bit_arithmetic(make):
    good = "plain words that say something new each time they come along " * 1 + " ".join(f"w{i}" for i in range(30))
    df = make([(1, good), (2, "too short"), (3, "again and again now " * 20), (4, " ".join(f"x{i}#$%" for i in range(30)))])
    entries = quality_rules.ledger(df).cache()
    kept = {p: {r.doc_id for r in quality_rules.apply_policy(entries, p).filter("kept").collect()} for p in quality_rules.POLICIES}
    assert kept == {"base": {1, 4}, "v1": {1}, "v2": {1}}
    rows = {(r.policy, r.rule): (r.documents, r.kept, r.kept_without) for r in quality_rules.ablations(entries).collect()}
    assert rows["v1", "many_symbols"] == (4, 1, 2)
    assert rows["base", "few_words"] == (4, 2, 3)
    assert len(rows) == sum(map(len, quality_rules.POLICIES.values()))


def test_accepted_keeps_all_columns(awkward):
    df, _ = awkward
    left = quality_rules.accepted(df, "base")
    assert left.columns == df.columns
    assert [r.doc_id for r in left.collect()] == []
    assert quality_rules.accepted(df, "v1").schema == df.schema


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(2)
    parts = [
        "a", "word", " ", "  ", "\n", "\t", "'s", "'ll", "é", "12", "!", ",", "<|endoftext|>", "<|ENDOFTEXT|>", "\x1c",
        "́", "日本", "😀", "İ", "Σ", "　", "ﬁ", " and", " the.", ".\n",
    ]
    made = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(4000)]
    return [*made, "", " ", "a" * 3000, " " * 50 + "x", "x" + " " * 50, "Ab" * 500 + ", end."]


def test_token_counts_equal_the_library(texts):
    count = token_counts.MergeCounter(token_counts.vocabulary_path()).count
    library = Tokenizer.from_file(token_counts.vocabulary_path())
    expected = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [count(t) for t in texts] == expected


def test_word_ids_equal_the_library(texts):
    path = token_counts.vocabulary_path(packing.VOCABULARY)
    ids = packing.WordTokens(path).ids
    library = Tokenizer.from_file(path)
    got = [memoryview(ids(t.encode())).cast("I").tolist() for t in texts]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_lookup_stays_bounded():
    class Square(token_counts.Lookup):
        SIZE = 10

        def compute(self, key):
            return len(key)

    seen = Square()
    assert [seen["x" * (i % 37)] for i in range(500)] == [i % 37 for i in range(500)]
    assert len(seen) <= 10 and len(seen._old) <= 10


def test_token_counts_of_awkward_rows(awkward, empty):
    df, rows = awkward
    library = Tokenizer.from_file(token_counts.vocabulary_path())
    expected = [(i, len((t or "").encode()), len(library.encode(t or "").ids)) for i, t in rows]
    got = [(r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(df).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert token_counts.token_counts(empty).count() == 0


def plain_spans(text):
    rules = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = []
    for kind, rule in rules.items():
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]
            if good():
                found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_plain_spans_equal_the_patterns():
    draw = random.Random(3)
    parts = [*"a1.@-+ ()", "12", "255", "256", "4111111111111111", "@b.c", "1.2.3.4", "+1 (", "é", "😀", "000001"]
    for _ in range(20_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        assert pii.all_spans(text)[0] == plain_spans(text), text


@pytest.mark.parametrize(
    ("text", "hidden"),
    [
        ("mail bob at example dot com now", "bob at example dot com"),
        ("mail bob.x [at] mail.example [dot] org.", "bob.x [at] mail.example [dot] org"),
        ("jane dot doe at mail dot example dot com", "jane dot doe at mail dot example dot com"),
        ("x.42 at mail8.example.com.", "x.42 at mail8.example.com"),
        ("so b​ob@exаmple.com", "b​ob@exаmple.com"),
        ("ｂｏｂ＠ｅｘａｍｐｌｅ．ｃｏｍ", "ｂｏｂ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
        ("call plus one five five five one two three four five six seven", "plus one five five five one two three four five six seven"),
        ("+1 (98O) 555-l234 ok", "+1 (98O) 555-l234"),
        ("ip one nine two dot one six eight dot zero dot one ok", "one nine two dot one six eight dot zero dot one"),
        ("drei vier fünf, sechs sieben acht neun null drei zwei", "drei vier fünf, sechs sieben acht neun null drei zwei"),
    ],
)
def test_disguised_spans_map_back_to_the_source(text, hidden):
    base, every = pii.all_spans(text)
    assert hidden in [text[a:b] for _, a, b in every if (_, a, b) not in base]


def test_clean_prose_has_no_disguised_span(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts += ["He met one or two at home, dot by dot.", "We saw three to five at the point.", "See at once. The rest follows."]
    assert [pii.disguised_spans(t) for t in texts if pii.disguised_spans(t)] == []


def test_personal_data_of_awkward_rows(awkward, empty):
    df, rows = awkward
    got = pii.personal_data(df).collect()
    assert len(got) == len(rows)
    none = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert {(r.base_sha256, r.spans) for r in got} == {(none, "")}
    assert pii.personal_data(empty).count() == 0
