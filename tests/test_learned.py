"""Learnt language model and abbreviations."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__ as contract
from signalweave.catalog.learned import language_model
from signalweave.functions.text import sentence_words, sentences
from signalweave.operators.abbreviations import abbreviation_scores, learn_abbreviations
from signalweave.operators.language_model import UNKNOWN, add_language, learn_languages, trigrams


def test_held_out_languages(spark):
    rows = language_model(spark, "/root/testdata/sf0.01").filter("held_out").collect()
    right = sum(r["lang"] == r["language"] for r in rows)
    assert len(rows) == 200 and right / len(rows) > 0.99


def brute_trigrams(text):
    padded = " " + re.sub(r"[^a-zà-ÿ]+", " ", text.lower()) + " "
    return [g for g in (padded[i : i + 3] for i in range(len(padded) - 2)) if re.fullmatch(r"[^ ].[^ ]|[^ ]{2} | [^ ]{2}", g)]


def test_trigrams(one):
    for text in ("Ab cd, élan", "a", "x y z", "one-two  three\n4 four", "", "abcdef"):
        assert one(text, trigrams("text")) == brute_trigrams(text)


def test_weights_are_smoothed_shares(spark):
    rows = [("aaa bbb", "x"), ("aaa", "x"), ("ccc", "y"), (None, "y"), ("ddd", None)]
    model = learn_languages(spark.createDataFrame(rows, "text STRING, lang STRING"), size=4)
    counts = {"x": Counter(brute_trigrams("aaa bbb") + brute_trigrams("aaa")), "y": Counter(brute_trigrams("ccc"))}
    total = counts["x"] + counts["y"]
    best = sorted(total, key=lambda g: (-total[g], g))[:4]
    sums = {k: sum(c[g] for g in best) for k, c in counts.items()}
    wanted = {g: tuple(round(1000 * math.log((counts[k][g] + 1) / (sums[k] + 4))) for k in ("x", "y")) for g in best}
    assert model.languages == ("x", "y") and dict(model.weights) == wanted


def test_languages_of_awkward_rows(spark):
    rows = [("le la les une avec pour dans", "fr"), ("der die das und nicht mit auf", "de")] * 3
    model = learn_languages(spark.createDataFrame(rows, "text STRING, lang STRING"))
    texts = [(1, "une avec dans les"), (1, "und nicht mit"), (None, "und nicht mit"), (2, None), (3, ""), (4, "12 34 !"), (5, "xyz qqq")]
    docs = spark.createDataFrame(texts, "id INT, text STRING").withColumn("lang", F.lit("?"))
    got = Counter((r["id"], r["language"]) for r in add_language(docs, model).collect())
    assert got == Counter([(1, "fr"), (1, "de"), (None, "de"), (2, UNKNOWN), (3, UNKNOWN), (4, UNKNOWN), (5, UNKNOWN)])
    none = learn_languages(docs.limit(0))
    assert {r["language"] for r in add_language(docs, none).collect()} == {UNKNOWN}
    single = learn_languages(spark.createDataFrame(rows[:1], "text STRING, lang STRING"))
    assert {(r["id"], r["language"]) for r in add_language(docs.filter("id IN (1, 5)"), single).collect()} == {(1, "fr"), (5, UNKNOWN)}


CORPUS = [
    "We met Dr. Smith there. Then Dr. Jones left. A doctor came (see Dr. Brown).",
    "He said z. B. this works. We like it. Dr. Who said z. B. that too!",
    "Is it? Yes. z. B. one. Dr. Two and z. B. three. We like it there. It works there well.",
    "z. B. four and five. Then we left. We met Dr. Six, Dr. Seven and more. It works well. Do we like it there? We do.",
]


def test_abbreviations_are_learnt_and_not_cut(spark, one):
    docs = spark.createDataFrame([(t,) for t in CORPUS] + [(None,), ("",)], "text STRING")
    words = learn_abbreviations(docs)
    assert "dr" in words and "z" in words and "b" in words
    assert not {"there", "it", "left", "well", "works"} & set(words)
    assert one(CORPUS[0], sentences("text", words)) == [
        "We met Dr. Smith there.", "Then Dr. Jones left.", "A doctor came (see Dr. Brown).",
    ]
    assert one("z. B. x. DR. y! (dr. z", sentences("text", words)) == ["z. B. x.", "DR. y!", "(dr. z"]
    assert one("Dr. A. b", sentences("text")) == ["Dr.", "A.", "b"]
    assert one("Dr. A ran. b", sentence_words("text", ["dr"])) == [["Dr", ".", "A", "ran", "."], ["b"]]


def test_scores_follow_the_criterion(spark):
    docs = spark.createDataFrame([(t,) for t in CORPUS], "text STRING")
    tokens = [re.fullmatch(r"""["'(\[]*([^\W\d_]+(?:\.[^\W\d_]+)*)(\.?)["',;:!?)\]]*""", w) for t in CORPUS for w in t.split()]
    seen = [(m[1].lower(), m[2] == ".") for m in tokens if m]
    n, k = Counter(w for w, _ in seen), Counter(w for w, dot in seen if dot)
    p = sum(k.values()) / sum(n.values())
    rows = abbreviation_scores(docs).collect()
    assert {r["word"] for r in rows} == {w for w in n if n[w] >= 5 and k[w]}
    for r in rows:
        w = r["word"]
        free = n[w] - k[w]
        ratio = 2 * (k[w] * math.log(0.99 / p) + free * math.log(0.01 / (1 - p)))
        assert (r["n"], r["k"]) == (n[w], k[w])
        assert abs(r["score"] - ratio * math.exp(-len(w)) * len(w) ** -free) < 1e-6


def test_no_words_no_abbreviations(spark):
    assert learn_abbreviations(spark.createDataFrame([(None,), ("",), ("1 2.",)], "text STRING")) == []


def test_catalog_has_the_queries():
    assert {"language_model", "abbreviations", "learned_sentences", "dictionary_tags", "percolated_queries"} <= set(contract.queries())
