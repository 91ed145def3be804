"""Document language by a model of letter trigrams, learnt by aggregation from labelled texts.

The model is a fixed number of trigrams with a weight for each language, the logarithm of its smoothed share there.  A
text belongs to the language whose weights add up highest, or to none if that is not clear.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalweave.functions.matching import as_column
from signalweave.operators.once import explode_once

TRIGRAMS = 2_000
# Weights are thousandths of the natural logarithm.
UNIT = 1000
# The lead over the second language, per trigram, below which a text belongs to none.
MARGIN = 20
MOST_LANGUAGES = 500
UNKNOWN = "NA"


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: tuple[tuple[str, tuple[int, ...]], ...]

    def frame(self, spark: SparkSession) -> DataFrame:
        """`gram` and the weights in the order of the languages; small enough for Spark to broadcast by itself."""
        columns = "".join(f", w{i} BIGINT" for i in range(len(self.languages)))
        return spark.createDataFrame([(gram, *w) for gram, w in self.weights], f"gram STRING{columns}")


def trigrams(text: Column | str) -> Column:
    """All overlapping trigrams of the lowered words, each with a blank before and after it."""
    letters = F.regexp_replace(F.lower(as_column(text)), r"\P{L}+", " ")
    return F.regexp_extract_all(F.concat(F.lit(" "), letters, F.lit(" ")), F.lit("(?s)(?=([^ ].[^ ]|[^ ]{2} | [^ ]{2}))"), F.lit(1))


def learn_languages(labelled: DataFrame, text: str = "text", lang: str = "lang", size: int = TRIGRAMS) -> LanguageModel:
    """The `size` most frequent trigrams, earlier ones in the alphabet first, weighed for each language of the labels.

    Counts are sums over all rows.  Rows without text or language teach nothing.  What reaches the driver is the model.
    """
    rows = labelled.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = explode_once(rows, "gram", trigrams("text")).groupBy("gram", "lang").agg(F.count(F.lit(1)).alias("n"))
    found = rows.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    languages = [r["lang"] for r in found]
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages; is {lang} a label?")
    if not languages:
        return LanguageModel((), ())
    wide = counts.groupBy("gram").pivot("lang", languages).agg(F.sum("n"))
    columns = [F.coalesce(F.col(f"`{name}`"), F.lit(0)).alias(f"n{i}") for i, name in enumerate(languages)]
    wide = wide.select("gram", *columns)
    numbers = [f"n{i}" for i in range(len(languages))]
    total = sum((F.col(c) for c in numbers), F.lit(0))
    best = wide.orderBy(total.desc(), "gram").limit(size)
    # A window over the rows of the model, whose number is fixed.
    every = Window.partitionBy(F.lit(0))
    share = [(F.col(c) + 1) / (F.sum(c).over(every) + F.lit(size)) for c in numbers]
    weighed = best.select("gram", *[F.round(F.log(s) * UNIT).cast("bigint").alias(f"w{i}") for i, s in enumerate(share)])
    return LanguageModel(tuple(languages), tuple((r[0], tuple(r[1:])) for r in weighed.orderBy("gram").collect()))


def add_language(
    docs: DataFrame, model: LanguageModel, text: str = "text", column: str = "language", margin: int = MARGIN
) -> DataFrame:
    """Add the language of the text: `NA` for a NULL text, one without a known trigram, or one that is not clear.

    Texts are told apart by a hash, so that copies are scored together: this multiplies all their sums alike.
    """
    if not model.languages:
        return docs.withColumn(column, F.lit(UNKNOWN))
    own = docs[text]
    rows = docs.select(F.xxhash64(own).alias("_t"), own.alias("_text"))
    each = explode_once(rows, "gram", trigrams("_text")).select("_t", "gram")
    names = [f"w{i}" for i in range(len(model.languages))]
    scored = each.join(model.frame(docs.sparkSession), "gram").groupBy("_t").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in names]
    )
    ranks = F.array(*[F.struct(F.col(c).alias("s"), F.lit(-i).alias("i")) for i, c in enumerate(names)])
    order = F.reverse(F.array_sort(ranks))
    best, second = F.get(order, F.lit(0)), F.get(order, F.lit(1))
    clear = F.coalesce(best["s"] - second["s"] >= F.col("_n") * margin, F.lit(True))
    label = F.get(F.array(*map(F.lit, model.languages)), -best["i"])
    answer = scored.select("_t", F.when(clear, label).otherwise(F.lit(UNKNOWN)).alias("_language"))
    joined = docs.withColumn("_t", F.xxhash64(own)).join(answer, "_t", "left")
    return joined.withColumn(column, F.coalesce("_language", F.lit(UNKNOWN))).drop("_t", "_language")
