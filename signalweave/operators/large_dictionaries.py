"""Dictionaries and stored queries that are tables of any size.

`tagging.tag_countries` and the like write a dictionary into the plan as literal patterns, which suits
sheets of hundreds of entries.  Here entries stay rows.  Every alias is filed under one of its grams, a
word or two adjacent words: the one that is rarest in the texts.  Texts meet aliases by a join on
grams; what a gram does not say by itself is verified by the alias's pattern, so that the cost follows the
texts and what occurs in them, not the number of entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalweave.functions.matching import as_column, no_strings
from signalweave.functions.patterns import ANY_CASE, EXACT_CASE, PLURAL
from signalweave.operators.once import computed_once, explode_once
from signalweave.session import cut_lineage, shared_folder

WORD = r"(?U)[a-z0-9_\w]++"
# At the start of every word but the last: the word, what parts it from the next one, and that one.
PAIR = r"(?U)\b(?=([a-z0-9_\w]++\W++[a-z0-9_\w]++))[a-z0-9_\w]++"
# Texts, at most, that the rarity of grams is estimated from; it decides what is fast, never what is found.
RARITY_ROWS = 50_000
# What upper case writes as several letters of A to Z.
SEVERAL = "ẞßﬀﬁﬂﬃﬄﬅﬆ"
CASELESS = "ƻ"


def folded(text: Column) -> Column:
    """A text in a form that is equal wherever a search in any case takes letters for equal.

    Letters go to upper and then to lower case, since some have no lower-case form of their own.  What would become several
    letters of a to z, which no search takes for equal, becomes a letter without case; so words of a to z are equal in this form only
    where a search finds them.  The replacement between the two keeps Spark from taking one of them for superfluous.
    """
    plain = F.replace(text, F.lit("İ"), F.lit("i"))
    for letter in SEVERAL:
        plain = F.replace(plain, F.lit(letter), F.lit(CASELESS))
    lowered = F.lower(F.replace(F.upper(plain), F.lit("ẞ"), F.lit(CASELESS)))
    one_byte_each = F.octet_length(text) == F.char_length(text)
    return F.when(one_byte_each, F.lower(text)).otherwise(F.replace(lowered, F.lit("ς"), F.lit("σ")))


def _words(form: Column) -> Column:
    return F.regexp_extract_all(form, F.lit(WORD), F.lit(0))


def _pairs(form: Column) -> Column:
    """Adjacent words as one gram each, with what parts them, which a search takes literally."""
    return F.regexp_extract_all(form, F.lit(PAIR), F.lit(1))


NO_WORD = ""


def text_grams(df: DataFrame, text: Column | str, *kept: Column | str) -> DataFrame:
    """`kept` and `gram`: a row for each distinct word and pair of adjacent words of a text, and one that stands for no word.

    Tokens are cut once for each text, and below any step that Spark would move before a shuffle that spreads the texts.
    """
    cut = computed_once(df.select(*kept, F.coalesce(as_column(text), F.lit("")).alias("_cut")), _form=folded(F.col("_cut")))
    grams = F.concat(F.array(F.lit(NO_WORD)), _words(F.col("_form")), _pairs(F.col("_form")))
    return explode_once(cut.drop("_cut"), "gram", F.array_distinct(grams)).drop("_form")


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    """Rows written once and read back, so that Spark knows how many bytes they have before it plans a join with them."""
    target = shared_folder(df.sparkSession, purpose)
    df.write.parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def _escaped(alias: Column) -> Column:
    return F.regexp_replace(alias, r"([^\w\s])", r"\\$1")


def _aliases(dictionary: DataFrame, suffixes: tuple[str, ...]) -> DataFrame:
    """`name`, `pattern`, `cased`, `literal` and `choices`: the grams of each alias, any of which may be its key.

    A choice is an array, since the last word of an alias may have a suffix in the text.  The pattern is NULL where the only
    choice says all: one word, or two with a blank between, of a to z in any case.  `literal` is what the text, or its folded form, must contain.
    """
    cased = F.coalesce(F.col("cased"), F.lit(False)) if "cased" in dictionary.columns else F.lit(False)
    rows = dictionary.select(dictionary["name"].alias("name"), dictionary["alias"].alias("alias"), cased.alias("cased"))
    rows = rows.filter(F.col("alias").isNotNull() & F.col("alias").rlike(r"\S")).distinct()
    ending = f"(?:{'|'.join(suffixes)})?" if suffixes else ""
    flags = F.when(F.col("cased"), EXACT_CASE).otherwise(ANY_CASE)
    pattern = F.concat(flags, F.lit(r"\b"), _escaped(F.col("alias")), F.lit(ending + r"\b"))
    sure = ~F.col("cased") & F.col("name").isNotNull() & F.col("alias").rlike(r"\A[A-Za-z0-9_]+(?: [A-Za-z0-9_]+)?\z")
    # A word that ends the alias may go on with a suffix; one before a sign is whole in the text too.
    open_end = F.col("alias").rlike(r"(?U)\w\z")
    rows = computed_once(rows, pattern=F.when(~sure, pattern), form=folded(F.col("alias")), open=open_end)
    rows = computed_once(rows, words=_words(F.col("form")), pairs=_pairs(F.col("form")))
    last = F.element_at("words", -1)
    forms = F.when(
        F.col("open") & (F.size("words") > 0), F.array(last, *[F.concat(last, F.lit(s)) for s in suffixes])
    ).otherwise(F.when(F.size("words") > 0, F.array(last)).otherwise(no_strings()))
    inner = F.transform(F.slice("pairs", 1, F.greatest(F.size("words") - 2, F.lit(0))), lambda p: F.array(p))
    # The last pair with each form of its last word.
    ahead = F.element_at("pairs", F.greatest(F.size("words") - 1, F.lit(1)))
    final = F.transform(forms, lambda w: F.concat(ahead, F.substr(w, F.length(last) + 1)))
    choices = (
        F.when(F.size("words") == 0, F.array(F.array(F.lit(NO_WORD))))
        .when(F.size("words") == 1, F.array(forms))
        .otherwise(F.concat(inner, F.array(final)))
    )
    literal = F.when(F.col("cased"), F.col("alias")).otherwise(F.col("form"))
    return rows.select("name", "pattern", "cased", literal.alias("literal"), choices.alias("choices"))


def _keyed(aliases: DataFrame, posts: DataFrame, text: Column) -> DataFrame:
    """`gram`, `name`, `pattern`, `cased`, `literal`: each alias under the choice that the fewest of some texts have."""
    # The choices of an alias are told apart from those of others by all that is known of it, `choices` too: a pattern may be NULL.
    alias = ["name", "pattern", "cased", "literal", "choices"]
    aliases = _stored(aliases, "aliases")
    total = posts.count()
    some = posts if total <= RARITY_ROWS else posts.sample(RARITY_ROWS / total, seed=1)
    several = aliases.filter(F.size("choices") > 1).select(F.explode(F.flatten("choices")).alias("gram")).distinct()
    counts = text_grams(some, text).join(several, "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    each = aliases.select(*alias, F.posexplode("choices").alias("choice", "grams"))
    rated = each.select("*", F.explode("grams").alias("gram")).join(counts, "gram", "left")
    summed = rated.groupBy(*alias, "choice").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"), F.first("grams").alias("grams"))
    best = summed.groupBy(*alias).agg(F.min(F.struct("n", "choice", "grams")).alias("best"))
    return _stored(best.select(*alias[:-1], F.explode("best.grams").alias("gram")), "keyed")


def tag_by_dictionary(
    posts: DataFrame,
    dictionary: DataFrame,
    text: str = "text",
    column: str = "tags",
    plural: bool = True,
) -> DataFrame:
    """Add the sorted ARRAY of all names with an alias in the text, as `functions.matching.group_tags` finds them.

    `dictionary` has `name`, `alias` and, if letter case counts for some, `cased`.  Names and aliases may
    repeat; NULL and blank aliases match nothing, nor does any alias match a NULL text.  Texts are told apart
    by their SHA-256.  An alias of one or two plain words in any case is found by its gram alone; others are verified.
    """
    if {"_t", "_form", "_sure", "_found"} & set(posts.columns):
        raise ValueError("the columns _t, _form, _sure and _found are used inside")
    suffixes = PLURAL if plural else ()
    own = posts[text]
    digest = F.unhex(F.sha2(own, 256))
    keyed = _keyed(_aliases(dictionary, suffixes), posts, own)
    grams = text_grams(posts.filter(own.isNotNull()), own, digest.alias("_t"))
    verify = F.col("pattern").isNotNull()
    # Copies of a text give one row per candidate and task before they travel.
    candidates = grams.join(keyed, "gram").groupBy("_t").agg(
        F.collect_set(F.when(~verify, F.col("name"))).alias("_sure"),
        F.collect_set(F.when(verify, F.struct("name", "pattern", "cased", "literal"))).alias("_found"),
    )
    joined = posts.withColumn("_t", digest).join(candidates, "_t", "left")
    any_case = F.exists("_found", lambda c: ~c["cased"])
    joined = joined.withColumn("_form", F.explode(F.array(F.when(any_case, folded(own)))))

    def met(c: Column) -> Column:
        return F.contains(F.when(c["cased"], own).otherwise(F.col("_form")), c["literal"]) & F.rlike(own, c["pattern"])

    open_ = F.filter("_found", lambda c: ~F.coalesce(F.array_contains("_sure", c["name"]), F.lit(False)))
    names = F.array_distinct(F.concat("_sure", F.transform(F.filter(open_, met), lambda c: c["name"])))
    # By a generator, so that a caller's filter on the names does not search a second time.
    found = F.explode(F.array(F.coalesce(F.array_sort(names), no_strings())))
    return joined.withColumn(column, found).drop("_t", "_form", "_sure", "_found")


def percolate(posts: DataFrame, queries: DataFrame, key: str, text: str = "text") -> DataFrame:
    """`key` and `query_id` of every post and every stored query that it meets.

    `queries` has `query_id`, `clauses` ARRAY<ARRAY<STRING>> and `excluded` ARRAY<STRING>.  A query is met if each of
    its clauses has a phrase that occurs (whole words, any case) and no excluded phrase does; one without
    clauses is met by nothing, and a NULL phrase never occurs.  The phrases of all queries are found as one dictionary.  A query
    then waits under the phrases of its rarest clause, so that a post is tested against queries of
    which it has such a phrase and never against the others.
    """
    listed = queries.select("query_id", F.col("clauses").alias("clauses"), F.coalesce("excluded", no_strings()).alias("excluded"))
    listed = listed.filter(F.size("clauses") > 0)
    phrases = F.explode(F.concat(F.flatten("clauses"), F.col("excluded")))
    dictionary = listed.select(phrases.alias("alias")).distinct().withColumn("name", F.col("alias"))
    source = posts.select(posts[key].alias("_key"), posts[text].alias("_text"))
    tagged = tag_by_dictionary(source, dictionary, "_text", "_has", plural=False)
    found = cut_lineage(tagged.filter(F.size("_has") > 0).select("_key", "_has"))
    each = found.select("*", F.explode("_has").alias("phrase"))
    counts = each.groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
    clause = listed.select("query_id", "clauses", "excluded", F.posexplode("clauses").alias("place", "clause"))
    rated = clause.select("*", F.explode("clause").alias("phrase")).join(counts, "phrase", "left")
    rated = rated.groupBy("query_id", "clauses", "excluded", "place", "clause").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    rarest = rated.groupBy("query_id", "clauses", "excluded").agg(F.min(F.struct("n", "place", "clause")).alias("best"))
    # A clause that no post meets leaves its query out here.
    waiting = rarest.filter("best.n > 0").select("query_id", "clauses", "excluded", F.array_distinct("best.clause").alias("best"))
    waiting = _stored(waiting.select("*", F.explode("best").alias("phrase")), "waiting")

    def occurs(list_: Column) -> Column:
        return F.coalesce(F.arrays_overlap(F.array_compact(list_), F.col("_has")), F.lit(False))

    # The first phrase of the clause that the post has answers for it, so that each pair comes once.
    once = F.element_at(F.array_intersect("best", "_has"), 1) == F.col("phrase")
    met = each.join(waiting, "phrase").filter(once & F.forall("clauses", occurs) & ~occurs(F.col("excluded")))
    return met.select(F.col("_key").alias(key), "query_id")
