"""Documents: paragraphs, keyword in context, language and metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalweave.functions.matching import as_column, contains_match, find_all
from signalweave.functions.patterns import INFLECTED, cooccurrence_pattern, inflected_pattern, word_pattern
from signalweave.functions.text import join_words, sentence_words, word_count
from signalweave.operators.once import computed_once, explode_once
from signalweave.sources.dictionaries import Rule

# Blocks that are no running text, and the list elements of structured documents.
FIGURE_TAGS = ("fig", "table-wrap")
LIST_TAG, ITEM_TAG, PARAGRAPH_TAG = "list", "list-item", "p"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
            ("&nbsp;", " "), ("&amp;", "&"))


def assemble_paragraphs(lines: DataFrame, doc: str = "doc_id", pos: str = "pos", text: str = "line") -> DataFrame:
    """Lines of documents back to (doc, paras) in line order."""
    ordered = F.array_sort(F.collect_list(F.struct(pos, text)))
    return lines.groupBy(doc).agg(F.transform(ordered, lambda x: x[text]).alias("paras"))


def document_text(paras: Column | str = "paras") -> Column:
    return F.array_join(paras, " ")


def _element(tag: str, body: str = ".*?") -> str:
    return rf"(?is)<{tag}(?:\s[^>]*)?>{body}</{tag}\s*>"


def _decode_references(text: Column) -> Column:
    """Numeric character references (`&#233;`, `&#xE9;`) to characters; impossible ones stay."""

    def decoded(piece: Column, place: Column) -> Column:
        digits = F.regexp_extract(piece, r"^(\d{1,7}|[xX][0-9a-fA-F]{1,6});", 1)
        hexadecimal = F.lower(digits).startswith("x")
        code = F.when(hexadecimal, F.conv(F.substring(digits, 2, 6), 16, 10)).otherwise(digits).try_cast("int")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        letter = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        rest = F.substring(piece, F.length(digits) + 2, F.length(piece))
        return F.when(place == 0, piece).when(valid, F.concat(letter, rest)).otherwise(F.concat(F.lit("&#"), piece))

    return F.array_join(F.transform(F.split(text, "&#", -1), decoded), "")


def plain_text(markup: Column) -> Column:
    """Drop tags, decode the predefined entities and numeric references, put line breaks to blanks."""
    out = F.regexp_replace(markup, r"(?s)<[^>]*>", "")
    out = F.when(markup.contains("&#"), _decode_references(out)).otherwise(out)
    for entity, character in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(character))
    return F.translate(out, "\n", " ")


def structured_paragraphs(
    markup: Column | str,
    drop: Sequence[str] = FIGURE_TAGS,
    list_tag: str = LIST_TAG,
    item_tag: str = ITEM_TAG,
    paragraph_tag: str = PARAGRAPH_TAG,
) -> Column:
    """ARRAY of paragraph texts of an XML or HTML document.

    Figure, table and other given blocks go away; a list becomes one paragraph of its items.
    A paragraph ends at its end tag or where the next one begins.
    """
    body = as_column(markup)
    blocks = "|".join(drop)
    body = F.regexp_replace(body, rf"(?is)<!--.*?-->|<({blocks})(?:\s[^>]*)?>.*?</\1\s*>", "")
    # Paragraph tags inside list items would cut the folded list apart.
    body = F.regexp_replace(body, rf"(?i)</{item_tag}\s*>\s*(?:<{item_tag}(?:\s[^>]*)?>)", " ")
    body = F.regexp_replace(body, rf"(?i)<{list_tag}(?:\s[^>]*)?>", f"<{paragraph_tag}>")
    body = F.regexp_replace(body, rf"(?i)</{list_tag}\s*>", f"</{paragraph_tag}>")
    pieces = F.split(body, rf"(?i)<{paragraph_tag}(?:\s[^>]*)?>", -1)
    inner = F.transform(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda piece: plain_text(F.split(piece, rf"(?i)</{paragraph_tag}\s*>", 2)[0]),
    )
    return F.coalesce(inner, F.array().cast("array<string>"))


def inflections(keys: Sequence[str], suffixes: Sequence[str] = INFLECTED) -> dict[str, str]:
    """Every surface form of the keys to the key it is looked up under.

    A form is looked up as it is, then without its last one, two and three letters; the first
    of these that is a key wins.
    """
    known = set(keys)
    forms: dict[str, str] = {}
    for key in keys:
        for suffix in ("", *suffixes):
            form = key + suffix
            candidates = [form[: len(form) - cut] for cut in range(4)]
            forms[form] = next(c for c in candidates if c in known)
    return forms


def strip_lookup(df: DataFrame, column: str, dimension: DataFrame, key: str, out: str = "matched_key") -> DataFrame:
    """Look a word up in the dimension as it is, then without its last 1, 2, 3 letters.

    Only distinct words go through the four lookups; the rows are joined once with the result.
    """
    known = dimension.select(F.col(key).alias("_key")).distinct()
    found, hits = df.select(F.col(column).alias("_form")).distinct(), []
    for cut in range(4):
        side = known.select(F.col("_key").alias(f"_key{cut}"))
        stem = F.left("_form", F.length("_form") - cut)
        found = found.join(side, stem == F.col(f"_key{cut}"), "left")
        hits.append(f"_key{cut}")
    lookup = found.select("_form", F.coalesce(*hits).alias(out)).filter(F.col(out).isNotNull())
    return df.join(lookup, df[column] == lookup["_form"], "left").drop("_form")


def _literal_map(table: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def keyword_windows(
    docs: DataFrame,
    rules: Sequence[Rule],
    text: str = "text",
    doc: str = "doc_id",
    window: int = 30,
    negation_window: int = 10,
) -> DataFrame:
    """One row per keyword occurrence: (doc, token_pos, surface, key, sentence, window, neg_window).

    The text is expected to be phrase-joined and lowered.  A window holds the tokens from half
    its size before the keyword up to, and not including, half its size after it, cut at the
    ends of the document.  Documents that cannot match are not tokenised, and only occurrences
    are exploded, not tokens.
    """
    forms = inflections([r.anchor for r in rules])
    possible = contains_match(text, inflected_pattern([r.anchor for r in rules]))
    split = computed_once(docs.select(doc, text), _sents=F.when(possible, sentence_words(text))).drop(text)
    flat = computed_once(
        split,
        _tokens=F.flatten("_sents"),
        _owner=F.flatten(F.transform("_sents", lambda s, i: F.array_repeat(i, F.size(s)))),
    )
    located = F.filter(
        F.transform("_tokens", lambda t, i: F.struct(i.alias("pos"), t.alias("surface"))),
        lambda h: h["surface"].isin(*forms),
    )

    def around(pos: Column, size: int) -> Column:
        half = size // 2
        start = F.greatest(pos - half, F.lit(0))
        end = F.least(pos + half, F.size("_tokens"))
        return join_words(F.slice("_tokens", start + 1, end - start))

    hits = F.transform(
        "_hits",
        lambda h: F.struct(
            h["pos"].alias("token_pos"),
            h["surface"].alias("surface"),
            join_words(F.get("_sents", F.get("_owner", h["pos"]))).alias("sentence"),
            around(h["pos"], window).alias("window"),
            around(h["pos"], negation_window).alias("neg_window"),
        ),
    )
    found = explode_once(computed_once(flat, _hits=located), "_hit", hits)
    return found.select(doc, "_hit.*").withColumn("key", F.element_at(_literal_map(forms), F.col("surface")))


def check_context(occurrences: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add include/exclude words and the flags sentence_match, range_match and exclude_match.

    No include words: both matches are 1.  No exclude words: the exclude flag is 0.  A word
    `a,b` asks for a and later b.
    """

    def per_key(value) -> Column:
        out = F.lit(None)
        for rule in rules:
            out = F.when(F.col("key") == rule.anchor, value(rule)).otherwise(out)
        return out

    def flag(column: str, words_: Sequence[str], empty: int) -> Column:
        if not words_:
            return F.lit(empty)
        return contains_match(column, cooccurrence_pattern(words_)).cast("int")

    return occurrences.select(
        "*",
        per_key(lambda r: F.lit("|".join(r.include))).alias("context_key"),
        per_key(lambda r: F.lit("|".join(r.exclude))).alias("exclude_keys"),
        per_key(lambda r: flag("sentence", r.include, 1)).alias("sentence_match"),
        per_key(lambda r: flag("window", r.include, 1)).alias("range_match"),
        per_key(lambda r: flag("neg_window", r.exclude, 0)).alias("exclude_match"),
    )


# Frequent function words per language, our own short selection.
FUNCTION_WORDS = {
    "en": ("the", "of", "and", "to", "is", "that", "it", "for", "was", "with", "this", "are", "from"),
    "fr": ("le", "les", "des", "et", "du", "une", "que", "pour", "est", "qui", "dans", "par", "avec", "sur"),
    "de": ("der", "die", "und", "den", "von", "zu", "das", "sich", "mit", "auf", "ist", "nicht", "ein"),
    "es": ("el", "los", "del", "las", "por", "con", "su", "una", "para", "al", "como", "pero", "y"),
    "it": ("il", "di", "che", "gli", "della", "per", "non", "sono", "anche", "nel"),
    "pt": ("os", "da", "uma", "não", "dos", "mais", "em", "foi", "ao", "pelo"),
    "nl": ("het", "een", "van", "niet", "zijn", "voor", "ook", "maar", "naar", "wordt"),
}


def function_words(text: Column | str, lexicon: Mapping[str, Sequence[str]] = FUNCTION_WORDS) -> Column:
    """All function words of any language in the text, lowered: one search for all languages.

    The entries are single words, so no entry can hide another.
    """
    every = list(dict.fromkeys(w for ws in lexicon.values() for w in ws))
    return F.transform(find_all(text, word_pattern(every, plural=False)), lambda w: F.lower(w))


def language_of(found: Column | str, lexicon: Mapping[str, Sequence[str]] = FUNCTION_WORDS) -> Column:
    """The language most of the function words belong to, earlier ones winning ties; else NA."""
    found = as_column(found)

    def score(words_: Sequence[str]) -> Column:
        return F.size(F.filter(found, lambda w: w.isin(*words_)))

    best = F.array_max(
        F.array(
            *[
                F.struct(score(ws).alias("n"), F.lit(-place).alias("place"), F.lit(lang).alias("lang"))
                for place, (lang, ws) in enumerate(lexicon.items())
            ]
        )
    )
    return F.when(best["n"] > 0, best["lang"]).otherwise(F.lit("NA"))


def document_facts(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang, word_count); no shuffle."""
    searched = computed_once(
        docs.select(F.col(doc).cast("string").alias("doc_id"), text),
        word_count=word_count(text),
        _found=function_words(text),
    )
    return searched.select("doc_id", language_of("_found").alias("lang"), "word_count")


def enrich_metadata(meta: DataFrame, facts: DataFrame) -> DataFrame:
    """Metadata with the flags `cor` and `request` and the facts of the documents that exist."""
    flagged = meta.withColumns(
        {
            "doc_id": F.col("doc_id").cast("string"),
            "cor": F.coalesce(F.lower("doc_id").contains("cor."), F.lit(False)),
            "request": F.coalesce(F.lower("title").contains("request"), F.lit(False)),
        }
    )
    return flagged.join(facts, "doc_id", "left")
