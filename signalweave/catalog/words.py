"""Small dictionaries with words that occur in the documents table."""

from __future__ import annotations

from signalweave.sources.dictionaries import and_keys, rules_of

GROUPS = {
    "insult": ["worthless", "pathetic", "disgusting", "idiot", "stupid"],
    "licence": ["license", "mit", "apache", "copyright"],
    "order": ["from", "for", "by", "with", "one"],
}

PLACES = {
    "england": ["the", "which", "would"],
    "france": ["les", "une", "avec"],
    "germany": ["der", "und", "nicht"],
    "spain": ["los", "una", "para"],
    "united states of america": ["It", "US"],
    "portugal": ["uma", "dos"],
}
CASED_PLACES = ("united states of america",)

BOOK = {
    "conduct": rules_of(
        [
            ("idiot", ["stupid", "pathetic", "the"], []),
            ("worthless", [], ["disgusting", "clown"]),
            ("pathetic", ["of", "and"], ["license"]),
            ("trash", [], []),
        ]
    ),
    "rights": rules_of(
        [
            ("license", ["apache", "mit", "under"], []),
            ("copyright", [], ["idiot"]),
        ]
    ),
    "common": rules_of([("of the", [], []), ("the", ["was"], ["stupid"]), ("der", ["die"], ["nicht"])]),
}

THEMES = and_keys(
    {
        "Climate_Keys": ["worthless", "the+of", "der+und", "license"],
        "Policy_Keys": ["was", "idiot", "la+que", "in+die"],
    }
)

CONTEXT_RULES = rules_of(
    [
        ("idiot", ["the", "of"], ["stupid"]),
        ("clown", [], []),
        ("of_the", ["was", "in,and"], ["not", "is"]),
        ("der", ["und"], []),
        ("erer", [], ["the"]),
    ]
)
CONTEXT_PHRASES = ["of the"]
