"""Token counts by byte-pair merging, without producing token ids.

A text is cut into pretokens; the symbols of a pretoken form a linked list, and a heap holds the
adjacent pairs that have a merge rank.  The pair of lowest rank, leftmost first, is merged again
and again.  The count of a pretoken is its number of bytes minus the number of merges.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.llm.frames import documents, map_texts
from signalweave.llm.lookup import Lookup

VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
# ASCII marks that make a pretoken of one byte after letters.
CLOSING = {",", ".", "!", "?", ";", ":"}

# The pretoken pattern of byte-level byte-pair vocabularies.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves; the others follow from code point 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class MergeCounter(Lookup):
    """Counts the tokens of texts under a byte-level vocabulary file.

    As a dictionary it maps a word to the tokens of a blank and that word, and counts what it has
    not seen.
    """

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        self._symbols = [ids[letter] for letter in byte_letters()]
        # Ranks by first and second symbol, and the symbol that the pair of each rank merges to.
        self._ranks: list[dict[int, int]] = [{} for _ in range(max(ids.values()) + 1)]
        self._merged = []
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self._ranks[ids[a]][ids[b]] = rank
            self._merged.append(ids[a + b])
        added = [t["content"] for t in spec.get("added_tokens", [])]
        longest_first = sorted(added, key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, longest_first))) if added else None
        self._pretokens = regex.compile(PRETOKENS)
        self._loose_blank = re.compile(r"\s ")

    def merged(self, pretoken: str) -> int:
        """Symbols left of one pretoken when no adjacent pair has a rank any more.

        A heap entry is a pair's rank above the place of its first symbol.  It is stale when the
        rank of the pair at that place, kept beside the list, has changed since.
        """
        ranks, merged = self._ranks, self._merged
        table = self._symbols
        symbols = [table[b] for b in pretoken.encode("utf-8")]
        n = len(symbols)
        width = n.bit_length()
        place = (1 << width) - 1
        pair = [ranks[a].get(b, -1) for a, b in zip(symbols, symbols[1:])]
        heap = [r << width | i for i, r in enumerate(pair) if r >= 0]
        if not heap:
            return n
        heapify(heap)
        pair.append(-1)
        after = list(range(1, n + 1))
        before = list(range(-1, n))
        left = n
        while heap:
            entry = heappop(heap)
            i, r = entry & place, entry >> width
            if pair[i] != r:
                continue
            symbols[i] = a = merged[r]
            left -= 1
            j = after[i]
            pair[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                pair[i] = r = ranks[a].get(symbols[k], -1)
                if r >= 0:
                    heappush(heap, r << width | i)
            else:
                pair[i] = -1
            h = before[i]
            if h >= 0:
                pair[h] = r = ranks[symbols[h]].get(a, -1)
                if r >= 0:
                    heappush(heap, r << width | h)
        return left

    def _plain(self, text: str) -> int:
        return sum(map(self._pretoken, self._pretokens.findall(text)))

    def _pretoken(self, pretoken: str) -> int:
        # A pretoken that begins with a blank is what a word's key stands for.
        known = self.get(pretoken[1:]) if pretoken[0] == " " else None
        return self.merged(pretoken) if known is None else known

    def compute(self, word: str) -> int:
        """Count of a blank and the word after it, which goes on up to the next blank."""
        if word.isalpha():
            return self.merged(" " + word)
        if word[-1:] in CLOSING and word[:-1].isalpha():
            return self[word[:-1]] + 1
        return self._plain(" " + word)

    def _section(self, text: str) -> int:
        # Where white space only ever precedes a word, cutting before each blank cuts between
        # pretokens, and words can be looked up whole.  Elsewhere the pattern needs its context.
        if self._loose_blank.search(text):
            return self._plain(text)
        words = text.split(" ")
        words[0], first = "", words[0]
        return self._plain(first) + sum(map(self.__getitem__, words)) - self[""]

    def count(self, text: str) -> int:
        """Tokens of a whole text; a string of an added token counts as that one token."""
        if self._special is None or not self._special.search(text):
            return self._section(text)
        sections = self._special.split(text)
        return len(sections) - 1 + sum(map(self._section, sections))


def token_counts(
    df: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """Kept columns, `n_bytes` and `n_tokens` of every whole text; NULL counts as empty (0, 0).

    Rows are independent: repeated and NULL ids stay as they are, an empty table gives no row.
    Memory is bounded by one text and two caches of fixed size.
    """
    path = path or vocabulary_path()

    def values() -> Callable:
        count = MergeCounter.shared(path).count

        def columns(texts: list[bytes]):
            yield pa.array([len(t) for t in texts], pa.int64())
            yield pa.array([count(t.decode("utf-8")) for t in texts], pa.int64())

        return columns

    return map_texts(df, "n_bytes long, n_tokens long", values, text, keep)


def token_counts_query(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts(documents(spark, folder))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
