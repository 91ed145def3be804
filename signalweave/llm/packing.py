"""Packing documents into sequences of a fixed number of tokens by bounded-space online packing.

Each partition keeps a fixed number of windows open.  A document first fills whole windows; what is
left goes to the open window that it fits best.  When none fits and no more may be opened, the
fullest window is topped up by cutting the document, or padded if a cut would be too small, and
emitted.  Windows still open at the end of a partition are merged with those of its neighbours.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.llm.frames import documents, slices, stored, utf8
from signalweave.llm.lookup import Lookup
from signalweave.llm.token_counts import CLOSING, byte_letters, vocabulary_path

VOCABULARY = "word_bpe_49k.json"
LIMIT = 4096
END_ID = 2
OPEN_WINDOWS = 32
# No cut leaves a piece of fewer tokens than this, except when leftovers are merged.
LEAST_PIECE = 16
# Partitions whose leftovers are merged together; with OPEN_WINDOWS this bounds a merging task.
MERGED_PARTITIONS = 32
ID_BYTES = 4

FIELDS = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " ids binary, closed boolean"
)


class WordTokens(Lookup):
    """Token ids by word, for a vocabulary that drops white space; looks up what it has not seen.

    Values are little-endian ids, ID_BYTES each.  Words of letters alone, and such with a mark after
    them, go straight to the library's merge model; everything else takes its whole path.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._merge = self._tokenizer.model.tokenize
        self._letters = dict(enumerate(byte_letters()))

    def compute(self, word: bytes) -> bytes:
        text = word.decode("utf-8")
        mark = text[-1:] if text[-1:] in CLOSING else ""
        core = text[:-1] if mark else text
        if self._plain(core):
            return self._core(core.lower()) + (self[mark.encode()] if mark else b"")
        return self._whole(text)

    def _plain(self, text: str) -> bool:
        """Letters that the library's normalisation only lowers, one by one."""
        return text.isalpha() and (text.isascii() or (is_normalized("NFC", text) and text.lower().isalpha() and "Σ" not in text))

    def _core(self, text: str) -> bytes:
        data = text.encode("utf-8")
        known = self.get(data)
        if known is not None:
            return known
        units = text if text.isascii() else data.decode("latin-1").translate(self._letters)
        return array("I", [token.id for token in self._merge(units)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: bytes) -> bytes:
        """The ids of a whole text."""
        return b"".join(map(self.__getitem__, text.split()))


class Packer:
    """The open windows of one partition; collects rows in the order of FIELDS, after the kept values."""

    def __init__(self, first_sequence: int, limit: int, open_windows: int):
        self._next = first_sequence
        self._limit, self._most = limit, open_windows
        self._open: list[tuple[int, list]] = []  # fill and pieces
        self.rows: list[tuple] = []

    def add(self, kept: tuple, ids: bytes) -> None:
        total = len(ids) // ID_BYTES
        start = 0
        while total - start >= self._limit:
            self._emit([(kept, start, self._limit, ids, total)])
            start += self._limit
        while start < total:
            size = total - start
            best = self._best(size)
            if best is None and len(self._open) < self._most:
                self._open.append((0, []))
                best = len(self._open) - 1
            if best is not None:
                fill, pieces = self._open[best]
                pieces.append((kept, start, size, ids, total))
                self._open[best] = (fill + size, pieces)
                if fill + size == self._limit:
                    self._emit(self._open.pop(best)[1])
                return
            fill, pieces = self._open.pop(max(range(len(self._open)), key=lambda i: self._open[i][0]))
            free = self._limit - fill
            if free >= LEAST_PIECE and size - free >= LEAST_PIECE:
                pieces.append((kept, start, free, ids, total))
                start += free
            self._emit(pieces)

    def _best(self, size: int) -> int | None:
        """The open window with the least room that takes `size` tokens."""
        found, most = None, -1
        for i, (fill, _) in enumerate(self._open):
            if most < fill <= self._limit - size:
                found, most = i, fill
        return found

    def _emit(self, pieces: list, closed: bool = True) -> None:
        offset = 0
        for kept, start, length, ids, total in pieces:
            own = ids[start * ID_BYTES : (start + length) * ID_BYTES]
            self.rows.append((*kept, start, length, zlib.crc32(own), total, self._next, offset, own, closed))
            offset += length
        self._next += 1

    def leave(self) -> None:
        """Hand out the windows that are still open, for merging."""
        for _, pieces in self._open:
            self._emit(pieces, closed=False)
        self._open = []


def _packed(
    df: DataFrame, path: str, keep: tuple[str, ...], text: str, limit: int, open_windows: int, with_ids: bool
) -> DataFrame:
    kept = df.select(*[df[c] for c in keep], df[text].alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    end = array("I", [END_ID]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens.shared(path)
        packer = Packer(TaskContext.get().partitionId() << 32, limit, open_windows)
        kinds = None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*packer.rows))
            packer.rows = []
            ids, closed = columns[-2], columns[-1]
            if not with_ids:
                ids = tuple(None if done else own for own, done in zip(ids, closed))
            arrays = [pa.array(c, k) for c, k in zip(columns[: len(keep)], kinds)]
            arrays += [pa.array(c, pa.int64()) for c in columns[len(keep) : -2]]
            arrays += [pa.array(ids, pa.binary()), pa.array(closed, pa.bool_())]
            return pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(len(arrays))])

        for batch in batches:
            kinds = [batch.schema.field(c).type for c in keep]
            for part in slices(batch, "_text"):
                values = zip(*(part.column(c).to_pylist() for c in keep))
                for one, own in zip(values, utf8(part, "_text")):
                    packer.add(one, tokens.ids(own) + end)
                if packer.rows:
                    yield flush()
        packer.leave()
        if packer.rows:
            yield flush()

    return kept.mapInArrow(run, f"{fields}, {FIELDS}")


def _merge(table: pa.Table, limit: int) -> pa.Table:
    """Fill sequences one after the other with the pieces of all leftover windows, cutting at their ends.

    What is left at the very end becomes sequences whose lengths are powers of two.
    """
    rows = sorted(table.to_pylist(), key=lambda r: (r["sequence_id"], r["offset"]))
    whole, rest = divmod(sum(r["length"] for r in rows), limit)
    sizes = iter([limit] * whole + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1])
    # New sequences take the numbers of the windows that they replace; should the powers of two need
    # more, these follow the last partition's last number.
    numbers = iter(dict.fromkeys(r["sequence_id"] for r in rows))
    number = last = rows[-1]["sequence_id"]
    out, room, offset = [], 0, 0
    for row in rows:
        ids, start, left = row["ids"], row["start"], row["length"]
        while left:
            if not room:
                room, offset = next(sizes), 0
                number = next(numbers, None)
                if number is None:
                    number = last = last + 1
            take = min(room, left)
            own, ids = ids[: take * ID_BYTES], ids[take * ID_BYTES :]
            out.append(row | {
                "start": start, "length": take, "ids_crc32": zlib.crc32(own), "sequence_id": number,
                "offset": offset, "ids": own, "closed": True,
            })
            start, left, room, offset = start + take, left - take, room - take, offset + take
    return pa.Table.from_pylist(out, schema=table.schema)


def pack(
    df: DataFrame,
    path: str | None = None,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    limit: int = LIMIT,
    open_windows: int = OPEN_WINDOWS,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: kept columns, `start`, `length`, `ids_crc32`, `doc_tokens`, `sequence_id`, `offset`, `ids`.

    A NULL or empty text is a document of the end id alone.  Rows are documents of their own, also
    when ids repeat or are NULL; an empty table gives no row.  `ids` holds the piece's ids, 4 bytes
    each, little-endian; without `with_ids` it is left out.
    """
    path = path or vocabulary_path(VOCABULARY)
    # Written once: the merge must see the very windows that the partitions left.
    pieces = stored(_packed(df, path, keep, text, limit, open_windows, with_ids), "packing")
    names = [c for c in pieces.columns if c != "closed" and (with_ids or c != "ids")]
    block = F.shiftright(F.shiftright("sequence_id", 32), (MERGED_PARTITIONS - 1).bit_length())
    open_ = pieces.filter(~F.col("closed"))
    merged = open_.groupBy(block).applyInArrow(lambda rows: _merge(rows, limit), pieces.schema)
    return pieces.filter("closed").select(names).union(merged.select(names))


def packing_query(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents(spark, folder), with_ids=False)
