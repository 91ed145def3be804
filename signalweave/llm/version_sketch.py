"""Document fingerprints that tell how two versions differ: invertible Bloom lookup sketches.

A text is the set of its paragraphs, of which long ones are cut after sentences and, in these, after
some words.  Each paragraph's digest goes into one cell of each of HASHES tables; a cell adds up how many digests
it has, and the exclusive or of them and of their check sums.  The fingerprint is the sketch of a fixed number of cells.  The
sketches of two versions subtract cell by cell, which takes away what both have.  A cell that has one digest left
shows it; that digest is taken out of its other cells, which lays open more of them.  Where this peeling gets stuck,
the two versions are compared again by larger sketches.

Cells are rows: a step of peeling is one explode and one aggregate, without a shuffle, since a text's
cells stay together from the beginning.  Work and memory grow with the paragraphs, not with their square.
All of it is DataFrame functions.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalweave.llm.frames import documents, release, stored
from signalweave.operators.once import computed_once

HASHES = 3
# Cells of a fingerprint for each hash; where the fingerprints' difference cannot be peeled, each further attempt
# has GROWTH times as many and other hashes.  Only cells in which something is are rows, so that more cells cost nothing.
CELLS = 8
GROWTH = 512
# Rounds over all tables before an attempt is given up for a larger one: a sketch with hundreds of times as many
# cells is nearly always peeled by the first.
ROUNDS = 3
ROUNDS_LARGER = 1

# Up to so many words of one sentence.
PIECE = r"(?:[^\s.!?]++[^\S\n]*+){1,8}+"

# Documents in one range of ids, the most ranges, and rows drawn for each range to place its bounds.
RANGE_ROWS = 1_000
MOST_RANGES = 20_000
DRAWN = 8
# Documents of one block, whose cells lie together, and those that one task adds up.
BLOCK_BITS = 8
TASK_ROWS = 400

LAST_ID = (1 << 63) - 1


def paragraphs(text: Column) -> Column:
    """The distinct digests of a text's paragraph pieces; a text without a word has none.

    White space at their ends, and marks that end a sentence, are no part of them.
    """
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda x: F.xxhash64(F.trim(x))))


def _cell(key: Column, table: Column | int, attempt: int) -> Column:
    table, size = F.lit(table).cast("long") if isinstance(table, int) else table, cells_of(attempt)
    return table * size + F.pmod(F.xxhash64(F.lit(attempt), table, key), F.lit(size))


def cells_of(attempt: int) -> int:
    """Cells for each hash: those of a fingerprint at attempt 0."""
    return CELLS * GROWTH**attempt


def _check(key: Column) -> Column:
    return F.xxhash64(F.lit("check"), key)


def sketch(units: DataFrame, by: list[str], attempt: int = 0, empty: bool = False) -> DataFrame:
    """Cells of the digests `key`, each with a `sign` of 1 or -1, for every value of the columns `by`.

    With digests of one sign this is a sketch; with those of another version under -1 it is the difference of both
    sketches, since cells only add up.  `cell`, `n`, `keys`, `checks`; cells in which nothing is left are not there
    unless `empty`, and a NULL digest is in none.
    """
    tables = F.array(*[F.lit(t).cast("long") for t in range(HASHES)])
    placed = units.select(*by, "key", "sign", F.explode(tables).alias("table"))
    return _merged(
        placed.select(
            *by, _cell(F.col("key"), F.col("table"), attempt).alias("cell"), F.lit(None).cast("long").alias("found"),
            F.col("sign").alias("n"), F.col("key").alias("keys"),
            F.when(F.col("key").isNotNull(), _check(F.col("key"))).alias("checks"),
        ),
        by,
        empty,
    )


def _merged(cells: DataFrame, by: list[str], empty: bool = False) -> DataFrame:
    """Cells of equal place added up; rows of digests that were found (`cell` is -1) stay as they are."""
    merged = cells.groupBy(*by, "cell", "found").agg(
        F.sum("n").alias("n"), F.bit_xor("keys").alias("keys"), F.bit_xor("checks").alias("checks")
    )
    return merged if empty else merged.filter("n != 0 OR keys != 0 OR checks != 0")


def peel(cells: DataFrame, by: list[str], attempt: int = 0) -> DataFrame:
    """The cells after the attempt's rounds of peeling, with a row of `cell` -1 for every digest found.

    Such a row has the digest as `found`, and `n` tells the version that has it: 1 or -1.  A step looks at the cells of one
    table, in which a digest has one place only, so that no two cells can show the same one.
    """
    size, rounds = cells_of(attempt), ROUNDS_LARGER if attempt else ROUNDS
    for table in [t for _ in range(rounds) for t in range(HASHES)]:
        here = (F.col("cell") >= table * size) & (F.col("cell") < (table + 1) * size)
        single = here & (F.abs("n") == 1) & (F.col("checks") == _check(F.col("keys")))

        def row(cell: Column, found: Column, n: Column, keys: Column, checks: Column) -> Column:
            return F.struct(*[c.alias(a) for c, a in zip((cell, found, n, keys, checks), ("cell", "found", "n", "keys", "checks"))])

        cell, found, n, keys, checks = map(F.col, ("cell", "found", "n", "keys", "checks"))
        none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
        out = [row(_cell(keys, t, attempt), none, -n, keys, checks) for t in range(HASHES)]
        known = row(F.lit(-1).cast("long"), keys, n, zero, zero)
        as_is = row(cell, found, n, keys, checks)
        rows = F.when(single, F.array(as_is, *out, known)).otherwise(F.array(as_is))
        cells = _merged(cells.select(*by, F.explode(rows).alias("r")).select(*by, "r.*"), by)
    return cells


def differences(units: DataFrame, by: list[str], attempt: int = 0) -> DataFrame:
    """`here`, `there` (digests that only one version has) and `stuck` (cells not peeled) for each value of `by`.

    Versions without any difference have no row.
    """
    last = peel(sketch(units, by, attempt), by, attempt)
    one, other = (F.col("cell") == -1) & (F.col("n") > 0), (F.col("cell") == -1) & (F.col("n") < 0)
    return last.groupBy(*by).agg(
        F.count_if(one).alias("here"), F.count_if(other).alias("there"), F.count_if(F.col("cell") >= 0).alias("stuck")
    )


def recovered(units: DataFrame, by: list[str], attempt: int = 0) -> DataFrame:
    """The differing paragraph digests themselves: `key`, and `n` of 1 or -1 for the version that has it."""
    last = peel(sketch(units, by, attempt), by, attempt)
    return last.filter("cell = -1").select(*by, F.col("found").alias("key"), "n")


def fingerprint(cells: Column) -> Column:
    """The sketch as text: count, digests and check sums of each cell in which something is."""

    def word(c: Column) -> Column:
        return F.concat(
            F.lpad(F.hex(c["cell"]), 2, "0"), F.lpad(F.hex(c["n"]), 4, "0"), F.lpad(F.hex(c["keys"]), 16, "0"),
            F.lpad(F.hex(F.call_function("shiftrightunsigned", c["checks"], F.lit(32))), 8, "0"),
        )

    return F.array_join(F.transform(F.array_sort(cells), word), ":")


def _bounds(keys: DataFrame) -> tuple[list[list[int]], list[int]]:
    """Keys that cut the rows into ranges of about equal size, ascending, and the least key.

    They are drawn from the rows by a hash, an expected number of DRAWN for each range, MOST_RANGES ranges at most;
    a key that many rows share is drawn as often, and is then the bound of several ranges.
    """
    total = keys.count()
    ranges = min(MOST_RANGES, total // RANGE_ROWS)
    rate = min(1.0, ranges * DRAWN / max(1, total))
    draw = F.pmod(F.xxhash64("id", "h", F.monotonically_increasing_id()), F.lit(1_000_000))
    first = keys.agg(F.min(F.struct("id", "h")).alias("k")).first()["k"]
    drawn = sorted(tuple(r) for r in keys.filter(draw < round(rate * 1_000_000)).collect()) if ranges > 1 else []
    step = max(1, len(drawn) // max(1, ranges))
    return [list(k) for k in drawn[step::step]], list(first) if first else []


def _before(bounds: Column, count: int, key: Column, equal: bool) -> Column:
    """How many of the sorted bounds are less than the key, or less or equal: a search by halving steps."""
    bits = max(0, count.bit_length() - 1)
    steps = F.array(*[F.lit(1 << i) for i in range(bits, -1, -1)])

    def further(at: Column, step: Column) -> Column:
        probe = F.element_at(bounds, F.least(at + step, F.lit(count)))
        less = probe <= key if equal else probe < key
        return F.when((at + step <= F.lit(count)) & less, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), further)


def with_next(df: DataFrame, text: str = "text") -> DataFrame:
    """`doc_id`, `text` and `next`, the text of the following document, with `range`, `place` and the sort keys `id`, `h`.

    Documents come in the order of their ids, a NULL id as the largest, and those of one id in the order
    of a hash of their texts; after the last comes the first.  A NULL text is empty.  Each range of ids is
    sorted by itself and gets a copy of the first row of the next range, a row of `place` 0 that comes at its end.
    The texts are shuffled once.  Rows that are the same in id and text are dealt to several ranges if they are many.
    """
    spark = df.sparkSession
    own = F.coalesce(df[text], F.lit(""))
    keyed = df.select(
        df["doc_id"].alias("doc_id"), own.alias("text"),
        F.coalesce(df["doc_id"].cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64(own).alias("h"),
    )
    bounds, first = _bounds(keyed.select("id", "h"))
    count = len(bounds)
    shape = "array<struct<id: bigint, h: bigint>>"
    table = F.from_json(F.lit(json.dumps([{"id": a, "h": b} for a, b in bounds])), shape)
    key = F.struct("id", "h")
    if count:
        rows = keyed.withColumn("low", _before(table, count, key, False)).withColumn("high", _before(table, count, key, True))
        # Between equal bounds any range will do for a row of that key.
        spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.greatest(F.lit(1), F.col("high") - F.col("low")))
        rows = rows.withColumn("range", F.col("high") - spread.cast("int"))
        # The least key follows the last range; the key of a bound follows the range before it.
        follows = F.concat(
            F.when(F.col("high") > F.col("low"), F.sequence("low", F.col("high") - 1)).otherwise(F.array()),
            F.when((F.col("id") == first[0]) & (F.col("h") == first[1]), F.array(F.lit(count))).otherwise(F.array()),
        )
        extra = rows.withColumn("follows", follows).filter(F.size("follows") > 0).dropDuplicates(["id", "h"])
        extra = extra.withColumn("range", F.explode("follows"))
    else:
        rows = keyed.withColumn("range", F.lit(0))
        extra = (
            rows.filter((F.col("id") == first[0]) & (F.col("h") == first[1])).dropDuplicates(["id", "h"])
            if first
            else rows.limit(0)
        )
    columns = ["range", "id", "h", "doc_id", "text"]
    both = rows.select(*columns, F.lit(0).alias("guest")).union(extra.select(*columns, F.lit(1)))
    order = _order()
    return both.select("*", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next"))


def _order():
    return Window.partitionBy("range").orderBy("guest", "id", "h")


def edited(text: Column, following: Column, chars: Column) -> Column:
    """The text, its last half replaced by the first as many characters of the following one."""
    half = F.floor(chars / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), chars - half), F.substring(following, F.lit(1), half))


def _prepared(df: DataFrame, text: str) -> DataFrame:
    """Per document its paragraph digests and those of its edited text; texts are not needed after this.

    Ranges are cut into blocks, again with a copy of the row that follows, and `range` is the block from here on.
    """
    rows = computed_once(with_next(df, text), chars=F.char_length("text").cast("int"))
    rows = computed_once(rows, changed=edited(F.col("text"), F.coalesce("next", F.lit("")), F.col("chars")))
    rows = rows.select(
        "range", "place", "guest", "id", "h", "doc_id", F.col("chars").cast("long").alias("n_chars"),
        F.sha2(F.col("changed").cast("binary"), 256).alias("edited_sha256"),
        paragraphs(F.col("text")).alias("own"), paragraphs(F.col("changed")).alias("new"),
    )
    rows = computed_once(rows, n_own=F.size("own"), n_new=F.size("new"))
    # The same order again, so that nothing is moved or sorted for it.
    rows = rows.withColumn("n_next", F.lead("n_own").over(_order())).drop("id", "h")
    at = F.col("place") - 1
    block = F.call_function("shiftleft", F.col("range").cast("long"), F.lit(32)) + F.shiftright(at, BLOCK_BITS)
    begins = (at > 0) & (at.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) == 0)
    itself = F.struct(block.alias("range"), F.col("guest").alias("guest"))
    follows = F.struct((block - 1).alias("range"), F.lit(1).alias("guest"))
    rest = [c for c in rows.columns if c not in ("range", "guest")]
    blocks = F.array_compact(F.array(itself, F.when(begins, follows)))
    return rows.select(*rest, F.explode(blocks).alias("b")).select("b.*", *rest)


ROW = ["range", "place"]
PAIR = ["range", "place", "pair"]


def _signed(keys: str, sign: int) -> Column:
    return F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(sign).cast("long").alias("sign")))


def _units(table: DataFrame) -> DataFrame:
    """`key`, `sign` of the pairs "edited" (document and edited text) and "next" (document and following one).

    A document is the one version of its own pairs and the other one of the pair of the document before it.
    The flags `edited`, `next` and `before` say which of the three are wanted.
    """

    def version(wanted: str, pair: str, place: Column, keys: str, sign: int) -> Column:
        made = F.struct(F.lit(pair).alias("pair"), place.alias("place"), _signed(keys, sign).alias("units"))
        return F.when(F.col(wanted), made)

    here = F.col("place")
    parts = F.array(
        version("edited", "edited", here, "own", 1), version("edited", "edited", here, "new", -1),
        version("next", "next", here, "own", 1), version("before", "next", here - 1, "own", -1),
    )
    each = table.select("range", F.explode(F.array_compact(parts)).alias("v"))
    return each.select("range", "v.place", "v.pair", F.explode("v.units").alias("u")).select(*PAIR, "u.key", "u.sign")


def _tasks(df: DataFrame) -> int:
    """Partitions for tables by block: at least those of any shuffle, and one for a few hundred documents."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(MOST_RANGES, df.count() // TASK_ROWS))


def version_likeness(df: DataFrame, text: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they are.

    `near_edited` and `near_next` are twice the paragraphs that two versions share, divided by those of both: 1
    for equal sets (two texts without a word included), 0 where nothing is shared.  The order of
    paragraphs and how often one occurs do not matter.  What the sketches' peeling recovers decides;
    pairs that get stuck are peeled again from larger sketches until none is left.

    Every row is a document of its own; see `with_next` for NULL and repeated ids.  A document that is
    alone follows itself.  An empty table gives no row; other columns are not read.
    """
    spark = df.sparkSession
    table = stored(_prepared(df, text), "versions")
    release(spark)
    tasks = _tasks(table)
    keys = table.select(*ROW, "guest", "own", "new").repartition(tasks, "range")
    real = F.col("guest") == 0
    # The first row of a block has no document before it there, and a guest no pairs of its own.
    inside = ~real | ((F.col("place") - 1).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) != 0)
    wanted = keys.select("*", real.alias("edited"), real.alias("next"), (inside & (F.col("place") > 1)).alias("before"))
    solved, attempt = None, 0
    while True:
        # One exchange of digests by range; what follows is by range and more, so that no cell moves.
        got = stored(differences(_units(wanted), PAIR, attempt), "version-differences")
        release(spark)
        done = got.filter("stuck = 0").select(*PAIR, "here", "there")
        solved = done if solved is None else solved.unionByName(done)
        stuck = got.filter("stuck > 0").select(*PAIR)
        if not stuck.head(1):
            break
        attempt += 1
        following = F.when(F.col("pair") == "next", F.struct((F.col("place") + 1).alias("place"), F.lit("before").alias("flag")))
        flags = F.array_compact(F.array(F.struct("place", F.col("pair").alias("flag")), following))
        each = stuck.select("range", F.explode(flags).alias("f")).select("range", "f.*").repartition(tasks, "range")
        # One row for each block, with places of one block: both sides of the join lie by block alone.
        of = {f: F.collect_set(F.when(F.col("flag") == f, F.col("place"))).alias(f) for f in ("edited", "next", "before")}
        joined = keys.join(each.groupBy("range").agg(*of.values()), "range")
        wanted = joined.select(*keys.columns, *[F.array_contains(f, F.col("place")).alias(f) for f in of])
    return _result(table, solved, tasks)


def _result(table: DataFrame, solved: DataFrame, tasks: int) -> DataFrame:
    """All sides lie by block alike, so that nothing moves for a join or aggregate."""
    apart = F.col("here") + F.col("there")
    lost = solved.repartition(tasks, "range").groupBy(*ROW).agg(
        F.max(F.when(F.col("pair") == "edited", apart)).alias("edited"),
        F.max(F.when(F.col("pair") == "next", apart)).alias("next"),
    )
    # The places of one block, whose number is fixed.
    entry = F.struct("place", F.struct("edited", "next"))
    lost = lost.groupBy("range").agg(F.map_from_entries(F.collect_list(entry)).alias("lost"))
    rows = table.filter("guest = 0").drop("guest").repartition(tasks, "range").join(lost, "range", "left")

    def near(one: str, other: str, pair: str) -> Column:
        both = F.col(one) + F.col(other)
        share = (both - F.coalesce(F.col("lost")[F.col("place")][pair], F.lit(0))) / F.nullif(both, F.lit(0))
        return F.coalesce(share, F.lit(1.0)).cast("double")

    facts = ["doc_id", "n_chars", "edited_sha256", "near_edited", "near_next"]
    rows = rows.withColumns({"near_edited": near("n_own", "n_new", "edited"), "near_next": near("n_own", "n_next", "next")})
    # A text without a paragraph has one unit that stands for none, so that its row is not lost.
    none = F.array(F.struct(F.lit(None).cast("long").alias("key"), F.lit(0).cast("long").alias("sign")))
    sides = F.array(*[
        F.struct(F.lit(side).alias("side"), F.concat(none, _signed(column, 1)).alias("units"))
        for side, column in ((0, "own"), (1, "new"))
    ])
    each = rows.select(*ROW, *facts, F.explode(sides).alias("s")).select(*ROW, *facts, "s.side", F.explode("s.units").alias("u"))
    cells = sketch(each.select(*ROW, *facts, "side", "u.*"), [*ROW, *facts, "side"], empty=True)
    # A fixed number of cells for each of the two versions.
    listed = F.struct("cell", "n", "keys", "checks")
    own, new = (F.collect_list(F.when((F.col("side") == side) & (F.col("n") != 0), listed)) for side in (0, 1))
    prints = cells.groupBy(*ROW, *facts).agg(own.alias("own"), new.alias("new"))
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("new")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


def version_sketch_query(spark: SparkSession, folder: str) -> DataFrame:
    return version_likeness(documents(spark, folder))
