"""Line dedup by a segment-partition edit join, in DataFrame functions alone.

Two lines within `edits` edits of each other: cut the shorter into edits + 1 segments, and at least
one of them is in the longer line unchanged, moved by no more than the edits before and after it
allow.  Lines are indexed by their length and segments; a line probes, for each length it may match,
the few substrings that can be such a segment.  Lines of a segment that many share meet on finer
keys instead: of many short segments all but `edits` agree.  Pairs that meet are verified by an edit distance
that runs over a band around the diagonal, with the band's cells as bits of one number.

A line stays if no line before it is equal or within the edits.  Lines are ordered by the smallest
id of a document that has them, or by id and row, then by their text.
"""

from __future__ import annotations

import json
from itertools import combinations, product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.llm.frames import documents, small, stored
from signalweave.operators.once import computed_once, explode_once

EDITS = 2
# Shorter lines always stay: headings, list marks and the like repeat in clean text.
LEAST_CHARS = 30
# Where no length is set, every line with a word takes part, and two lines may differ by one edit per so
# many characters of the shorter: two edits of a short line make another line of it, not a copy.
EDIT_CHARS = 15
# A line in more than one of so many of all line occurrences is frequent; there are no more such lines.
FREQUENT = 10_000

# A segment that more lines share is crowded: its lines are compared by finer keys.
CROWDED = 16
# Segments for these keys, beyond the number of edits.
FINER = 10
# Where more lines than CROWDED share even such a key, they are of one template.  What they differ in meets on its
# deletion variants, if it has no more characters than this: in one stretch, or in each of two segments.
STRETCH, SEGMENT = 48, 24
# Longer strings meet on their own segments.  Below this there is too little of a string to cut.
LEAST_STRETCH = 14
# Lines of one length meet twice, either being the one that probes; once is enough.
OTHER = "a != b AND (b_less > 0 OR a < b)"

LAST_ID = (1 << 63) - 1


def _key(line: Column | str) -> list[Column]:
    """128 bits that stand for a line."""
    return [F.xxhash64(line).alias("h"), F.xxhash64(F.lit(1), line).alias("g")]


def _takes_part(line: Column, least: int | None) -> Column:
    """Whether the line has `least` characters or, where that is None, a letter or digit."""
    return line.rlike(r"[\p{L}\p{N}]") if least is None else F.char_length(line) >= least


def _ident(df: DataFrame, doc: str) -> Column:
    """What documents are told apart and ordered by: the id, a NULL one last, and then `_row`, if that is there."""
    ident = F.coalesce(df[doc].cast("long"), F.lit(LAST_ID))
    return F.struct(ident.alias("id"), df["_row"].alias("row")) if "_row" in df.columns else ident


def _lines(df: DataFrame, text: str, least: int | None) -> DataFrame:
    """`id`, `line`, `h`, `g` of every distinct line of each document that takes part; see `_ident`."""
    lines = F.array_distinct(F.split(F.col(text), "\n", -1))
    long = F.filter(lines, lambda x: _takes_part(x, least))
    source = df.select(_ident(df, "doc_id").alias("id"), df[text].alias(text))
    return explode_once(source.select("id", F.col(text)), "line", long).select("id", "line", *_key("line"))


INDEX = -1


def _places(edits: int) -> list[tuple[int, int, int]]:
    """What a line is filed under and asks for: INDEX or by how much the other line is shorter, segment and move.

    Filed are the segments of the line.  Asked for are all substrings that can be a segment of a line as long as this or up to
    `edits` shorter: a segment moves by as many places as edits lie before it and, counted from the end, after it.  What a line is
    filed under it asks for too, of lines of its length.
    """
    return [
        (INDEX if less == move == 0 else less, i, move)
        for less in range(edits + 1)
        for i in range(edits + 1)
        for move in range(max(-i, less - (edits - i)), min(i, less + (edits - i)) + 1)
    ]


def segment_keys(lines: DataFrame, edits: int) -> DataFrame:
    """`key`, `h`, `kind` of every place of every line: one explode, then one expression for all places.

    An array of as many key expressions would be a method too large for the JVM to compile.
    """
    parts = edits + 1
    places = [F.struct(F.lit(k).alias("kind"), F.lit(i).alias("i"), F.lit(m).alias("move")) for k, i, m in _places(edits)]
    each = lines.select("h", "line", "size", F.explode(F.array(*places)).alias("p")).select("h", "line", "size", "p.*")
    other = F.col("size") - F.greatest("kind", F.lit(0))
    base, rest = F.floor(other / parts).cast("int"), F.pmod(other, F.lit(parts))
    longer = F.greatest(F.lit(0), F.col("i") - (parts - rest))
    start = F.col("i") * base + longer + 1 + F.col("move")
    size = base + F.when(F.col("i") >= parts - rest, 1).otherwise(0)
    return each.select(F.xxhash64(other, "i", F.substring(F.col("line"), start, size)).alias("key"), "h", "kind")


def _keyed(key: Column, less: Column | int, first: Column | None = None, last: Column | None = None) -> Column:
    """A key, by how much the other line is shorter, and what stands where the lines must differ, if that is known."""
    none = F.lit(None).cast("long")
    less = F.lit(less) if isinstance(less, int) else less
    first, last = (none if c is None else c for c in (first, last))
    return F.struct(key.alias("key"), less.alias("less"), first.alias("x"), last.alias("y"))


def _patterns(edits: int, moves) -> list[tuple[int, int, list[tuple[int, int, int]]]]:
    """All ways to leave out `edits` of edits + FINER segments: a number for the way, by how much the other
    line is shorter, and first segment, last segment and move of each stretch between those left out.

    `moves(less, n)` gives the places by which a stretch with n segments left out before it may move.
    """
    parts = edits + FINER
    found = []
    for kind, out in enumerate(combinations(range(parts), edits)):
        ends = [-1, *out, parts]
        stretches = [(a + 1, b - 1, n) for n, (a, b) in enumerate(zip(ends, ends[1:])) if b - a > 1]
        for less in range(edits + 1):
            for shift in product(*(moves(less, n) for _, _, n in stretches)):
                found.append((kind, less, [(a, b, move) for (a, b, _), move in zip(stretches, shift)]))
    return found


def _finer_keys(line: Column, length: Column, edits: int, patterns: list, whole: bool = False) -> Column:
    """A key per pattern: the stretches of the line that another line has if it differs in the rest only.

    With `whole`, x and y are the strings left out, y being NULL where the two segments touch.
    """
    parts = edits + FINER

    left_out = list(combinations(range(parts), edits))
    rows = []
    for kind, less, stretches in patterns:
        one, two = left_out[kind][0], left_out[kind][-1]
        # Which stretch, counted from 1, lies between two segments that are left out; 0 for none.
        between = [n for n, (a, _, _) in enumerate(stretches, 1) if one < a < two]
        rows.append({
            "kind": kind, "less": less, "one": one, "two": two, "middle": between[0] if between else 0,
            "stretches": [dict(zip(("first", "last", "move"), x)) for x in stretches],
        })
    shape = (
        "array<struct<kind: int, less: int, one: int, two: int, middle: int,"
        " stretches: array<struct<first: int, last: int, move: int>>>>"
    )
    table = F.from_json(F.lit(json.dumps(rows)), shape)

    def key(p: Column) -> Column:
        other = length - p["less"]
        base, rest = F.floor(other / parts).cast("int"), F.pmod(other, F.lit(parts)).cast("int")

        def begin(i: Column) -> Column:
            return i * base + F.greatest(F.lit(0), i - (parts - rest)) + 1

        pieces = F.transform(
            p["stretches"],
            lambda s: F.substring(line, begin(s["first"]) + s["move"], begin(s["last"] + 1) - begin(s["first"])),
        )
        hashed = F.xxhash64(other, p["kind"], pieces)
        if edits != 2:
            return _keyed(hashed, p["less"])
        # With two segments left out that do not touch, lines that differ in one of them only meet on
        # other keys.  Here both must differ, and their contents travel with the key to tell.
        moved = F.element_at(p["stretches"], F.greatest(p["middle"], F.lit(1)))["move"]
        i, j = p["one"], p["two"]
        first = F.substring(line, begin(i), begin(i + 1) + moved - begin(i))
        last = F.substring(line, begin(j) + moved, begin(j + 1) + p["less"] - begin(j) - moved)
        apart = p["middle"] > 0
        if whole:
            both = F.substring(line, begin(i), begin(j + 1) + p["less"] - begin(i))
            return _keyed(hashed, p["less"], F.when(apart, first).otherwise(both), F.when(apart, last))
        return _keyed(hashed, p["less"], F.when(apart, F.xxhash64(first)), F.when(apart, F.xxhash64(last)))

    return F.transform(table, key)


def finer_index_keys(line: Column, length: Column, edits: int, whole: bool = False) -> Column:
    patterns = _patterns(edits, lambda less, n: [0])
    return _finer_keys(line, length, edits, [p for p in patterns if p[1] == 0], whole)


def finer_probe_keys(line: Column, length: Column, edits: int, whole: bool = False) -> Column:
    """As many keys as there are ways for a line as long as this, or shorter, to differ in `edits` segments."""

    def moves(less: int, n: int) -> list[int]:
        # n edits at most lie before the stretch, and edits - n after it.
        return [m for m in range(-n, n + 1) if abs(m) + abs(less - m) <= edits and abs(less - m) <= edits - n]

    return _finer_keys(line, length, edits, _patterns(edits, moves), whole)


def _without(text: Column, at: Column) -> Column:
    """A string without its character at a place counted from 1; 0 takes none."""
    rest = F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + 1, F.char_length(text)))
    return F.when(at > 0, rest).otherwise(text)


def template_pairs(index: DataFrame, probe: DataFrame) -> DataFrame:
    """`a`, `b` of lines that agree but for what their shared key leaves out, and are within two edits there.

    `index` has `a`, `key`, `a_less`, `a_x`, `a_y`, `probe` the same of `b`; x and y are the strings left out, y NULL
    where there is one stretch only.  Two strings within k edits have a common string that takes k deletions at most from
    each.  Of one stretch both edits are taken, of two segments that both differ one each.  What all lines of a key have
    in common at the start and the end of a string takes no part, so that the cost follows what differs.  Strings that are
    longer than STRETCH or SEGMENT would have too many variants; see `long_pairs`.
    """
    sides = [df.toDF("h", "key", "less", "x", "y").withColumn("filed", F.lit(df is index)) for df in (index, probe)]
    rows = stored(sides[0].union(sides[1]), "line-templates")
    back = rows.withColumns({"rx": F.reverse("x"), "ry": F.reverse("y")})
    ends = [f(c).alias(f"{n}_{c}") for c in ("x", "y", "rx", "ry") for n, f in (("low", F.min), ("high", F.max))]
    ends += [F.min(F.char_length(c)).alias(f"size_{c}") for c in ("x", "y")]
    common = back.groupBy("key").agg(*ends)
    for c in ("x", "y"):
        size = F.coalesce(f"size_{c}", F.lit(0))
        common = computed_once(common, **{f"p{c}": _same_start(f"low_{c}", f"high_{c}", size)})
        common = computed_once(common, **{f"q{c}": _same_start(f"low_r{c}", f"high_r{c}", size - F.col(f"p{c}"))})
    common = stored(common.select("key", "px", "qx", "py", "qy"), "line-common")

    def inner(c: str) -> Column:
        return F.substring(F.col(c), F.col(f"p{c}") + 1, F.char_length(c) - F.col(f"p{c}") - F.col(f"q{c}"))

    middles = computed_once(rows.join(common, "key"), _x=inner("x"), _y=inner("y"))
    m, n = F.char_length("_x"), F.char_length("_y")
    places = F.sequence(F.lit(0), m)
    twice = F.transform(
        places, lambda i: F.transform(F.sequence(i, m), lambda j: F.xxhash64(_without(_without(F.col("_x"), j), i)))
    )
    each = F.transform(
        places,
        lambda i: F.transform(F.sequence(F.lit(0), n), lambda j: F.xxhash64(_without(F.col("_x"), i), _without(F.col("_y"), j))),
    )
    # Sizes differ by as many as there are edits: those near the limit meet in both ways.
    stretch, segment = max(STRETCH, LEAST_STRETCH), max(SEGMENT, LEAST_STRETCH)
    one, none = F.col("y").isNull(), F.array().cast("array<bigint>")
    short = F.when(one, F.when(m <= stretch + EDITS, F.flatten(twice))).otherwise(
        F.when((m <= segment + 1) & (n <= segment + 1), F.flatten(each))
    )
    long = F.when(one, m > stretch).otherwise((m > segment) | (n > segment))
    meets = F.array_distinct(F.coalesce(short, none))
    spread = stored(middles.select("h", "key", "less", "filed", F.explode(meets).alias("meet")).distinct(), "line-variants")
    left = spread.filter("filed").select("key", "meet", F.col("h").alias("a"))
    right = spread.filter("NOT filed").select("key", "meet", F.col("h").alias("b"), F.col("less").alias("b_less"))
    met = left.join(right, ["key", "meet"]).filter(OTHER)
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # No line has a line break in it, so that one may stand between the two strings.
    joined = F.when(one, F.col("_x")).otherwise(F.concat_ws("\n", "_x", "_y"))
    longer = middles.filter(long).select("h", F.col("key").alias("under"), "filed", joined.alias("line")).distinct()
    longer = stored(longer.withColumn("size", F.char_length("line")), "line-long")
    return pairs if longer.isEmpty() else pairs.union(long_pairs(longer))


def shared_keys(keys: DataFrame) -> DataFrame:
    """The rows of `h`, `key`, `filed` whose key a filed string shares with one of another line that asks for it."""
    live = keys.groupBy("key").agg(
        F.min("h").alias("low"), F.max("h").alias("high"), F.max("filed").alias("some"), F.min("filed").alias("every")
    )
    return keys.join(live.filter("low != high AND some AND NOT every").select("key"), "key", "left_semi").select(keys.columns)


def long_pairs(rows: DataFrame) -> DataFrame:
    """`a`, `b` of strings under one key that may be within two edits, by the segments of the strings themselves.

    `rows` has `h`, `under`, `filed`, `line`, `size`.  Where more than CROWDED filed strings share a segment, finer keys of
    the strings decide, and where these are crowded too, `template_pairs` of what they leave out.  That is a sixth of the
    string, so that this ends; and no step makes all pairs of a key.
    """
    named = rows.select(F.struct("h", "under", "filed").alias("h"), "line", "size")
    keys = segment_keys(named, EDITS).select(F.xxhash64("h.under", "key").alias("key"), "kind", "h.*")
    keys = stored(shared_keys(keys.filter(f"NOT filed OR kind = {INDEX}").distinct()), "line-long-keys")
    asked = keys.filter("NOT filed").select("key", F.col("h").alias("b"), F.greatest("kind", F.lit(0)).alias("b_less"))
    shared = keys.filter("filed").groupBy("key").agg(F.count(F.lit(1)).alias("sharing"))
    filed = keys.filter("filed").select("key", F.col("h").alias("a")).join(shared.filter(F.col("sharing") <= CROWDED), "key")
    pair = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    pairs = filed.join(asked, "key").filter(OTHER).select(*pair)
    busy = keys.join(shared.filter(F.col("sharing") > CROWDED), "key", "left_semi").select("h", "under", "filed").distinct()
    busy = stored(rows.join(busy, ["h", "under", "filed"], "left_semi"), "line-long-crowded")
    if busy.isEmpty():
        return pairs

    def finer(filed: bool) -> DataFrame:
        found = (finer_index_keys if filed else finer_probe_keys)(F.col("line"), F.col("size"), EDITS, whole=True)
        each = busy.filter(F.col("filed") == filed).select("h", "under", "filed", F.explode(found).alias("k"))
        return each.select("h", F.xxhash64("under", "k.key").alias("key"), "filed", "k.less", "k.x", "k.y")

    both = stored(shared_keys(finer(True).union(finer(False)).distinct()), "line-long-finer")
    index, probe = (
        both.filter(F.col("filed") == F.lit(name == "a")).select(F.col("h").alias(name), "key", *[F.col(c).alias(f"{name}_{c}") for c in ("less", "x", "y")])
        for name in ("a", "b")
    )
    templates = index.groupBy("key").agg(F.count(F.lit(1)).alias("sharing")).filter(F.col("sharing") > CROWDED)
    templates = stored(templates.select("key"), "line-long-templates")
    differ = f"{OTHER} AND (a_y IS NULL OR (a_x != b_x AND a_y != b_y))"
    pairs = pairs.union(index.join(templates, "key", "left_anti").join(probe, "key").filter(differ).select(*pair))
    if templates.isEmpty():
        return pairs
    inside = (side.join(templates, "key", "left_semi").select(side.columns) for side in (index, probe))
    return pairs.union(template_pairs(*inside))


def edit_distances(pairs: DataFrame, a: str, b: str, edits: int) -> DataFrame:
    """Add `edits_apart`: the edit distance of the strings `a` and `b` if it is at most `edits`, else more.

    The lengths may differ by `edits` and must exceed it.  For each character of `b`, a column of the
    distance table, a band of cells around the diagonal is kept as bits of two numbers: `vp` where a
    cell is one more than the one above it, `vn` where it is one less.  All cells are advanced
    together by a few operations, after which the band moves down by one row.  The distance is
    followed along the band's lowest diagonal and, once that has left `a`, along its last row.
    """
    width = 2 * edits + 3
    full, top = (1 << width) - 1, 1 << (width - 1)
    before = F.array_repeat(F.lit(""), width - 1 - edits)
    letters = F.concat(before, F.split(F.col(a), ""), F.array_repeat(F.lit(""), width + edits))
    split = computed_once(pairs, _letters=letters, _chars=F.split(F.col(b), ""), _rows=F.char_length(F.col(a)))

    def equal(c: Column, j: Column) -> Column:
        # Bit i: this character equals the band's i-th row; rows outside of `a` equal nothing.
        bits = [
            F.when(F.element_at("_letters", j + (i + 1)) == c, F.lit(1 << i)).otherwise(F.lit(0)) for i in range(width)
        ]
        return sum(bits[1:], bits[0])

    matched = computed_once(split, _equal=F.transform(F.col("_chars"), equal))

    def no(x: Column) -> Column:
        return x.bitwiseXOR(F.lit(full))

    def let(value: Column, body) -> Column:
        """The body of a value that is computed once."""
        return F.element_at(F.transform(F.array(value), body), 1)

    def bit(x: Column, mask: Column) -> Column:
        return F.when(x.bitwiseAND(mask) != 0, F.lit(1)).otherwise(F.lit(0))

    def step(state: Column, x: Column) -> Column:
        vp, vn, j = state["vp"], state["vn"], state["j"]
        sums = x.bitwiseAND(vp) + vp
        diagonal = sums.bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(F.lit(full))

        def across(d: Column) -> Column:
            more = F.struct(vn.bitwiseOR(no(d.bitwiseOR(vp))).alias("hp"), d.bitwiseAND(vp).alias("hn"))

            def down(h: Column) -> Column:
                inside = state["rows"] - edits - j
                mask = F.expr(f"cast({top >> 1} as int)")
                last = F.call_function("shiftright", mask, -inside)
                score = F.when(inside > 0, 1 - bit(d, F.lit(top))).otherwise(bit(h["hp"], last) - bit(h["hn"], last))
                moved = F.shiftright(d, 1)
                return F.struct(
                    h["hn"].bitwiseOR(no(moved.bitwiseOR(h["hp"]))).alias("vp"),
                    moved.bitwiseAND(h["hp"]).alias("vn"),
                    (state["score"] + score).alias("score"),
                    (j + 1).alias("j"),
                    state["rows"].alias("rows"),
                )

            return let(more, down)

        return let(diagonal, across)

    start = F.struct(
        F.lit(full & (full << (width - edits - 1))).alias("vp"), F.lit(0).alias("vn"), F.lit(edits).alias("score"),
        F.lit(0).alias("j"), F.col("_rows").alias("rows"),
    )
    apart = F.aggregate("_equal", start, step, lambda s: s["score"])
    return matched.withColumn("edits_apart", apart).drop("_letters", "_chars", "_rows", "_equal")


def _same_start(a: str, b: str, most: Column) -> Column:
    """Characters that two strings share at their start, up to `most`: a search by halving steps."""
    high = F.floor(F.log2(F.greatest(most, F.lit(1)))).cast("int")
    steps = F.transform(F.sequence(F.lit(0), high), lambda i: F.call_function("shiftleft", F.lit(1), high - i))

    def longer(known: Column, step: Column) -> Column:
        equal = F.substring(F.col(a), known + 1, step) == F.substring(F.col(b), known + 1, step)
        return F.when((known + step <= most) & equal, known + step).otherwise(known)

    return F.aggregate(steps, F.lit(0), longer)


def _likely(pairs: DataFrame, edits: int) -> DataFrame:
    """Leave out pairs of `a_line` and `b_line` that cannot be within the edits, by their differing middles.

    Without what they share at the start and the end, two lines begin and end with an edit.  One or
    two edits are then used up, and what lies between the ends is equal.  For more edits all pairs stay.
    """
    if edits > 2:
        return pairs
    sizes = {"_m": F.char_length("a_line"), "_n": F.char_length("b_line")}
    back = computed_once(pairs, _ra=F.reverse("a_line"), _rb=F.reverse("b_line"), **sizes)
    start = computed_once(back, _p=_same_start("a_line", "b_line", F.least("_m", "_n")))
    both = computed_once(start, _q=_same_start("_ra", "_rb", F.least("_m", "_n") - F.col("_p")))
    m, n = F.col("_m") - F.col("_p") - F.col("_q"), F.col("_n") - F.col("_p") - F.col("_q")
    likely = (m <= 1) & (n <= 1)
    if edits == 2:
        # What an edit takes from either line: a character each, or one of one of them.
        for (a0, b0), (a1, b1) in product(((1, 1), (1, 0), (0, 1)), repeat=2):
            size = m - (a0 + a1)
            inner = [F.substring(F.col(c), F.col("_p") + 1 + cut, size) for c, cut in (("a_line", a0), ("b_line", b0))]
            likely = likely | ((size >= 0) & (size == n - (b0 + b1)) & (inner[0] == inner[1]))
    return both.filter(likely).drop("_ra", "_rb", "_m", "_n", "_p", "_q")


def near_lines(df: DataFrame, table: DataFrame, total: int, edits: int, least: int | None, text: str) -> DataFrame:
    """`h`, `g` of the lines that have a line before them within the edits.

    `table` has `h`, `g`, `first` and `n` of all lines, `total` is the sum of `n`.  Without `least`, the
    shorter of two lines has EDIT_CHARS characters for each edit between them.
    """
    spark = df.sparkSession
    lines = _lines(df, text, max(EDIT_CHARS, edits + 1) if least is None else least).withColumn("size", F.char_length("line"))
    # Of a frequent line one occurrence takes part.  There are fewer than FREQUENT such lines, by
    # their definition, so that their keys may be broadcast; no other line can fill a partition.
    often = table.filter(F.col("n") * FREQUENT > total).select("h", "g", "first")
    some = lines.join(F.broadcast(often), ["h", "g"], "left").filter("first IS NULL OR first = id")

    def keyed(lines: DataFrame, keys: Column, name: str) -> DataFrame:
        rows = lines.select(F.col("h").alias(name), F.explode(keys).alias("k"))
        fields = [F.col(f"k.{f}").alias(f if f == "key" else f"{name}_{f}") for f in ("key", "less", "x", "y")]
        # Copies of a line meet here and become one before lines meet each other.
        return rows.select(name, *fields).repartition("key").distinct()

    line, size = F.col("line"), F.col("size")
    # One shuffle of all keys for both sides below: a filter that every row passes keeps the join from making an
    # exchange of its own.  Most keys belong to one line, its copies included, and go at once.
    filed = segment_keys(some, edits).repartition("key")
    live = filed.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.min("kind").alias("least"))
    live = live.filter(f"low != high AND least = {INDEX}").select("key")
    met = filed.filter(F.spark_partition_id() >= 0).join(live, "key", "left_semi")
    met = stored(met.distinct(), "line-keys")
    index = met.filter(F.col("kind") == INDEX).select("key", F.col("h").alias("a"))
    probe = met.select("key", F.col("h").alias("b"), F.greatest("kind", F.lit(0)).alias("b_less"))
    # One job over one shuffle: pairs where few lines share a segment, so that a line has a bounded
    # number of them, and the lines by themselves where many do.
    shared = index.groupBy("key").agg(F.count(F.lit(1)).alias("sharing"))
    crowded, none = shared.filter(F.col("sharing") > CROWDED), F.lit(None).cast("long")
    meet = (
        index.join(shared.filter(F.col("sharing") <= CROWDED), "key").join(probe, "key").filter(OTHER).select("a", "b")
        .union(index.join(crowded, "key", "left_semi").select("a", none))
        .union(probe.join(crowded, "key", "left_semi").select("b", none))
    )
    meet = stored(meet.select(F.least("a", "b").alias("a"), F.when(F.col("b").isNotNull(), F.greatest("a", "b")).alias("b")).distinct(), "line-meetings")
    pairs = meet.filter("b IS NOT NULL")
    close = some.join(small(meet.filter("b IS NULL").select(F.col("a").alias("h"))), "h", "left_semi")
    close = stored(close.select("h", "line", "size").repartition("h").distinct(), "line-close")
    close = close.repartition("h")
    filed, asked = (keyed(close, keys(line, size, edits), name) for keys, name in ((finer_index_keys, "a"), (finer_probe_keys, "b")))
    pair = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    differ = f"{OTHER} AND (a_x IS NULL OR (a_x != b_x AND a_y != b_y))"
    if edits == 2:
        # Keys that many lines share are those of templates; there all pairs of a key would be too many.
        templates = filed.groupBy("key").agg(F.count(F.lit(1)).alias("sharing")).filter(F.col("sharing") > CROWDED)
        templates = small(stored(templates.select("key"), "line-crowded"))
        filed = filed.join(templates, "key", "left_anti")

        def left_out(keys: Column, name: str) -> DataFrame:
            rows = close.select(F.col("h").alias(name), F.explode(keys).alias("k"))
            rows = rows.select(name, "k.*").join(templates, "key", "left_semi")
            return rows.select(name, "key", *[F.col(c).alias(f"{name}_{c}") for c in ("less", "x", "y")])

        if not templates.isEmpty():
            filed_out = left_out(finer_index_keys(line, size, edits, whole=True), "a")
            pairs = pairs.union(template_pairs(filed_out, left_out(finer_probe_keys(line, size, edits, whole=True), "b")))
    finer = filed.join(asked, "key")
    pairs = stored(pairs.union(finer.filter(differ).select(*pair)).distinct(), "line-pairs")
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), "line-wanted")
    texts = some.join(small(wanted), "h", "left_semi").select("h", "g", "line").distinct()
    texts = stored(texts.join(table.select("h", "g", F.col("first").alias("since")), ["h", "g"]), "line-texts")
    one = texts.select(F.col("h").alias("a"), *[F.col(c).alias(f"a_{c}") for c in ("h", "g", "line", "since")])
    two = texts.select(F.col("h").alias("b"), *[F.col(c).alias(f"b_{c}") for c in ("h", "g", "line", "since")])
    both = pairs.join(one, "a").join(two, "b")
    both = _likely(both.filter(F.abs(F.char_length("a_line") - F.char_length("b_line")) <= edits), edits)
    near = edit_distances(both, "a_line", "b_line", edits).filter(F.col("edits_apart") <= edits)
    if least is None:
        shorter = F.least(F.char_length("a_line"), F.char_length("b_line"))
        near = near.filter(F.col("edits_apart") * EDIT_CHARS <= shorter)
    a_first = F.expr("a_since < b_since OR (a_since = b_since AND a_line < b_line)")
    later = F.when(a_first, F.struct(F.col("b_h").alias("h"), F.col("b_g").alias("g"))).otherwise(
        F.struct(F.col("a_h").alias("h"), F.col("a_g").alias("g"))
    )
    return near.select(later.alias("l")).select("l.h", "l.g").distinct()


def dropped_lines(
    df: DataFrame, edits: int = EDITS, least: int | None = LEAST_CHARS, text: str = "text"
) -> DataFrame:
    """`id`, `gone` (keys of the document's lines that an earlier line replaces) and `n_near` of them."""
    if least is not None and least <= edits:
        raise ValueError("lines must be longer than the number of edits")
    places = stored(_lines(df, text, least).select("id", "h", "g"), "line-places")
    table = places.groupBy("h", "g").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    table = stored(table, "line-table")
    near = stored(near_lines(df, table, places.count(), edits, least, text), "line-near")
    marked = table.join(near.withColumn("near", F.lit(True)), ["h", "g"], "left").select(
        "h", "g", "first", F.coalesce("near", F.lit(False)).alias("near")
    )
    # Both sides are scans, so that Spark can split the places of a line that is everywhere.
    found = places.join(stored(marked, "line-marked"), ["h", "g"]).filter("near OR first < id")
    gone = found.groupBy("id").agg(F.collect_set(F.struct("h", "g", "near")).alias("gone"))
    return gone.withColumn("n_near", F.size(F.filter("gone", lambda k: k["near"])).cast("long"))


def without_repeated_lines(
    df: DataFrame,
    edits: int = EDITS,
    least: int | None = LEAST_CHARS,
    text: str = "text",
    counts: tuple[str, ...] = (),
    by_row: bool = False,
) -> DataFrame:
    """The rows of `df`, all columns, with the text less its repeated lines.

    `counts` names columns to add: the lines, the lines removed, and the distinct lines removed for
    another line that is near.

    A line of at least `least` characters is removed if its text has it before, if a document of a
    smaller id has it, or if another line within `edits` edits comes before it: one whose smallest id
    is smaller or, that being equal, whose text is.  If `least` is None, every line with a letter or
    digit takes part, and EDIT_CHARS says how many edits a pair may have.  Lines are cut at line feeds.  Rows of one id
    count as one document for what comes before, a NULL id as the largest; every row stays, in the
    worst case with an empty text.  A NULL text stays NULL and has no line.

    With `by_row` every row is a document of its own, whatever its id: rows get a number that is written
    once, with the rows, and rows of one id or of none come in the order of that number.
    """
    names = df.columns
    plain = df.toDF(*[f"_c{i}" for i in range(len(names))])
    own, doc = f"_c{names.index(text)}", f"_c{names.index('doc_id')}"
    number = []
    if by_row:
        plain, number = stored(plain.withColumn("_row", F.monotonically_increasing_id()), "line-rows"), ["_row"]
    source = plain.select(plain[doc].alias("doc_id"), plain[own].alias("text"), *number)
    lost = stored(dropped_lines(source, edits, least), "line-dropped")
    joined = plain.withColumn("id", _ident(plain, doc)).drop(*number).join(lost, "id", "left")
    split = computed_once(joined, _all=F.split(F.col(own), "\n", -1))

    def entry(x: Column, i: Column) -> Column:
        long = _takes_part(x, least)
        h, g = _key(x)
        return F.struct(F.when(long, h).alias("h"), F.when(long, g).alias("g"), i.alias("i"))

    # Lost keys sort before the lines that have them, and a line's first place before its others:
    # whatever follows an equal key goes.
    first = F.transform(F.coalesce("gone", F.array()), lambda k: F.struct(k["h"], k["g"], F.lit(-1).alias("i")))
    ordered = computed_once(split, _order=F.array_sort(F.concat(first, F.transform(F.col("_all"), entry))))

    def again(e: Column, at: Column) -> Column:
        last = F.element_at("_order", F.greatest(at, F.lit(1)))
        return (at > 0) & (e["h"] == last["h"]) & (e["g"] == last["g"])

    removed = F.transform(F.filter("_order", lambda e, at: F.coalesce(again(e, at), F.lit(False))), lambda e: e["i"])
    known = computed_once(ordered, _out=removed)
    rest = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), "_out")
    kept = F.array_join(F.transform(rest, lambda i: F.element_at("_all", i + 1)), "\n")
    sizes = [F.when(F.col(own).isNull(), F.lit(0)).otherwise(F.size(c)).cast("long") for c in ("_all", "_out")]
    added = [*sizes, F.coalesce("n_near", F.lit(0).cast("long"))]
    columns = [kept if c == own else F.col(c) for c in plain.columns if c not in number] + added[: len(counts)]
    return known.select(*[c.alias(f"_c{i}") for i, c in enumerate(columns)]).toDF(*names, *counts)


def line_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    left = without_repeated_lines(docs, least=None, counts=("n_lines", "n_removed", "n_near"), by_row=True)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return left.select("doc_id", "n_lines", "n_removed", "n_near", digest.alias("kept_sha256"))


# The distance function of SQL counts bytes, so letters of two bytes are first given one each.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER (ORDER BY coalesce(doc_id, 9223372036854775807)) AS id, string_split(text, chr(10)) AS l
  FROM documents),
p AS (SELECT id, i, l[i] AS line FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM d)),
o AS (SELECT DISTINCT id, line FROM p WHERE regexp_matches(line, '[\p{L}\p{N}]')),
t AS (
  SELECT line, min(id) AS since, length(line) AS n,
         translate(line, 'äöüßàâçéèêëîôûùñáíóúÄÖÜÇÉÈÊÑÍÓ', array_to_string([chr(x::INTEGER) for x in range(1, 32) if x <> 10], '')) AS flat
  FROM o GROUP BY line),
near AS (
  SELECT DISTINCT b.line FROM (SELECT *, unnest(range(n - 2, n + 3)) AS m FROM t WHERE n >= 15) AS a JOIN t AS b ON a.m = b.n
  WHERE b.n >= 15 AND (a.since < b.since OR (a.since = b.since AND a.line < b.line))
    AND levenshtein(a.flat, b.flat) <= least(2, a.n // 15, b.n // 15)),
m AS (SELECT t.line, since, near.line IS NOT NULL AS near FROM t LEFT JOIN near USING (line)),
r AS (
  SELECT p.id, i, line,
         m.line IS NOT NULL AND (near OR since < p.id OR row_number() OVER (PARTITION BY p.id, line ORDER BY i) > 1) AS gone
  FROM p LEFT JOIN m USING (line)),
s AS (
  SELECT id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS kept
  FROM r GROUP BY id),
c AS (SELECT id, count(*) AS n FROM o JOIN m USING (line) WHERE near GROUP BY id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(c.n, 0) AS n_near,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (id) LEFT JOIN c USING (id)
"""
