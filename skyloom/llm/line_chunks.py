"""Line dedup by content-defined line chunks, in DataFrame functions throughout.

A rolling hash over the hashes of the last ``WINDOW`` lines makes a line a boundary or not; as it looks
at nothing else, a passage has the same boundaries wherever it stands. A chunk runs from one boundary to
the next, both included, so it is always closed by its own content; a text's first and last lines with a
word close a chunk as well. Boundaries are as frequent as ``HITS`` in ``OF``, blank lines are none.

Chunks of two or more lines that stand in several places are found by hash first. Each stays at its first
place (smallest doc_id, then position) and goes elsewhere, once the lines of the repeated ones are compared
byte by byte: each task brings one copy of a line, and a chunk with a line whose 128-bit code belongs to
different bytes stays. From a chunk a match is carried on line by line, up to the next boundary on either
side, as far as the lines there are the ones at the first place. Thus a repeated passage with two boundaries
in it goes from its first to its last line, whatever is around it. What stays: passages with fewer (shares
are in the README), single lines, and a chunk that overlaps its own first place.

Only hashes and places are shuffled for all lines. Documents move if they lose a line, by id; a chunk
that countless documents share is joined to its few facts without moving them.

Defined cases: null and empty texts lose nothing; rows with a null doc_id keep everything and shield
nothing; rows that share a doc_id are one document's parts in the order of their texts' hashes, equal rows
count once (each gets the same answer); very long texts are cut whole; an empty table gives an empty
result; a column named _removed is replaced, other columns stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.frames import join_totals, let, sieve_of, sieved
from skyloom.session import cut_lineage, store

#: Lines that the rolling hash sees, and the share of lines that are boundaries.
WINDOW, HITS, OF = 1, 15, 16


def line_hash(line: Column, salt: int = 0) -> Column:
    return F.xxhash64(F.lit(salt), line)


def line_hashes(lines: Column, salt: int = 0) -> Column:
    return F.transform(lines, lambda x: line_hash(x, salt))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _word_lines(lines: Column) -> Column:
    """Indexes of the lines with a word."""
    return F.filter(F.transform(lines, lambda x, i: F.when(F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")), i)), lambda i: i.isNotNull())


def boundaries(hashes: Column, worded: Column) -> Column:
    """Those of the lines ``worded`` at which the rolling hash hits."""

    def hit(i: Column) -> Column:
        rolled = F.xxhash64(*[F.get(hashes, i - k) for k in range(WINDOW)])
        return F.pmod(rolled, F.lit(OF)) < HITS

    return F.filter(worded, hit)


def chunks(hashes: Column, worded: Column) -> Column:
    """The chunks of a text: at and to (first and last line), low and high (the boundary before and
    after it, or the text's ends)."""

    def chunk(cuts: Column, ends: Column, at: Column, k: Column) -> Column:
        # The first and the last of the ends need not be boundaries.
        last = F.size(ends) - 1
        before = F.when((k > 1) | ((k == 1) & (F.get(cuts, F.lit(0)) == F.get(ends, F.lit(0)))), F.get(ends, k - 1))
        after = F.when((k + 2 < last) | ((k + 2 == last) & (F.element_at(cuts, -1) == F.get(ends, last))), F.get(ends, k + 2))
        return F.struct(
            at.alias("at"), F.get(ends, k + 1).alias("to"),
            F.coalesce(before, F.lit(-1)).alias("low"), F.coalesce(after, F.size(hashes)).alias("high"),
        )

    def closed(cuts: Column) -> Column:
        first, last = F.slice(worded, 1, 1), F.slice(worded, F.greatest(F.size(worded), F.lit(1)), 1)
        return let(
            F.array_distinct(F.concat(first, cuts, last)),
            lambda ends: F.transform(F.slice(ends, 1, F.greatest(F.size(ends) - 1, F.lit(0))), lambda at, k: chunk(cuts, ends, at, k)),
        )

    return let(boundaries(hashes, worded), closed)


def _between(values: Column, low: Column, high: Column) -> Column:
    """Values after ``low`` and before ``high``."""
    return F.slice(values, low + 2, F.greatest(high - low - 1, F.lit(0)))


def _own(values: Column, c: Column) -> Column:
    return F.slice(values, c["at"] + 1, c["to"] - c["at"] + 1)


def _split(docs: DataFrame) -> DataFrame:
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return known.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("part"), _lines(F.col("text")).alias("lines"))


def _cut(docs: DataFrame, facts: Callable[[Column, Column], Column]) -> DataFrame:
    """One row per chunk: id, part, and the fields of ``facts``, an array of structs made of a text's
    line hashes and chunks. Only what is asked for leaves the text."""

    def every(hashes: Column) -> Column:
        return let(let(_word_lines(F.col("lines")), lambda w: chunks(hashes, w)), lambda found: facts(hashes, found))

    return _split(docs).select("id", "part", F.inline(let(line_hashes(F.col("lines")), every)))


def _hash(hashes: Column, c: Column) -> Column:
    return F.xxhash64(_own(hashes, c)).alias("hash")


def _only_hashes(hashes: Column, found: Column) -> Column:
    return F.transform(found, lambda c: F.struct(_hash(hashes, c)))


def _with_lines(hashes: Column, found: Column) -> Column:
    return F.transform(found, lambda c: F.struct(_hash(hashes, c), c["at"].alias("at"), _own(F.col("lines"), c).alias("own")))


def _with_places(hashes: Column, found: Column) -> Column:
    """Where a chunk is, a second hash of it, and two hashes of each line up to its neighbours."""

    def placed(checks: Column) -> Column:
        def side(c: Column, low: str, high: str, turn: Callable[[Column], Column]) -> Column:
            return F.struct(*[turn(_between(x, c[low], c[high])).alias(n) for n, x in (("one", hashes), ("two", checks))])

        return F.transform(
            found,
            lambda c: F.struct(
                _hash(hashes, c), F.xxhash64(_own(checks, c)).alias("check"), c["at"].alias("at"), c["to"].alias("to"),
                side(c, "low", "at", F.reverse).alias("before"), side(c, "to", "high", lambda x: x).alias("after"),
            ),
        )

    return let(line_hashes(F.col("lines"), 1), placed)


def _equal_lines(one: Column, two: Column) -> Column:
    """Number of leading lines in which two sequences agree by both hashes."""

    def leading(a: Column, b: Column) -> Column:
        agree = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
        return let(agree, lambda x: F.when(F.array_contains(x, False), F.array_position(x, False).cast("int") - 1).otherwise(F.size(x)))

    return F.least(leading(one["one"], two["one"]), leading(one["two"], two["two"]))


def _clashing(docs: DataFrame, sieve: DataFrame) -> DataFrame | None:
    """Chunks (id, part, at) with a line whose two hashes belong to different bytes, if there are any.
    This is where the lines of repeated chunks are compared."""
    asked = sieved(_cut(docs, _with_lines), sieve, F.col("hash")).filter("_maybe")
    lines = asked.select("id", "part", "at", F.explode("own").alias("line"))
    lines = lines.withColumns({"one": line_hash(F.col("line")), "two": line_hash(F.col("line"), 1)})
    met = lines.groupBy("one", "two").agg(F.min("line").alias("low"), F.max("line").alias("high"))
    told = cut_lineage(met.filter("low != high").select("one", "two"))
    return None if told.isEmpty() else lines.join(told, ["one", "two"]).select("id", "part", "at").distinct()


def repeated_lines(docs: DataFrame) -> DataFrame:
    """Lines to remove: id, part (hash of the text), gone (their indexes in order), for each document
    that loses any."""
    counted = _cut(docs, _only_hashes).groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1")
    sieve = sieve_of(counted, F.col("hash"))
    asked = sieved(_cut(docs, _with_places), sieve, F.col("hash")).filter("_maybe")
    spots = asked.select("id", "part", "at", "to", "before", "after", F.struct("hash", "check").alias("key"))
    clashing = _clashing(docs, sieve)
    if clashing is not None:
        spots = spots.join(clashing, ["id", "part", "at"], "left_anti")
    met = join_totals(store(spots, "chunks"), "key", {"first": F.min(F.struct("id", "part", "at", "to", "before", "after"))})
    moved = F.struct("id", "part", "at") != F.struct("first.id", "first.part", "first.at")
    beside = (F.col("first.id") == F.col("id")) & (F.col("first.part") == F.col("part")) & (F.col("at") <= F.col("first.to"))
    low = F.col("at") - _equal_lines(F.col("before"), F.col("first.before"))
    high = F.col("to") + _equal_lines(F.col("after"), F.col("first.after"))
    lost = met.filter(moved & ~beside).select("id", "part", F.struct(low.alias("low"), high.alias("high")).alias("span"))
    spans = lost.groupBy("id", "part").agg(F.collect_set("span").alias("spans"))
    every = F.flatten(F.transform("spans", lambda s: F.sequence(s["low"], s["high"])))
    return spans.select("id", "part", F.array_sort(F.array_distinct(every)).alias("gone"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: row (all its columns), kept (its text without repeated passages) and removed,
    the number of these. A text that lost nothing is as it was."""
    gone = store(repeated_lines(docs.select("doc_id", "text")))
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_part"))
    marked = sieved(packed, sieve_of(gone, F.xxhash64("id", "part")), F.xxhash64("_id", "_part"))
    asked = marked.filter("_maybe").join(gone, (F.col("_id") == F.col("id")) & (F.col("_part") == F.col("part")), "left")
    clear = marked.filter(~F.col("_maybe")).withColumn("gone", F.lit(None).cast("array<int>"))
    both = clear.select("row", "gone").unionByName(asked.select("row", "gone"))
    lost = F.col("gone").isNotNull()

    def left(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    runs = F.size(F.filter("gone", lambda i, k: (k == 0) | (F.get("gone", k - 1) != i - 1)))
    return both.select(
        "row",
        F.when(lost, let(_lines(F.col("row.text")), left)).otherwise(F.col("row.text")).alias("kept"),
        F.when(lost, runs).otherwise(0).cast("long").alias("removed"),
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, the text without its repeated passages, and ``_removed``, the
    number of these."""
    columns = [c for c in docs.columns if c != "_removed"]
    return without_repeats(docs).select(*[(F.col("kept") if c == "text" else F.col("row").getField(c)).alias(c) for c in columns], F.col("removed").alias("_removed"))
