"""Benchmark decontamination by templates.

Texts and benchmark items become templates: numbers, names (capitalised words inside a sentence) and
units turn into typed placeholders, other words are lower-cased and lose punctuation at their ends.
A capitalised word that may open a sentence (after its end, or first in a line) is read both ways, as
name and as literal, on both sides; an item's window counts once, whichever reading hits.
Windows of ``WINDOW`` template words are joined by hash. A question asked again with other
parameters has the same templates; its slots must also be filled consistently, so that equal values
of the item are equal in the text and different ones differ. Within a window that holds exactly if
both have the same pattern of first occurrences, which is part of the join key. Over all windows that a
document shares with an item, one mapping of the item's values to the text's must hold: windows that
contradict it are taken off those that agree, see ``agreeing_windows``. Windows that are the item's word
for word need no mapping.

A document is contaminated if it holds at least ``COVERAGE`` of an item's windows. A window counts
for all items that have it; items of the same windows and the same recurring values are judged once, as a
group.

Documents' windows are first asked of a bitmap of fixed size; few others than real hits leave a task.
These meet the items' windows by broadcast, or, of a large benchmark, through salted keys, so a window
that many documents or items have is no hot key.

Defined cases: null and empty texts are clean; an item of fewer than ``WINDOW`` words is one window
of its own length; windows with fewer than ``LEAST_LITERALS`` literal words are not used. An item of
fewer than ``LEAST_WORDS`` words or without a usable window is found by its whole sequence of words
or, in scripts without spaces, of characters; one of a single word or character only where it is a whole
line, one without words never. Very long texts are read whole.
Further cases: a row with a null doc_id is clean; rows that share a
doc_id are judged together; empty tables give empty or clean results; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.frames import without_ids
from skyloom.llm.text import LOWER, SEPARATOR, Words, mix, slabs, span_hashes, window_sums, window_weights, windows, words_of
from skyloom.session import store

WINDOW, LEAST_WORDS, LEAST_LITERALS = 8, 5, 4
COVERAGE = 0.5
#: What a code stands for: a template window, or an item's whole sequence of words or characters.
TEMPLATE, SEQUENCE, CHARACTERS = 0, 1, 2
BITMAP_BITS = 1 << 26
#: Rows of the items' windows up to which they are broadcast, some hundred bytes each.
BROADCAST_WINDOWS = 200_000
SALTS = 16
#: Words by which a copy may shift against the item before it counts as another copy.
SLACK = 8
#: Readings of windows that are held at once.
BLOCK_READINGS = 1 << 18

# Unit words.
UNITS = (
    "mm cm dm m km inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "mg g kg gram grams kilogram kilograms ton tons pound pounds lb lbs ounce ounces oz ml l liter liters litre "
    "litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month "
    "months year years usd eur gbp dollar dollars cent cents euro euros percent degree degrees celsius "
    "fahrenheit kelvin hz khz mhz watt watts kw volt volts joule joules mph kmh"
).split()

_DIGIT, _UPPER, _PUNCT, _ENDS = (np.zeros(256, dtype=bool) for _ in range(4))
_DIGIT[0x30:0x3A] = True
_UPPER[0x41:0x5B] = True
_PUNCT[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
_ENDS[[ord(c) for c in ".!?:"]] = True
_NUMBER, _NAME, _UNIT = (np.uint64(c) for c in (0x6E756D, 0x6E616D65, 0x756E6974))


def _unit_codes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), dtype=np.uint8)
    ends = np.append(np.flatnonzero(data == 0x20), len(data))
    starts = np.concatenate([[0], ends[:-1] + 1])
    return np.sort(span_hashes(data, starts, ends))


def template(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word its template code, the hash of its own value, whether it is a placeholder, and
    whether it may be a name as well: a capitalised word that may open a sentence, here a literal."""
    data, s, e = words.data, words.starts.copy(), words.ends.copy()
    if not len(s):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, bool)
    ended = _ENDS[data[e - 1]]
    while (trim := (s < e) & _PUNCT[data[np.minimum(s, len(data) - 1)]]).any():
        s[trim] += 1
    while (trim := (s < e) & _PUNCT[data[e - 1]]).any():
        e[trim] -= 1
    value = span_hashes(LOWER[data], s, e)
    head = data[np.minimum(s, len(data) - 1)]
    second = data[np.minimum(s + 1, len(data) - 1)]
    number = (s < e) & _DIGIT[head]
    lines = np.concatenate([[0], np.cumsum(data == 0x0A)])[words.starts]
    opens = np.ones(len(s), dtype=bool)
    opens[1:] = ended[:-1] | (lines[1:] != lines[:-1])
    opens[words.first[:-1][np.diff(words.first) > 0]] = True
    latin = (head == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    capital = (_UPPER[head] & (e - s > 1) & ~_UPPER[second]) | latin
    titled = capital & ~opens
    known = _unit_codes()
    unit = known[np.minimum(np.searchsorted(known, value), len(known) - 1)] == value
    code = value.copy()
    code[titled], code[unit], code[number] = _NAME, _UNIT, _NUMBER
    return code, value, number | titled | unit, capital & opens & ~unit & ~number


def window_codes(words: Words, lengths: Sequence[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, "Slots"]]:
    """For each length, in blocks: starts of the usable windows, the words of each that are read as
    names though they may open a sentence (bits), template hashes, and slots. A window comes once for
    each choice of such words; the one with none is its plain reading."""
    code, value, slot, either = template(words)
    literal = np.concatenate([[0], np.cumsum(~slot)])
    open_words = np.concatenate([[0], np.cumsum(either)])
    mixed = mix(code)
    as_name = mix(np.full(1, _NAME)) - mixed
    for n in lengths:
        at, sums = window_sums(mixed, words.first, n)
        least = min(LEAST_LITERALS, n)
        enough = literal[at + n] - literal[at] >= least
        at, sums = at[enough], sums[enough]
        weight = window_weights(n)
        readings = np.cumsum(1 << (open_words[at + n] - open_words[at]))
        cuts = [0, *(np.flatnonzero(np.diff(readings // BLOCK_READINGS)) + 1), len(at)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            a, h = at[low:high], sums[low:high]
            names = np.zeros(len(a), dtype=np.int64)
            spare = literal[a + n] - literal[a] - least
            for j in range(n):
                more = np.flatnonzero(either[a + j] & (spare > 0))
                if len(more):
                    h = np.concatenate([h, h[more] + as_name[a[more] + j] * weight[j]])
                    names = np.concatenate([names, names[more] | (1 << j)])
                    spare = np.concatenate([spare, spare[more] - 1])
                    a = np.concatenate([a, a[more]])
            yield n, a, names, mix(mix(h) + np.uint64(n)), Slots(value, slot)


class Slots:
    def __init__(self, value: np.ndarray, slot: np.ndarray) -> None:
        self.value, self.slot = value, slot

    def with_pattern(self, at: np.ndarray, names: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
        """Template hashes joined with the pattern in which slot values recur: for each slot the
        number of the first slot of the window with its value."""
        out = h
        slots = [self.slot[at + j] | (names >> j & 1 == 1) for j in range(n)]
        for j in range(n):
            first = np.full(len(at), j, dtype=np.uint64)
            for k in range(j - 1, -1, -1):
                same = slots[k] & (self.value[at + k] == self.value[at + j])
                first[same] = k
            out = np.where(slots[j], mix(out ^ (first + np.uint64(1))), out)
        return out


    def values(self, at: np.ndarray, names: np.ndarray, n: int) -> pa.Array:
        """What fills the slots of each window, in their order."""
        places = at[:, None] + np.arange(n)
        slots = self.slot[places] | (names[:, None] >> np.arange(n) & 1 == 1)
        bounds = np.concatenate([[0], np.cumsum(slots.sum(axis=1))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(self.value[places][slots].view(np.int64)))


def _no_values(n: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, dtype=np.int32)), pa.array(np.zeros(0, dtype=np.int64)))


def _shapes(words: Words) -> np.ndarray:
    """Per text a code of the order in which the values of its slots recur."""
    _, value, slot, either = template(words)
    filled = slot | either
    out = np.zeros(len(words.first) - 1, dtype=np.int64)
    for k, (a, z) in enumerate(zip(words.first, words.first[1:], strict=False)):
        own = value[a:z][filled[a:z]]
        _, first, which = np.unique(own, return_index=True, return_inverse=True)
        out[k] = zlib.crc32(np.argsort(np.argsort(first))[which].tobytes()) if len(own) else 0
    return out


def _whole_lines(units: Words, at: np.ndarray, n: int) -> np.ndarray:
    """Which of the runs of ``n`` words or characters fill a line each."""
    line = np.cumsum(units.data == 0x0A)[units.starts] if len(units.data) else np.zeros(0, dtype=np.int64)
    line = line + units.doc * (len(units.data) + 1)  # a new text is a new line
    before = np.concatenate([[-1], line])[at]
    after = np.concatenate([line, [-1]])[at + n]
    return (line[at] != before) & (line[at + n - 1] != after) & (line[at] == line[at + n - 1])


def _unspaced(data: np.ndarray) -> np.ndarray:
    """Whether a character of a script without spaces starts at each byte: Han, kana, Thai, Lao,
    Burmese, Khmer."""
    second = np.append(data[1:], np.uint8(0))
    han = ((data >= 0xE4) & (data <= 0xE9)) | ((data == 0xE3) & (second > 0x80)) | ((data == 0xF0) & (second >= 0xA0))
    thai = (data == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    return han | thai | ((data == 0xE1) & (((second >= 0x80) & (second <= 0x82)) | (second == 0x9E) | (second == 0x9F)))


def _characters(data: np.ndarray, bounds: np.ndarray) -> Words:
    """Characters as words, without blanks and the punctuation of ASCII and of Han scripts."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    ends = np.append(starts[1:], len(data))
    head, second, third = (data[np.minimum(starts + k, len(data) - 1)] for k in range(3))
    wide = (head == 0xEF) & (second == 0xBC) & ((third <= 0x8F) | ((third >= 0x9A) & (third <= 0xA0)))
    skip = SEPARATOR[head] | _PUNCT[head] | ((head == 0xE3) & (second == 0x80)) | ((head == 0xE2) & (second == 0x80)) | wide
    starts, ends = starts[~skip], ends[~skip]
    return Words(data, bounds, starts, ends, np.searchsorted(starts, bounds))


def _exact(units: Words, value: np.ndarray, kind: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    at, h = windows(mix(value), units.first, n)
    return at, mix(h ^ np.uint64((kind << 56) + n))


def _whole_codes(texts: pa.Array, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items, their number of words or characters, and the code of that whole sequence."""
    words = words_of(texts)
    if kind == CHARACTERS:
        words = _characters(words.data, words.bounds)
        told = np.concatenate([[0], np.cumsum(_unspaced(words.data))])
        fits = told[words.bounds[1:]] > told[words.bounds[:-1]]
        value = span_hashes(LOWER[words.data], words.starts, words.ends)
    else:
        value = template(words)[1]
        told = np.concatenate([[0], np.cumsum(value != 0)])  # 0: nothing but punctuation
        fits = told[words.first[1:]] > told[words.first[:-1]]
    size = np.diff(words.first)
    found: tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]] = ([np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)])
    for n in np.unique(size[fits & (size > 0)]):
        item = np.flatnonzero(fits & (size == n))
        at, h = _exact(words, value, kind, int(n))
        code = h[np.searchsorted(at, words.first[item])]
        for out, x in zip(found, (item, np.full(len(item), n), code), strict=True):
            out.append(x)
    item, n, code = (np.concatenate(x) for x in found)
    return item, n, code


_ITEM = ["item_id", "kind", "n", "template", "code", "window", "at", "shape", "values"]


def _item_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All readings of the items' windows; ``window`` is the code of the plain one, ``at`` its first word.
    Items of up to ``WINDOW`` words, and those without a usable window, also come as their whole sequence."""
    for batch in slabs(batches):
        words = words_of(batch.column("text"))
        size = np.diff(words.first)
        doc_of = words.doc
        shape = _shapes(words)

        def rows(doc: np.ndarray, kind: int, n: np.ndarray, *codes: np.ndarray, at: np.ndarray, values: pa.Array, batch: pa.RecordBatch = batch, shape: np.ndarray = shape) -> pa.RecordBatch:
            columns = [batch.column("item_id").take(pa.array(doc)), pa.array(np.full(len(doc), kind, dtype=np.int32)), pa.array(n.astype(np.int32))]
            columns += [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in codes]
            return pa.RecordBatch.from_arrays([*columns, pa.array(at.astype(np.int64)), pa.array(shape[doc]), values], _ITEM)

        window = np.zeros(len(size), dtype=np.uint64)
        usable = np.zeros(len(size), dtype=bool)
        for n, at, names, h, slots in window_codes(words, range(LEAST_WORDS, WINDOW + 1)):
            doc = doc_of[at]
            mine = (size[doc] == n) | (n == WINDOW)
            at, names, h, doc = at[mine], names[mine], h[mine], doc[mine]
            code = slots.with_pattern(at, names, h, n)
            plain = np.zeros(len(doc_of), dtype=np.uint64)
            plain[at[names == 0]] = code[names == 0]
            usable[doc], window[doc] = True, plain[at]
            yield rows(doc, TEMPLATE, np.full(len(at), n), h, code, plain[at], at=at - words.first[doc], values=slots.values(at, names, n))
        for kind in (SEQUENCE, CHARACTERS):
            item, n, code = _whole_codes(batch.column("text"), kind)
            if kind == SEQUENCE:
                window[item[~usable[item]]] = code[~usable[item]]
            short = ~usable[item] | (size[item] <= WINDOW)
            item, n, code = item[short], n[short], code[short]
            yield rows(item, kind, n, code, code, window[item], at=np.zeros(len(item)), values=_no_values(len(item)))


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _item_codes(batches):
        yield batch.filter(pc.equal(batch.column("kind"), TEMPLATE)).select(["item_id", "n", "template", "code"])


def agreeing_windows(windows_: list[int], item_at: list[int], text_at: list[int], item_values: list[list[int]], text_values: list[list[int]]) -> int:
    """How many of an item's windows a text holds with its slots filled consistently.

    Each place where the item may have been copied to gives a mapping of the item's values to the text's,
    one to one: first from the windows at that very place, in their order, then from the others, the
    nearest first. A window agrees if its values do. Windows near that place which hold the item's words
    and contradict the mapping are taken off the agreeing ones. The best place counts, or the number of
    windows that are the item's own, values included, if that is higher.
    """
    own = len({w for w, a, b in zip(windows_, item_values, text_values, strict=True) if a == b})
    shift = [t - i for t, i in zip(text_at, item_at, strict=True)]
    best, every = own, len(set(windows_))
    for place in sorted(set(shift)):
        if best == every:
            break
        there, back, agree, contrary = {}, {}, set(), set()
        for k in sorted(range(len(shift)), key=lambda k: (abs(shift[k] - place), text_at[k], item_at[k])):
            pairs = list(zip(item_values[k], text_values[k], strict=True))
            if all(there.get(a, b) == b and back.get(b, a) == a for a, b in pairs):
                there.update(pairs)
                back.update((b, a) for a, b in pairs)
                agree.add(windows_[k])
            elif abs(shift[k] - place) <= SLACK:
                contrary.add(windows_[k])
        best = max(best, len(agree) - len(contrary - agree))
    return best


def _judge_pairs(key: tuple, table: pa.Table) -> pa.Table:
    part = {c: table.column(c).to_pylist() for c in ("window", "item_at", "at", "item_values", "values", "part")}
    # Texts of rows that share a doc_id follow each other from afar.
    first = {t: k << 40 for k, t in enumerate(sorted(set(part["part"])))}
    at = [a + first[t] for a, t in zip(part["at"], part["part"], strict=True)]
    found = agreeing_windows(part["window"], part["item_at"], at, part["item_values"], part["values"])
    kinds = [table.schema.field(c).type for c in ("doc_id", "group")]
    return pa.table({"doc_id": pa.array([key[0].as_py()], kinds[0]), "group": pa.array([key[1].as_py()], kinds[1]), "n_windows": pa.array([found], pa.int64())})


def _bitmap(items: DataFrame) -> np.ndarray:
    place = F.pmod("template", F.lit(BITMAP_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    words = items.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    bits = np.zeros(BITMAP_BITS // 64, dtype=np.int64)
    for row in words.collect():
        bits[row["word"]] = row["bits"]
    return bits


def _met(found: DataFrame, held: DataFrame) -> DataFrame:
    """Documents' windows with the items' windows of the same code. Either side may have a code often."""
    if held.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS:
        return found.join(F.broadcast(held), "code")
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "at"), F.lit(SALTS)))
    every = held.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(every, ["code", "_salt"]).drop("_salt")


def _group_hits(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id, group, size, n_windows, share of every group that a document covers far enough, and
    the items of each group. Items of the same windows and recurring values are a group, named by the
    smallest of them."""
    spark = docs.sparkSession
    windows_of_items = benchmark.select("item_id", "text").filter(F.col("item_id").isNotNull())
    kind = dict(benchmark.dtypes)["item_id"]
    items = store(windows_of_items.mapInArrow(_item_codes, f"item_id {kind}, kind int, n int, template long, code long, window long, at long, shape long, values array<long>"))
    members = store(items.groupBy("item_id").agg(F.sort_array(F.collect_set(F.struct("window", "code"))).alias("codes"), F.max("shape").alias("shape")))
    groups = store(members.groupBy("codes", "shape").agg(F.min("item_id").alias("group"), F.count("*").alias("size")))
    held = store(
        items.join(groups.select(F.col("group").alias("item_id"), F.col("group")), "item_id")
        .select("group", "code", "window", F.col("at").alias("item_at"), F.col("values").alias("item_values"))
        .distinct()
    )
    total = groups.select("group", "size", F.size(F.array_distinct("codes.window")).alias("of"))
    asked_for = sorted((r["kind"], r["n"]) for r in items.select("kind", "n").distinct().collect())
    lengths = {k: [n for kind, n in asked_for if kind == k] for k in (TEMPLATE, SEQUENCE, CHARACTERS)}
    bitmap = spark.sparkContext.broadcast(_bitmap(items))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value

        def known_to(h: np.ndarray) -> np.ndarray:
            place = (h % np.uint64(BITMAP_BITS)).astype(np.int64)
            return (bits[place >> 6] >> (place & 63)) & 1 == 1

        for batch in slabs(batches):
            words = words_of(batch.column("text"))

            def rows(units: Words, at: np.ndarray, code: np.ndarray, values: pa.Array, batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                doc = units.doc[at]
                ids = [batch.column(c).take(pa.array(doc)) for c in ("doc_id", "part")]
                return pa.RecordBatch.from_arrays([*ids, pa.array(at - units.first[doc]), pa.array(code.view(np.int64)), values], ["doc_id", "part", "at", "code", "values"])

            for n, at, names, h, slots in window_codes(words, lengths[TEMPLATE]):
                hit = known_to(h)
                at, names, h = at[hit], names[hit], h[hit]
                if len(at):
                    yield rows(words, at, slots.with_pattern(at, names, h, n), slots.values(at, names, n))
            for k in (SEQUENCE, CHARACTERS):
                if not lengths[k] or (k == CHARACTERS and not _unspaced(words.data).any()):
                    continue
                units = words if k == SEQUENCE else _characters(words.data, words.bounds)
                value = template(units)[1] if k == SEQUENCE else span_hashes(LOWER[units.data], units.starts, units.ends)
                for n in lengths[k]:
                    at, h = _exact(units, value, k, n)
                    hit = known_to(h)
                    if n == 1:
                        hit[hit] = _whole_lines(units, at[hit], n)
                    if hit.any():
                        yield rows(units, at[hit], h[hit], _no_values(int(hit.sum())))

    known = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("part"), "text")
    id_kind = dict(docs.dtypes)["doc_id"]
    found = known.mapInArrow(asked, f"doc_id {id_kind}, part long, at long, code long, values array<long>")
    met = store(_met(found, held))
    pair = ["doc_id", "group"]
    most = met.groupBy(*pair).agg(F.count_distinct("window").alias("n_windows"), F.max(F.size("item_values")).alias("slots"))
    able = store(most.join(total, "group").filter(F.col("n_windows") / F.col("of") >= COVERAGE))
    # Slots are compared only where enough windows hit at all.
    open_ = met.join(able.filter("slots > 0").select(*pair), pair, "left_semi")
    judged = open_.groupBy(*pair).applyInArrow(_judge_pairs, f"doc_id {id_kind}, group {kind}, n_windows long")
    settled = able.filter("slots = 0").select(*pair, "n_windows").unionByName(judged)
    share = settled.join(total, "group").withColumn("share", F.col("n_windows") / F.col("of"))
    return share.filter(F.col("share") >= COVERAGE).select("doc_id", "group", "size", "n_windows", "share"), members.join(groups, ["codes", "shape"]).select("group", "item_id")


def benchmark_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows, share of every item that a document covers far enough."""
    hits, members = _group_hits(docs, benchmark)
    return hits.join(members, "group").select("doc_id", "item_id", "n_windows", "share")


def mark_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items and first_item (the smallest covered one) for every row."""
    hits = _group_hits(docs, benchmark)[0].groupBy(F.col("doc_id").alias("_id")).agg(F.sum("size").alias("n_items"), F.min("group").alias("first_item"))
    marked = docs.select("doc_id").join(hits, F.col("doc_id") == F.col("_id"), "left")
    return marked.select("doc_id", F.col("_id").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "first_item")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that cover no item of the benchmark."""
    return without_ids(docs, store(_group_hits(docs, benchmark)[0].select("doc_id").distinct()))
