"""URL rules through a cascade of Bloom filters.

The keys a rule list can be asked about are the host suffixes and path prefixes of the corpus's own
urls: a finite universe. Level 0 encodes the listed keys, level 1 the universe keys that level 0
lets through by mistake, level 2 the listed keys that level 1 lets through, and so on until no
mistake is left. A key of the universe is listed exactly if the first level that stops it has an
odd number. Keys are known by 128 bits of hash. Answering needs no join and moves no row.

Defined cases: a null url or one without ``://`` has an empty host and path; no rule fits an empty
path; equal longest rules are one rule, as a rule may be listed once; repeated rows are judged each;
a very long host or path is asked about whole, by as many suffixes and prefixes as rules can fit; an empty page table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.text import mix
from skyloom.session import cut_lineage

#: Levels are sent to every task, so each is held below this size; a longer list is refused.
MAX_LEVEL_BITS = 1 << 26
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Level:
    bits: np.ndarray
    size: int
    hashes: int
    salt: int  # levels must not share a hash function, or a mistake could last for ever

    def places(self, one: np.ndarray, two: np.ndarray) -> Iterator[np.ndarray]:
        """Bits of each key, one array per hash function."""
        for i in range(self.hashes):
            yield mix(one ^ mix(two + np.uint64(64 * self.salt + i))) % np.uint64(self.size)

    def passes(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        ok = np.ones(len(one), dtype=bool)
        for at in self.places(one, two):
            ok &= (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return ok


@dataclass
class Cascade:
    levels: list[Level]

    def listed(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Which of the universe's keys, given as two hashes each, are listed."""
        stopped = np.full(len(one), len(self.levels))
        alive = np.arange(len(one))
        for number, level in enumerate(self.levels):
            through = level.passes(one[alive], two[alive])
            stopped[alive[~through]] = number
            alive = alive[through]
        return stopped % 2 == 1


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def asked_keys(host: Column, path: Column, path_lengths: Sequence[int]) -> Column:
    """Every rule that could fit: the host's suffixes at dots, each with the path's first
    characters in the lengths that rules have."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = [F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in path_lengths]
    heads = F.array_compact(F.array(*prefixes)) if prefixes else F.array().cast("array<string>")
    return F.flatten(F.transform(suffixes, lambda s: F.transform(heads, lambda h: F.concat(s, h))))


def pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The two hashes of each key; in a list column, of each key of all rows."""
    columns = (batch.column(c) for c in ("one", "two"))
    flat = [c.flatten() if pa.types.is_list(c.type) else c for c in columns]
    return tuple(c.to_numpy(zero_copy_only=False).astype(np.uint64) for c in flat)


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit(1))


def _level(keys: DataFrame, count: int, rate: float, salt: int) -> Level:
    """Encode the keys (columns one, two). Tasks combine the bits before the driver sees them, and
    their number has a bound."""
    size = max(64, math.ceil(count * math.log2(1 / rate) / math.log(2)))
    if size > MAX_LEVEL_BITS:
        raise ValueError(f"{count} keys need {size} bits in one filter; at most {MAX_LEVEL_BITS} are sent to tasks")
    level = Level(np.zeros(-(-size // 64), dtype=np.uint64), size, max(1, round(math.log2(1 / rate))), salt)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(list(level.places(*pairs(batch)))))
            first = np.flatnonzero(np.diff(at >> np.uint64(6), prepend=np.uint64(2**63)))
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array((at[first] >> np.uint64(6)).astype(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

    merged = keys.mapInArrow(encode, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    for row in merged.collect():
        level.bits[row["word"]] = np.uint64(row["bits"] & (2**64 - 1))
    return level


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.passes(*pairs(batch))))

    return keys.mapInArrow(keep, keys.schema)


def build_cascade(universe: DataFrame, listed: DataFrame) -> Cascade:
    """Cascade over the universe (column key) for the listed keys (column key). Level 0 errs about
    as often as there are listed keys, so every level is about as large as the list, however large
    the universe is."""
    one, two = (h.alias(n) for h, n in zip(_hashes(F.col("key")), ("one", "two"), strict=True))
    inside = cut_lineage(listed.select("key", one, two).distinct())
    count = inside.count()
    if not count:
        return Cascade([])
    asked = universe.agg(F.approx_count_distinct("key")).first()[0]
    levels = [_level(inside, count, min(0.5, max(2.0**-32, count / max(1, asked))), 0)]
    mistaken = _passing(universe.select("key", one, two), levels[0]).join(inside.select("key"), "key", "left_anti").distinct()
    this, other = cut_lineage(mistaken), inside
    while count := this.count():
        levels.append(_level(this, count, 0.5, len(levels)))
        this, other = cut_lineage(_passing(other, levels[-1])), this
    return Cascade(levels)


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], unlisted: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every page; ``rules`` are (verdict, host/path). A
    rule fits its host and all subdomains where the url's path starts with the rule's, and the
    longest wins; where none fits the verdict is ``unlisted``."""
    spark = pages.sparkSession
    verdicts = {rule: verdict for verdict, rule in rules}
    lengths = sorted({len(rule) - rule.index("/") for rule in verdicts})
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    asked = parsed.withColumn("keys", asked_keys(F.col("host"), F.col("path"), lengths))
    listed = spark.createDataFrame([(r,) for r in verdicts], "key string")
    cascade = spark.sparkContext.broadcast(build_cascade(asked.select(F.explode("keys").alias("key")), listed))

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("keys")
            flat = keys.flatten()
            found = np.flatnonzero(cascade.value.listed(*pairs(batch)))
            row = np.repeat(np.arange(len(keys)), np.diff(keys.offsets.to_numpy()))[found]
            best: list[str | None] = [None] * len(keys)
            for r, key in zip(row.tolist(), flat.take(pa.array(found)).to_pylist(), strict=True):
                if best[r] is None or len(key) > len(best[r]):
                    best[r] = key
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "host", "path")), pa.array(best, pa.string())], ["page_id", "host", "path", "rule"])

    hashed = asked.withColumns({"one": F.transform("keys", lambda k: _hashes(k)[0]), "two": F.transform("keys", lambda k: _hashes(k)[1])})
    judged = hashed.mapInArrow(longest, f"page_id {dict(pages.dtypes)['page_id']}, host string, path string, rule string")
    verdict = F.lit(unlisted)
    for name, word in verdicts.items():
        verdict = F.when(F.col("rule") == name, word).otherwise(verdict)
    return judged.withColumn("verdict", verdict)
