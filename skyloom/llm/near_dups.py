"""Near-duplicate documents: banded MinHash with sequential Bayesian verification.

Texts become sets of word shingles. Documents of equal sets are one class from the start. Classes
that share a band of their MinHash signature are candidates; signatures are compared batch by batch
and a pair goes as soon as the posterior probability that its similarity reaches the threshold falls
below ``MISS``. What survives is compared on the full sets.

A bucket is not expanded into all its pairs. Its members meet one hub first; what links to the hub
is one component and needs no further comparison inside itself. Buckets that still hold several
components get another hub. What is open after ``HUB_ROUNDS`` falls into clusters around hubs. Inside
a cluster sets are compared block by block in a task, which writes out the links that join
components and no pairs. Blocks are dealt by the size of their sets, so only those meet whose sizes the
threshold allows, and signatures are compared as above before any set. Across clusters nodes meet where
they share one of their rarest shingles, which two sets of the asked similarity must. Members that
merely share a common passage are never written out as pairs, and none that could join two components
stays unasked. The first look at a pair, by one bit of each hash value, is part of the join's condition.

At a similarity of just the threshold a pair shares no band with probability (1 - 0.8^6)^40 = 5e-6.

Defined cases: a text with fewer words than a shingle is one shingle; one without words, or null,
has an empty set and links to nothing; a row with a null doc_id links to nothing, its component is
null and it is kept; rows that share a doc_id are judged each by its own text; very long texts
are one set each, read whole; an empty table gives an empty result; other columns are ignored. Sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.llm.components import components
from skyloom.llm.exchange import binaries, joined
from skyloom.llm.frames import sieve_of, sieved
from skyloom.llm.text import Words, mix, slabs, windows, word_hashes, words_of
from skyloom.session import scratch_scope, store

BANDS, ROWS = 40, 6
BATCH, MISS = 24, 1e-5
HUB_ROUNDS = 1
RARITY_CELLS = 1 << 16
BLOCK_NODES = 256
BITS = ["bits0", "bits1", "bits2", "bits3"]  # one bit of each hash value, 240 of 256 used
_CHUNK = 1 << 14
_random = np.random.default_rng(3)
_FACTORS = _random.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = _random.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64)


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted, and their bounds."""
    hashes = word_hashes(words)
    at, found = windows(hashes, words.first, n)
    doc = words.doc[at]
    size = np.diff(words.first)
    for k in range(1, n):  # the whole sequence of a shorter text
        whole, short = windows(hashes, words.first, k, salt=1)
        whole_doc = words.doc[whole]
        only = size[whole_doc] == k
        doc, found = np.concatenate([doc, whole_doc[only]]), np.concatenate([found, short[only]])
    order = np.lexsort((found, doc))
    doc, found = doc[order], found[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
    doc, found = doc[new], found[new]
    return found, np.searchsorted(doc, np.arange(len(size) + 1))


def set_codes(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit code of each set; 0 for the empty one."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(found), dtype=np.uint64)])
    size = np.diff(bounds)
    codes = mix(mix(sums[bounds[1:]] - sums[bounds[:-1]]) + size.astype(np.uint64))
    codes[size == 0] = 0
    return codes.view(np.int64)


def signatures(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Least value of each hash function over each set, none of them empty."""
    out = np.empty((len(bounds) - 1, BANDS * ROWS), dtype=np.uint64)
    at = 0
    while at < len(out):
        to = max(int(np.searchsorted(bounds, bounds[at] + _CHUNK, side="right")) - 1, at + 1)
        block, starts = found[bounds[at] : bounds[to]], bounds[at:to] - bounds[at]
        value = np.empty_like(block)
        for k in range(BANDS * ROWS):
            np.bitwise_xor(block, _MASKS[k], out=value)
            np.multiply(value, _FACTORS[k], out=value)
            out[at:to, k] = np.minimum.reduceat(value, starts)
        at = to
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    grouped = least.reshape(len(least), BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for k in range(ROWS):
        key = mix(key ^ grouped[:, :, k])
    return key.view(np.int64)


def _fewest(threshold: float, n: int, by_chance: float) -> int:
    """Of ``n`` compared values, the fewest equal ones at which the posterior probability (uniform
    prior) of a similarity of ``threshold`` or more is at least ``MISS``."""
    p = np.linspace(0, 1, 4001)[1:-1]
    agree = p + (1 - p) * by_chance
    m = np.arange(n + 1)[:, None]
    weight = m * np.log(agree) + (n - m) * np.log1p(-agree)
    weight = np.exp(weight - weight.max(axis=1, keepdims=True))
    return int(np.argmax(weight[:, p >= threshold].sum(axis=1) / weight.sum(axis=1) >= MISS))


def fewest_matches(threshold: float) -> list[int]:
    """The limit after each batch. Signatures are compared by one byte, so different values agree
    once in 256."""
    return [_fewest(threshold, n, 1 / 256) for n in range(BATCH, BANDS * ROWS + 1, BATCH)]


def _alike(threshold: float, one: str, two: str) -> Column:
    """Whether the one-bit signatures (columns of a join's sides) leave the threshold possible."""
    most = BANDS * ROWS - _fewest(threshold, BANDS * ROWS, 1 / 2)
    differ = [F.bit_count(F.col(f"{one}{b}").bitwiseXOR(F.col(f"{two}{b}"))) for b in BITS]
    return reduce(Column.__add__, differ) <= most


def _sign(n: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            found, bounds = shingles(words_of(batch.column("text"), lower=True), n)
            size = np.diff(bounds)
            full = np.flatnonzero(size)
            least = signatures(found, bounds[np.append(full, full[-1] + 1)] if len(full) else bounds[:1])
            keys = np.zeros((len(size), BANDS), dtype=np.int64)
            bytes_ = np.zeros((len(size), BANDS * ROWS), dtype=np.uint8)
            bits = np.zeros((len(size), len(BITS)), dtype=np.int64)
            if len(full):
                keys[full] = band_keys(least)
                mixed = mix(least)
                bytes_[full] = (mixed & np.uint64(255)).astype(np.uint8)
                packed = np.packbits(((mixed >> np.uint64(8)) & np.uint64(1)).astype(np.uint8), axis=1)
                bits[full] = np.pad(packed, ((0, 0), (0, 8 * len(BITS) - packed.shape[1]))).view(np.int64)
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
            signature = binaries(bytes_.reshape(-1).view(np.uint64), np.arange(len(size) + 1) * (BANDS * ROWS // 8))
            columns = [batch.column("doc_id"), pa.array(size.astype(np.int64)), pa.array(set_codes(found, bounds)), bands, signature]
            columns += [pa.array(np.ascontiguousarray(b)) for b in bits.T]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "node", "bands", "signature", *BITS])

    return sign


def _full_sets(n: int):
    """Sets of the texts that are what they are wanted for: a text of its node."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            found, bounds = shingles(words_of(batch.column("text"), lower=True), n)
            codes = set_codes(found, bounds)
            made = pa.RecordBatch.from_arrays([pa.array(codes), binaries(found, bounds)], ["node", "members"])
            yield made.filter(pa.array(codes == batch.column("wanted").to_numpy()))

    return sets


def _agreeing(one: np.ndarray, two: np.ndarray, least: list[int]) -> np.ndarray:
    """Which rows of two signature arrays stay likely, batch by batch."""
    open_, equal = np.arange(len(one)), np.zeros(len(one), dtype=np.int64)
    for k, fewest in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        equal[open_] += (one[open_, part] == two[open_, part]).sum(axis=1)
        open_ = open_[equal[open_] >= fewest]
    return open_


def _likely(threshold: float):
    least = fewest_matches(threshold)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (joined(batch.column(c), np.uint8).reshape(-1, BANDS * ROWS) for c in ("sa", "sb"))
            yield batch.select(["a", "b"]).take(pa.array(_agreeing(one, two, least)))

    return likely


def _confirmed(percent: int):
    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("ma"), batch.column("mb"), strict=True):
                a, b = (np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in (one, two))
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirmed


def _linked(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, distinct) whose similarity reaches the threshold."""
    pairs = store(pairs, "pairs")
    signs = nodes.select("node", "signature")
    pairs = pairs.join(signs.withColumnsRenamed({"node": "a", "signature": "sa"}), "a").join(signs.withColumnsRenamed({"node": "b", "signature": "sb"}), "b")
    likely = pairs.select("a", "b", "sa", "sb").mapInArrow(_likely(percent / 100), "a long, b long")
    # b is the hub, which many pairs share: its set is joined last and goes no further.
    held = likely.join(sets.withColumnsRenamed({"node": "a", "members": "ma"}), "a").join(sets.withColumnsRenamed({"node": "b", "members": "mb"}), "b")
    return store(held.select("a", "b", "ma", "mb").mapInArrow(_confirmed(percent), "a long, b long"), "linked", outlive=True)


def _fits(n: str, m: str, percent: int):
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """node, shingle for the rarest shingles of each set, as many as two sets of the asked
    similarity cannot both lack. Rare is what a table of fixed size counts least; any order is
    right, this one leaves shared passages to the end of it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(RARITY_CELLS, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(joined(batch.column("members"), np.uint64) % RARITY_CELLS, minlength=RARITY_CELLS)
        cell = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(1, np.int32)), binaries(np.stack([cell, counts[cell]]).ravel(), [0, 2 * len(cell)])], ["at", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(RARITY_CELLS, dtype=np.int64)
        for batch in batches:
            for one in batch.column("counts"):
                cell, n = np.frombuffer(one.as_buffer(), dtype=np.int64).reshape(2, -1)
                total[cell] += n
        yield pa.RecordBatch.from_arrays([binaries(total, [0, len(total)])], ["total"])

    counted = sets.select("members").mapInArrow(count, "at int, counts binary")
    # One small row per task; a few tasks add them up before the last one does.
    for parts in (8, 1):
        counted = counted.repartition(parts).mapInArrow(add, "total binary")
        if parts > 1:
            counted = counted.mapInArrow(_sparse, "at int, counts binary")
    total = np.frombuffer(counted.first()["total"], dtype=np.int64)
    shared = sets.sparkSession.sparkContext.broadcast(total)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, one in zip(batch.column("node"), batch.column("members"), strict=True):
                h = np.frombuffer(one.as_buffer(), dtype=np.uint64)
                n = len(h) - -(-percent * len(h) // 100) + 1
                chosen = h[np.lexsort((h, shared.value[h % RARITY_CELLS]))[:n]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, node.as_py())), pa.array(chosen.view(np.int64))], ["node", "shingle"])

    return sets.select("node", "members").mapInArrow(rarest, "node long, shingle long")


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for one in batch.column("total"):
            total = np.frombuffer(one.as_buffer(), dtype=np.int64)
            cell = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(1, np.int32)), binaries(np.stack([cell, total[cell]]).ravel(), [0, 2 * len(cell)])], ["at", "counts"])


def _common(members: pa.ChunkedArray) -> np.ndarray:
    """Number of common shingles of each two sets; values found in one set alone do not count."""
    sets = [np.frombuffer(m.as_buffer(), dtype=np.uint64) for m in members]
    values, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    place = np.cumsum(times > 1) - 1
    several = times[inverse] > 1
    owner, column = owner[several], place[inverse[several]]
    common = np.zeros((len(sets), len(sets)), dtype=np.int64)
    width = 1 << 14  # columns at a time, so that a matrix stays small
    for low in range(0, int((times > 1).sum()), width):
        part = (column >= low) & (column < low + width)
        matrix = np.zeros((len(sets), width), dtype=np.float32)
        matrix[owner[part], column[part] - low] = 1
        common += (matrix @ matrix.T).astype(np.int64)
    return common


def _forest(percent: int):
    """Links of one or two blocks of a cluster that join two components, no more than a spanning forest."""
    least = fewest_matches(percent / 100)

    def links(table: pa.Table) -> pa.Table:
        size = table.column("n_shingles").to_numpy()
        component, block = table.column("component").to_numpy(), table.column("block").to_numpy()
        signature = joined(table.column("signature").combine_chunks(), np.uint8).reshape(-1, BANDS * ROWS)
        one, two = np.triu_indices(len(size), 1)
        able = component[one] != component[two]
        able &= 100 * np.minimum(size[one], size[two]) >= percent * np.maximum(size[one], size[two])
        if len(np.unique(block)) > 1:  # pairs inside one block are another group's
            able &= block[one] != block[two]
        one, two = one[able], two[able]
        step = 1 << 16
        likely = [_agreeing(signature[one[k : k + step]], signature[two[k : k + step]], least) + k for k in range(0, len(one), step)]
        at = np.concatenate([np.zeros(0, dtype=np.int64), *likely])
        one, two = one[at], two[at]
        asked, place = np.unique(np.concatenate([one, two]), return_inverse=True)
        chosen = []
        if len(asked):
            common = _common(table.column("members").take(pa.array(asked)))[place[: len(one)], place[len(one) :]]
            fits = 100 * common >= percent * (size[one] + size[two] - common)
            root = {c: c for c in component.tolist()}

            def find(c: int) -> int:
                while root[c] != c:
                    root[c] = root[root[c]]
                    c = root[c]
                return c

            for i, j in zip(one[fits].tolist(), two[fits].tolist(), strict=True):
                x, y = find(int(component[i])), find(int(component[j]))
                if x != y:
                    root[x] = y
                    chosen.append((i, j))
        pair = np.array(chosen, dtype=np.int64).reshape(-1, 2)
        node = table.column("node").to_numpy()
        return pa.table({"a": node[pair[:, 0]], "b": node[pair[:, 1]]})

    return links


def _linked_in_clusters(rest: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of one cluster (cluster, node, n_shingles, component), compared block by
    block inside tasks: pairs are not written out. Sets of the asked similarity differ in size by less
    than a step of ``level``, so a block meets those of its own level and of the next."""
    level = F.floor(F.log(F.col("n_shingles").cast("double")) / F.lit(float(np.log(100 / percent)) * (1 + 1e-9))).cast("int")
    several = rest.groupBy("cluster").agg(F.count("*").alias("n")).filter("n > 1").select("cluster")
    leveled = rest.join(several, "cluster", "left_semi").select("cluster", "node", "n_shingles", "component", level.alias("level"))
    blocks = leveled.groupBy("cluster", "level").agg(F.ceil(F.count("*") / BLOCK_NODES).cast("int").alias("blocks"))
    along = Window.partitionBy("cluster").orderBy("level")  # some ninety levels hold sets of any size

    def beside(way: Callable[..., Column], up: int) -> Column:
        return F.when(way("level").over(along) == F.col("level") + up, way("blocks").over(along)).otherwise(0)

    around = blocks.withColumns({"above": beside(F.lead, 1), "below": beside(F.lag, -1)})
    dealt = leveled.join(around, ["cluster", "level"]).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))

    def met(of: str, up: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(of) - 1), lambda k: F.struct((F.col("level") + up).alias("level"), k.alias("block")))

    own = F.struct("level", "block")
    none = F.array().cast("array<struct<level:int,block:int>>")
    others = F.concat(met("blocks", 0), *[F.when(F.col(of) > 0, met(of, up)).otherwise(none) for of, up in (("above", 1), ("below", -1))])
    placed = dealt.withColumn("own", own).withColumn("other", F.explode(others))
    placed = placed.select("cluster", "node", "n_shingles", "component", F.xxhash64("own").alias("block"), F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    held = placed.join(sets.select("node", "members"), "node").join(nodes.select("node", "signature"), "node")
    return held.groupBy("cluster", "low", "high").applyInArrow(_forest(percent), "a long, b long")


def node_components(members: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """node, component of the nodes that link to any other. ``members`` has key, node, n_shingles
    and ``BITS`` of every bucket with several nodes."""
    facts = ["node", "n_shingles", *BITS]
    # The original of many edited copies shares more buckets with them than they do among
    # themselves: the most crowded member makes the best hub.
    crowd = members.join(members.groupBy("key").agg(F.count("*").alias("c")), "key").groupBy("node").agg(F.sum("c").alias("crowd"))
    left = members.join(crowd, "node").withColumns({"component": F.col("node"), "hub": F.col("key"), "hub_crowd": F.lit(0).cast("long")})
    left = store(left, "members")
    found = members.select("node", F.col("node").alias("component")).limit(0)
    links: DataFrame | None = None
    possible = _fits("a_n_shingles", "b_n_shingles", percent) & _alike(percent / 100, "a_", "b_") & (F.col("a_component") != F.col("b_component"))
    for round_ in range(HUB_ROUNDS + 1):
        # Buckets that still hold several components.
        open_ = left.groupBy("key").agg((F.min("component") != F.max("component")).alias("open")).filter("open").select("key")
        left = store(left.join(open_, "key", "left_semi"), "members")
        if left.isEmpty():
            break
        if round_ == HUB_ROUNDS:
            cluster = F.max(F.struct("hub_crowd", "hub")).alias("c")
            rest = left.groupBy(*facts, "component").agg(cluster).select(*facts, "component", F.col("c.hub").alias("cluster"))
            rest = store(rest, "rest")
            prefixes = store(_prefixes(sets.join(rest.select("node"), "node", "left_semi"), percent).join(rest, "node"), "prefixes")
            one, two = (prefixes.withColumnsRenamed({c: f"{side}_{c}" for c in [*facts, "component", "cluster"]}) for side in "ab")
            apart = F.col("a_cluster") != F.col("b_cluster")
            pairs = one.join(two, "shingle").filter(possible & apart & (F.col("a_node") < F.col("b_node")))
            inside = store(_linked_in_clusters(rest, nodes, sets, percent), "linked")
            links = inside if links is None else links.unionByName(inside)
        else:
            drawn = F.max(F.struct("crowd", F.xxhash64("node").alias("h"), *facts, "component")).alias("hub")
            hubs = left.groupBy("key").agg(drawn).select("key", *[F.col(f"hub.{c}").alias(f"b_{c}") for c in [*facts, "component", "crowd"]])
            hubs = store(hubs, "hubs")
            pairs = left.withColumnsRenamed({c: f"a_{c}" for c in [*facts, "component"]}).join(hubs, "key").filter(possible)
            named = hubs.select("key", F.col("b_node").alias("hub"), F.col("b_crowd").alias("hub_crowd"))
            left = left.drop("hub", "hub_crowd").join(named, "key").filter("node != hub")
        with scratch_scope(members.sparkSession):
            fresh = _linked(pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct(), nodes, sets, percent)
        links = fresh if links is None else links.unionByName(fresh)
        found = components(links)
        if round_ < HUB_ROUNDS:
            left = left.drop("component").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return store(found, "components", outlive=True)


def _signed(docs: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, n_shingles, node of every row, and one row per node with its signature."""
    kind = dict(docs.dtypes)["doc_id"]
    with scratch_scope(docs.sparkSession):
        signed = store(docs.mapInArrow(_sign(shingle), f"doc_id {kind}, n_shingles long, node long, bands array<long>, signature binary, {', '.join(f'{b} long' for b in BITS)}"), "signed")
        able = signed.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
        wide = ["n_shingles", "bands", "signature", *BITS]
        # Most nodes are one document: only those that may have copies are brought together.
        copied = able.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1")
        marked = sieved(able, sieve_of(copied, F.xxhash64("node")), F.xxhash64("node"), "_copied")
        alone = marked.filter(~F.col("_copied")).select("node", F.col("doc_id").alias("least_id"), *wide)
        several = marked.filter("_copied").groupBy("node").agg(F.min("doc_id").alias("least_id"), *[F.first(c).alias(c) for c in wide])
        nodes = store(alone.unionByName(several), "nodes", outlive=True)
        return store(signed.select("doc_id", "n_shingles", "node"), "rows", outlive=True), nodes


def _full(texts: DataFrame, asked: DataFrame, shingle: int) -> DataFrame:
    """One full set per node of ``asked`` (node, least_id), from a text of its least document."""
    wanted = asked.select(F.col("node").alias("wanted"), F.col("least_id").alias("_id"))
    some = sieved(texts, sieve_of(wanted, F.xxhash64("_id")), F.xxhash64("doc_id")).filter("_maybe").drop("_maybe")
    held = some.join(wanted, F.col("doc_id") == F.col("_id")).withColumn("_text", F.xxhash64("text"))
    # Equal rows make one set.
    copy = F.row_number().over(Window.partitionBy("doc_id", "wanted", "_text").orderBy("_text"))
    once = held.withColumn("_copy", copy).filter("_copy = 1").select("wanted", "text")
    return once.mapInArrow(_full_sets(shingle), "node long, members binary")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row: documents link if ``100 * common >=
    percent * all`` of their shingles, and the component is the smallest doc_id reachable."""
    texts = docs.select("doc_id", "text")
    rows, nodes = _signed(texts, shingle)
    keyed = nodes.select(F.explode("bands").alias("key"), "node")
    shared = store(keyed.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key"), "keys")
    # Only the keys that may be shared are dealt out, and without what their nodes are like.
    some = sieved(keyed, sieve_of(shared, F.xxhash64("key")), F.xxhash64("key")).filter("_maybe").select("key", "node")
    members = store(some.join(shared, "key").join(nodes.select("node", "n_shingles", *BITS), "node"), "members")
    asked = members.select("node").distinct().join(nodes.select("node", "least_id"), "node")
    sets = store(_full(texts, asked, shingle), "sets")
    with scratch_scope(docs.sparkSession):
        found = node_components(members, nodes, sets, percent)
    named = nodes.select("node", "least_id").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_node = store(named.join(least, "component").select("node", "component_id"), "components")
    able = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    linked = rows.filter(able).join(by_node, "node").select("doc_id", "n_shingles", "component_id")
    rest = rows.filter(~able).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(rest).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
