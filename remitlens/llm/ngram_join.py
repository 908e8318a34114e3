"""N-gram Jaccard join by prefixes of token combinations.

A document's tokens are its distinct five-word shingles, as 64-bit hashes. Documents with equal sets are one node. Tokens
have one order for the whole corpus: rare ones by hash, then frequent ones by hash. Of this order a node indexes a prefix:
rare tokens on their own; frequent tokens in classes (by hash), each pair of tokens of one class in the prefix. A class with
x tokens counts as x - 1 missed tokens when none of its pairs is shared, so the prefix is extended until rare tokens and
classes together exceed what two similar sets may miss. Two similar nodes then share an indexed single or pair. (Take the
prefix that ends first: common tokens in it are in the other one too; without a shared signature it misses too many.)
The number of classes follows the set size in powers of two; a node also indexes for the next size if partners reach it.

Every index entry carries an upper bound of the overlap of its node with a node whose first shared signature this is, which
settles most candidates without their sets. In each group of a signature, the two most central nodes are verified
against the others; only pairs that are then still in different components are verified one by one. So groups of
thousands of near copies cost a few comparisons for each member, and no link between components is left out.

How often each token occurs is counted over all documents, in blocks by hash; the frequent tokens that tasks hold are at
most ``MOST_FREQUENT``, those with the highest counts. Any set of frequent tokens gives the same result.

Defined cases: A-Z in lower case, words by ASCII white space; fewer than five words are one shingle; no words or null: no
shingles, no links, component of its own; repeated rows are copies; null ids are no component names unless nothing else is; long
texts are one set each, made in one step; for ``unique`` every column stays under its name; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.llm.arrow import LOWER, SPACED, appended, bytes_of, mixed, range_hashes, steps, words
from remitlens.llm.common import LONG, SPACES, shielded, without
from remitlens.llm.components import components
from remitlens.storage import stored

SHINGLE = 5
#: Jaccard similarity of at least 3 / 4.
NUMERATOR, DENOMINATOR = 3, 4
#: Tokens in so many texts count as frequent; with more of them than tasks may hold, the limit doubles.
FREQUENT = 8
MOST_FREQUENT = 1 << 20
#: Shingles that a block of the count and of the index holds, entries that a task sends at a time, and bytes of text it takes.
BLOCK_TOKENS = 1_000_000
SENT_ENTRIES = 1 << 18
STEP = 1 << 18
#: Bits of the filter that keeps sets without candidates out of the verification shuffle.
FILTER_BITS = 24
VERIFY_ROWS = 1024
#: Group rows that are searched together for pairs between components.
OPEN_ROWS = 200_000
#: Members of a group that one task compares with as many others; larger groups are cut into pairs of tiles.
TILE_ROWS = 16_384
#: Pairs that are held before they are handed on.
MOST_PAIRS = 1 << 20
_EMPTY = np.zeros(0, np.uint64)


def shingle_sets(data: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    data = LOWER[data]
    starts, ends, first = words(data, at, SPACED)
    hashes = range_hashes(data, starts, ends) if len(starts) else _EMPTY
    count = np.diff(first)
    width = np.minimum(count, SHINGLE)
    begins = [np.arange(f, f + n - w + 1) for f, n, w in zip(first[:-1], count, width, strict=True) if n]
    if not begins:
        yield from (_EMPTY for _ in count)
        return
    begin = np.concatenate(begins)
    wide = np.repeat(width[count > 0], (count - width + 1)[count > 0])
    shingles = range_hashes(hashes, begin, begin + wide)
    cut = 0
    for n, w in zip(count.tolist(), width.tolist(), strict=True):
        if n == 0:
            yield _EMPTY
        else:
            yield np.unique(shingles[cut : cut + n - w + 1])
            cut += n - w + 1


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    data, at = bytes_of(batch.column("text"))
    row = 0
    for lo, hi in steps(at, STEP):
        for found in shingle_sets(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]):
            yield row, found
            row += 1


def node_of(found: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "big", signed=True)


def with_nodes(docs: DataFrame) -> DataFrame:
    """``docs`` with n_shingles and node, which names the set (null if empty)."""
    base = without(docs, "n_shingles", "node")
    schema = T.StructType([*base.schema, T.StructField("n_shingles", LONG), T.StructField("node", LONG)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, nodes = [], []
            for _, found in _sets(batch):
                counts.append(len(found))
                nodes.append(node_of(found) if len(found) else None)
            yield appended(batch, {"n_shingles": pa.array(counts, pa.int64()), "node": pa.array(nodes, pa.int64())})

    return base.mapInArrow(run, schema)


class _Once:
    """Sets that a task has not seen before. Forgetting some only repeats work."""

    def __init__(self, most: int = 1 << 18):
        self.seen: set[int] = set()
        self.most = most

    def __call__(self, node: int) -> bool:
        if node in self.seen:
            return False
        if len(self.seen) >= self.most:
            self.seen.clear()
        self.seen.add(node)
        return True


def _dealt(keys: np.ndarray, columns: dict[str, np.ndarray], n_blocks: int) -> pa.RecordBatch:
    """One row for each block that has any of ``keys``: the columns' values as bytes."""
    block = (keys % np.uint64(n_blocks)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    present, cuts = np.unique(block[order], return_index=True)
    cuts = [*cuts.tolist(), len(order)]
    arrays = [pa.array(present, pa.int64())]
    for values in columns.values():
        values = values[order]
        arrays.append(pa.array([values[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=["block", *columns])


def _blocks(batches: Iterator[pa.RecordBatch], kinds: dict[str, type]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """Blocks whose rows come together, put back into arrays."""
    now, parts = None, {c: [] for c in kinds}
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in kinds]
        for i, block in enumerate(batch.column("block").to_pylist()):
            if block != now and now is not None:
                yield now, {c: np.frombuffer(b"".join(p), kinds[c]) for c, p in parts.items()}
                parts = {c: [] for c in kinds}
            now = block
            for c, values in zip(kinds, columns, strict=True):
                parts[c].append(values[i])
    if now is not None:
        yield now, {c: np.frombuffer(b"".join(p), kinds[c]) for c, p in parts.items()}


def _together(rows: DataFrame, n_blocks: int) -> DataFrame:
    return rows.repartition(n_blocks, "block").sortWithinPartitions("block")


def frequent_tokens(docs: DataFrame, n_blocks: int) -> np.ndarray:
    """Sorted tokens in at least FREQUENT texts, at most MOST_FREQUENT.

    A token is sent as 32 bits besides its block. Two tokens that agree in both are counted as one, which can only make
    more tokens frequent.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _Once()
        for batch in batches:
            found = [s for _, s in _sets(batch) if len(s) > 1 and once(node_of(s))]
            if found:
                tokens = np.concatenate(found)
                yield _dealt(tokens, {"tokens": (tokens // np.uint64(n_blocks)).astype(np.uint32)}, n_blocks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, columns in _blocks(batches, {"tokens": np.uint32}):
            tokens, counts = np.unique(columns["tokens"], return_counts=True)
            often = counts >= FREQUENT
            key = (np.uint64(block) << np.uint64(32)) | tokens[often].astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(counts[often].astype(np.int64))], names=["key", "n"])

    sent = docs.select("text").mapInArrow(send, "block long, tokens binary")
    counted = stored(_together(sent, n_blocks).mapInArrow(count, "key long, n long"), "frequent")
    power = F.floor(F.log2(F.col("n"))).cast("int").alias("power")
    by_power = {r.power: r.n for r in counted.groupBy(power).agg(F.count("*").alias("n")).collect()}
    limit = int(math.log2(FREQUENT))
    while sum(n for p, n in by_power.items() if p >= limit) > MOST_FREQUENT:
        limit += 1
    keys = counted.where(F.col("n") >= (1 << limit)).select("key").toArrow().column("key")
    return np.sort(keys.to_numpy().astype(np.uint64))


def is_frequent(tokens: np.ndarray, frequent: np.ndarray, n_blocks: int) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(tokens), bool)
    key = ((tokens % np.uint64(n_blocks)) << np.uint64(32)) | (tokens // np.uint64(n_blocks)).astype(np.uint32).astype(np.uint64)
    return frequent[np.minimum(np.searchsorted(frequent, key), len(frequent) - 1)] == key


def signatures(tokens: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of a set: signatures, and the upper bounds of an overlap whose first shared signature they are.

    ``tokens`` are sorted. A set may miss n - ceil(3 n / 4) tokens; its prefix must count one more.
    """
    n = len(tokens)
    need = n - -(-NUMERATOR * n // DENOMINATOR) + 1
    rare = tokens[~often]
    single = rare[:need]
    keys, bounds = [mixed(single)], [n - np.arange(len(single))]
    missing = need - len(single)
    if missing > 0:
        heavy = tokens[often]
        band = n.bit_length()
        # Partners have at most n * 4 / 3 tokens; those of the next power of two use more classes.
        for size in (band, band + 1) if DENOMINATOR * n >= NUMERATOR * (1 << band) else (band,):
            classes = max(1, (1 << (size - 1)) // 8)
            cls = ((heavy >> np.uint64(20)) % np.uint64(classes)).astype(np.int64)
            order = np.argsort(cls, kind="stable")
            own = cls[order]
            begin = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            rank = np.empty(len(heavy), np.int64)
            rank[order] = np.arange(len(own)) - np.repeat(begin, np.diff(np.r_[begin, len(own)]))
            credit = np.cumsum(rank > 0)
            last = int(np.searchsorted(credit, missing)) + 1
            kept = order[order < last]
            own, token = cls[kept], heavy[kept]
            bound = n - len(rare) - credit[kept] + (rank[kept] > 0)
            for lag in range(1, int(rank[:last].max(initial=0)) + 1):
                pair = np.flatnonzero(own[lag:] == own[:-lag])
                keys.append(mixed(mixed(token[pair]) + token[pair + lag] * np.uint64(0xD6E8FEB86659FD93) + np.uint64(size)))
                bounds.append(bound[pair + lag])
    return np.concatenate(keys), np.concatenate(bounds)


def hopeful(n: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Which members of a group have another one that the bounds allow, in n log n steps.

    Members i and j may be similar if room[i] >= 3 n[j] and room[j] >= 3 n[i], with room = 7 bound - 3 n.
    """
    n = n.astype(np.int64)
    room = 7 * bound.astype(np.int64) - 3 * n
    order = np.argsort(n, kind="stable")
    low = np.iinfo(np.int64).min
    # The greatest room up to each place in order of n, who has it, and the greatest of the others.
    best = np.maximum.accumulate(room[order])
    fresh = np.r_[True, best[1:] > best[:-1]]
    who = order[np.maximum.accumulate(np.where(fresh, np.arange(len(n)), 0))]
    beaten = np.where(fresh, np.r_[low, best[:-1]], room[order])
    second = np.maximum.accumulate(beaten)
    last = np.searchsorted(n[order], room // 3, "right") - 1
    at = np.maximum(last, 0)
    other = np.where(who[at] == np.arange(len(n)), second[at], best[at])
    return (last >= 0) & (other >= 3 * n)


def _groups(signature: np.ndarray, node: np.ndarray, n: np.ndarray, bound: np.ndarray) -> dict[bytes, list[np.ndarray]]:
    """Groups of nodes with a shared signature in which a pair can be similar, equal groups once with their best bounds."""
    order = np.lexsort((node, signature))
    signature, node, n, bound = signature[order], node[order], n[order].astype(np.int64), bound[order].astype(np.int64)
    fresh = np.r_[True, (signature[1:] != signature[:-1]) | (node[1:] != node[:-1])]
    signature, node, n, bound = signature[fresh], node[fresh], n[fresh], bound[fresh]
    begin = np.flatnonzero(np.r_[True, signature[1:] != signature[:-1]])
    end = np.r_[begin[1:], len(signature)]
    out: dict[bytes, list[np.ndarray]] = {}
    for a, b in zip(begin[end - begin > 1].tolist(), end[end - begin > 1].tolist(), strict=True):
        who, size, top = node[a:b], n[a:b], bound[a:b]
        some = hopeful(size, top)
        if not some.any():
            continue
        who, size, top = who[some], size[some], top[some]
        key = who.tobytes()
        if have := out.get(key):
            np.maximum(have[2], top, out=have[2])
        else:
            out[key] = [who, size, top.copy()]
    return out


def candidate_groups(docs: DataFrame, frequent: np.ndarray, n_blocks: int) -> DataFrame:
    """(gid, node, n, bound): members of the groups of the index."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    kinds = {"signature": np.uint32, "node": np.int64, "n": np.uint32, "bound": np.uint32}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, often = _Once(), shared.value
        for batch in batches:
            parts: list[tuple] = []
            size = 0
            for _, found in _sets(batch):
                if len(found) < 2 or not once(node := node_of(found)):
                    continue  # a set of one shingle is similar to itself only
                keys, bounds = signatures(found, is_frequent(found, often, n_blocks))
                parts.append((keys, np.full(len(keys), node), np.full(len(keys), len(found), np.uint32), bounds.astype(np.uint32)))
                size += len(keys)
                if size > SENT_ENTRIES:
                    yield entries(parts)
                    parts, size = [], 0
            if parts:
                yield entries(parts)

    def entries(parts: list[tuple]) -> pa.RecordBatch:
        keys, nodes, sizes, bounds = (np.concatenate(c) for c in zip(*parts, strict=True))
        return _dealt(keys, {"signature": (keys // np.uint64(n_blocks)).astype(np.uint32), "node": nodes, "n": sizes, "bound": bounds}, n_blocks)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, c in _blocks(batches, kinds):
            for who, size, top in _groups(c["signature"], c["node"], c["n"], c["bound"]).values():
                gid = node_of(who)
                columns = (np.full(len(who), gid), who, size, top)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["gid", "node", "n", "bound"])

    sent = docs.select("text").mapInArrow(send, "block long, signature binary, node binary, n binary, bound binary")
    groups = _together(sent, n_blocks).mapInArrow(meet, "gid long, node long, n long, bound long")
    return groups.groupBy("gid", "node").agg(F.max("n").alias("n"), F.max("bound").alias("bound"))


def _near(a: str, b: str):
    return F.expr(f"7 * least({a}.bound, {b}.bound) >= 3 * ({a}.n + {b}.n)")


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, tokens) of the given nodes, and of few more: a bit filter of fixed size decides before the shuffle."""
    size = 1 << FILTER_BITS
    at = F.pmod("node", F.lit(size)).alias("at")
    rows = nodes.select(at).groupBy(F.expr("bitmap_bucket_number(at)").alias("part")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits")).collect()
    bits = np.zeros(size + 8 * 4096 * 2, bool)
    for r in rows:
        # Bucket numbers begin at 1 for positions from 1; position 0 has bucket 0 or 1 by version, so bits are put by number.
        here = np.unpackbits(np.frombuffer(bytes(r.bits), np.uint8), bitorder="little")
        bits[r.part * 32768 : r.part * 32768 + len(here)] |= here.astype(bool)
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits, bitorder="little"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, known = _Once(), np.unpackbits(shared.value, bitorder="little").astype(bool)
        for batch in batches:
            names, found = [], []
            for _, s in _sets(batch):
                if len(s) > 1:
                    node = node_of(s)
                    p = node % size
                    # As Spark numbers them: bucket 1 + (p - 1) / 32768 and bit (p - 1) % 32768; 0 for p = 0.
                    where = (1 + (p - 1) // 32768) * 32768 + (p - 1) % 32768 if p > 0 else 0
                    if known[where] and once(node):
                        names.append(node)
                        found.append(s.tobytes())
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(found, pa.binary())], names=["node", "tokens"])

    return docs.select("text").mapInArrow(run, "node long, tokens binary").join(nodes, "node", "left_semi").groupBy("node").agg(F.any_value("tokens").alias("tokens"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar.

    The sets of all partners stream past that of ``a``, in portions of bounded size, so a task holds two sets.
    """
    portions = pairs.groupBy("a").agg(F.ceil(F.count("*") / VERIFY_ROWS).alias("k"))
    keys = portions.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("portion"))
    numbered = pairs.join(portions, "a").select(F.col("b").alias("node"), "a", F.pmod(F.xxhash64("b"), F.col("k")).alias("portion"), "b")
    first = keys.select(F.col("a").alias("node"), "a", "portion", F.lit(None).cast("long").alias("b"))
    rows = first.unionByName(numbered).join(sets, "node").select("a", "portion", "b", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = _EMPTY
        for batch in batches:
            out: list[tuple[int, int]] = []
            sets = batch.column("tokens")
            for i, (a, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "b")), strict=True)):
                found = np.frombuffer(sets[i].as_buffer(), np.uint64)
                if b is None:
                    mine = found.copy()
                    continue
                small, large = (mine, found) if len(mine) < len(found) else (found, mine)
                both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                if DENOMINATOR * both >= NUMERATOR * (len(mine) + len(found) - both):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return rows.repartition("a", "portion").sortWithinPartitions("a", "portion", F.col("b").asc_nulls_first()).mapInArrow(run, "a long, b long")


def pivot_pairs(groups: DataFrame) -> DataFrame:
    """(a, b): in each group its two most central nodes with all others, as far as bounds allow a link.

    Central is who occurs in most groups: of many edited copies, the text that they come from.
    """
    degree = groups.groupBy("node").agg(F.count("*").alias("degree"))
    ranked = groups.join(degree, "node")
    rank = F.struct("degree", "node", "n", "bound")
    top = ranked.groupBy("gid").agg(F.max(rank).alias("top"))
    second = ranked.join(top, "gid").where("node <> top.node").groupBy("gid").agg(F.max(rank).alias("top"))
    pivots = top.unionByName(second).select("gid", "top.node", "top.n", "top.bound")
    met = groups.alias("x").join(pivots.alias("y"), F.expr("x.gid = y.gid AND x.node <> y.node") & _near("x", "y"))
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def tiled(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` with (i, j, own): each pair of tiles of a group and the tile of the row, which is one of both."""
    n_tiles = F.ceil(F.col("size") / TILE_ROWS)
    placed = rows.join(sizes.withColumn("n_tiles", n_tiles), "gid").withColumn("own", F.pmod(F.xxhash64("node"), F.col("n_tiles")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tiles") - 1))
    return placed.withColumn("other", other).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other", "n_tiles")


def open_pairs(groups: DataFrame, comps: DataFrame) -> DataFrame:
    """(a, b): all pairs of a group in different components, as far as bounds allow a link.

    Groups with the same least node tend to hold the same pairs, so they are searched together, in portions of bounded
    size, and hand on a pair once. Groups over ``TILE_ROWS`` are dealt out by pairs of tiles.
    """
    rows = groups.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    kinds = rows.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("node").alias("least"), F.count("*").alias("size")).where("lo <> hi")
    kinds = stored(kinds.select("gid", "least", "size"), "open-groups")
    rivals = kinds.groupBy("least").agg(F.ceil(F.sum("size") / OPEN_ROWS).alias("k"))
    total = kinds.agg(F.sum(F.col("size") * F.ceil(F.col("size") / TILE_ROWS))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / OPEN_ROWS))
    portion = F.when(F.col("size") > TILE_ROWS, F.col("gid")).otherwise(F.pmod("gid", F.col("k")))
    dealt = kinds.join(rivals, "least").select("gid", "least", "size", portion.alias("portion"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        now, group, size = None, [], 0

        def out() -> pa.RecordBatch:
            nonlocal found, size
            pairs = np.unique(np.concatenate(found), axis=0)
            found, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            if group:
                for pairs in _pairs(*(np.concatenate(c) for c in zip(*group, strict=True))):
                    found.append(pairs)
                    size += len(pairs)
                    if size > MOST_PAIRS:
                        yield out()
                group.clear()

        for batch in batches:
            gid, i, j, *columns = (batch.column(c).to_numpy() for c in ("gid", "i", "j", "node", "n", "bound", "comp", "own"))
            cuts = [0, *(np.flatnonzero((gid[1:] != gid[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1).tolist(), len(gid)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    if (gid[a], i[a], j[a]) != now:
                        yield from flush()
                        now = (gid[a], i[a], j[a])
                    group.append([c[a:b] for c in columns])
        yield from flush()
        if found:
            yield out()

    block = F.pmod(F.xxhash64("least", "portion", "i", "j"), F.lit(n_blocks)).alias("block")
    together = tiled(rows, dealt).select(block, "gid", "i", "j", "node", "n", "bound", "comp", "own").repartition(n_blocks, "block").sortWithinPartitions("block", "gid", "i", "j")
    return together.mapInArrow(run, "a long, b long").distinct()


def _pairs(node: np.ndarray, n: np.ndarray, bound: np.ndarray, comp: np.ndarray, own: np.ndarray) -> Iterator[np.ndarray]:
    """Pairs in different components that the bounds allow, of one tile or between two.

    Members of the largest component are only compared with those of others.
    """
    names, where = np.unique(comp, return_inverse=True)
    outer = np.flatnonzero(where != np.bincount(where).argmax()) if len(names) > 1 else np.zeros(0, np.int64)
    inner = np.ones(len(node), bool)
    inner[outer] = False
    across = own.min() != own.max()
    for lo in range(0, len(outer), 64):
        part = outer[lo : lo + 64]
        near = 7 * np.minimum.outer(bound[part], bound) >= 3 * np.add.outer(n[part], n)
        near &= (comp[part, None] != comp) & (inner | (node[part, None] < node))
        if across:
            near &= own[part, None] != own
        x, y = np.nonzero(near)
        a, b = node[part][x], node[y]
        if len(a):
            yield np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)


def links(docs: DataFrame, n_blocks: int) -> DataFrame:
    """Edges (a, b) between nodes, enough to connect all that similar pairs connect."""
    frequent = frequent_tokens(docs, n_blocks)
    groups = stored(candidate_groups(docs, frequent, n_blocks), "groups")
    sets = stored(_sets_of(docs, groups.select("node").distinct()), "sets")
    first = stored(pivot_pairs(groups), "pairs")
    near = stored(verified(first, sets), "links")
    rest = stored(open_pairs(groups, components(near)).join(first, ["a", "b"], "left_anti"), "pairs")
    return near.unionByName(stored(verified(rest, sets), "links"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n_shingles, node, comp, component_id) of every row of ``docs``; comp tells components apart.

    ``digest`` is that of the text, to find the row again.
    """
    rows = stored(with_nodes(docs.select("doc_id", "text", _digest().alias("digest"))).drop("text"), "nodes")
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    n_blocks = max(1, math.ceil(total / BLOCK_TOKENS))
    comps = components(links(docs, n_blocks))
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least")).join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    nodes = stored(nodes, "node-components")
    names = nodes.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = nodes.join(names, "comp").select("node", "comp", "component_id")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(named, "node", "left").select("doc_id", "digest", "n_shingles", "node", "comp", own.alias("component_id"))


def _digest() -> Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


def unique(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the least id, with its own columns; documents without words stay.

    Kept documents are found again by id and digest of their text.
    """
    members = stored(near_duplicates(docs), "members").where("comp IS NOT NULL")
    chosen = members.groupBy("comp").agg(F.min(F.struct("doc_id", "digest")).alias("k")).select("comp", F.col("k.doc_id").alias("_id"), F.col("k.digest").alias("_digest"))
    rows = members.groupBy("doc_id", "digest").agg(F.count("*").alias("n"))
    chosen = chosen.join(rows, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_digest") == F.col("digest")))
    chosen = stored(chosen.select("_id", "_digest", F.col("comp").alias("_comp"), F.col("n").alias("_n")), "chosen")
    rows, restored = shielded(docs, "_id", "_digest", "_comp", "_n")
    kept = rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("_id")) & (_digest() == F.col("_digest")), "left")
    empty = F.coalesce(F.trim(F.col("text"), F.lit(SPACES)), F.lit("")) == ""
    single = kept.where(empty | (F.col("_n") == 1))
    if chosen.where("_n > 1").limit(1).count():  # repeated rows of a chosen document
        single = single.unionByName(kept.where("_n > 1").dropDuplicates(["_comp"]))
    return restored(single)
