"""Removal of repeated byte strings by threshold-bounded interval expansion.

Every string of 400 bytes has an anchor: the least hash among its grams of 32 bytes, the first one in case of a tie. Equal
strings have their anchor at the same place, so strings whose anchor gram occurs once in the corpus cannot repeat. Anchors
that occur twice or more, about one in 185 bytes of repeated text at most, meet in blocks with the bytes around them.

A block is searched like a Burrows-Wheeler transform of its anchored suffixes: the suffixes are sorted, with the longest
common prefix (LCP) of neighbours, and the byte before each suffix is the transform. Breadth-first, all intervals of
suffixes are extended backwards byte by byte: an interval splits by the byte before, its members keep their order. After s
steps the neighbours of an interval share s bytes before the anchor; where their LCP is at least 400 - s, the string of 400
bytes that begins s bytes before the anchor repeats. Common strings are so derived by increasing s, which stops at 368, where
the gram would leave the string; intervals of one member are dropped.

Intervals of grams with more than ``MOST_ANCHORS`` occurrences would not fit into a block. They are expanded as rows instead, in
the same order: an interval is named by a hash of the bytes that its members share, first those that all strings of a segment of s
have in common, then, inside intervals of two or more members, each string's own. Members are added up in each task first: of
equal ones one goes on as their representative, the others are known to repeat, so a gram in every text sends one entry for each
task and string. Which way a gram takes changes the cost, not the result. Tasks are told of at most ``MOST_OFTEN`` grams, those
with the most anchors; where there are more, the blocks in which anchors meet sort out the rest.

Texts that are equal as a whole are one text with a count, whose bytes all repeat if there are 400. Texts move twice, to
cut the surroundings of anchors and to cut the repeats out; both are joins by text and never by group. A block holds what a
bounded number of anchors brings.

Defined cases: null is empty; texts under the length keep everything; matches never cross texts, overlaps count; what is
repeated is judged on the input; repeated rows are copies; null ids stay; NUL bytes are bytes like others; texts over a step are
taken in overlapping pieces; only doc_id and text are read, other columns are ignored whatever their names; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.llm.arrow import bytes_of, mixed, range_hashes, steps
from remitlens.llm.common import BINARY, LONG
from remitlens.storage import stored

#: Bytes of text that anchors are looked for in at a time, at most 2**20.
STEP_BYTES = 1 << 18
LENGTH, GRAM = 400, 32
REACH = LENGTH - GRAM
#: Anchors that a block takes, by expectation.
BLOCK_ANCHORS = 8_192
#: Occurrences up to which a gram's anchors meet, and values of s that are expanded together first for grams with more.
MOST_ANCHORS = 8_192
SEGMENT = 41
#: Grams that tasks are told of (8 bytes each).
MOST_OFTEN = 1 << 20
#: Anchors or members that a task adds up before it sends them.
COUNT_ANCHORS, COUNT_MEMBERS = 1 << 18, 1 << 18
#: Tasks over which the rows of one text with many copies are spread.
SALTS = 16
_BITS = np.uint64(20)
_LOW = np.uint64((1 << 20) - 1)


def anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all strings inside rows, and their gram hashes. At most 2**20 bytes."""
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    begin = np.arange(n - GRAM + 1)
    hashes = range_hashes(data, begin, begin + GRAM)
    least = (hashes & ~_LOW) | begin.astype(np.uint64)
    width, total = 1, REACH + 1
    while 2 * width <= total:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < total:
        least = np.minimum(least[: len(least) - (total - width)], least[total - width :])
    # least[p] belongs to the string that begins at p; it must end inside its row.
    inside = np.zeros(len(least) + 1, np.int64)
    first, last = at[:-1], at[1:] - LENGTH + 1
    long = last > first
    np.add.at(inside, first[long], 1)
    np.add.at(inside, last[long], -1)
    places = np.unique((least[np.cumsum(inside[:-1]) > 0] & _LOW).astype(np.int64))
    return places, hashes[places]


def row_anchors(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, places in the row, hashes) of rows with any. Rows over a step are taken in overlapping pieces."""
    for lo, hi in steps(at, STEP_BYTES):
        if at[hi] - at[lo] <= STEP_BYTES:
            places, hashes = anchors(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
            places = places + at[lo]
            cuts = np.searchsorted(places, at[lo : hi + 1])
            for row in range(lo, hi):
                a, b = cuts[row - lo], cuts[row - lo + 1]
                if b > a:
                    yield row, places[a:b] - at[row], hashes[a:b]
        else:
            text = data[at[lo] : at[hi]]
            parts = []
            for start in range(0, len(text) - LENGTH + 1, STEP_BYTES - LENGTH + 1):
                piece = text[start : start + STEP_BYTES]
                places, hashes = anchors(piece, np.array([0, len(piece)]))
                parts.append((places + start, hashes))
            places, fresh = np.unique(np.concatenate([p for p, _ in parts]), return_index=True)
            yield lo, places, np.concatenate([h for _, h in parts])[fresh]


def _dealt(block: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    order = np.argsort(block, kind="stable")
    present, cuts = np.unique(block[order], return_index=True)
    cuts = [*cuts.tolist(), len(order)]
    arrays = [pa.array(present, pa.int64())]
    for values in columns.values():
        values = values[order]
        arrays.append(pa.array([values[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=["block", *columns])


def _blocks(batches: Iterator[pa.RecordBatch], kinds: dict[str, type]) -> Iterator[dict[str, np.ndarray]]:
    now, parts = None, {c: [] for c in kinds}
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in kinds]
        for i, block in enumerate(batch.column("block").to_pylist()):
            if block != now and now is not None:
                yield {c: np.frombuffer(b"".join(p), kinds[c]) for c, p in parts.items()}
                parts = {c: [] for c in kinds}
            now = block
            for c, values in zip(kinds, columns, strict=True):
                parts[c].append(values[i])
    if now is not None:
        yield {c: np.frombuffer(b"".join(p), kinds[c]) for c, p in parts.items()}


def _together(rows: DataFrame, n_blocks: int) -> DataFrame:
    return rows.repartition(n_blocks, "block").sortWithinPartitions("block")


def common_prefix(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Equal leading bytes of rows of ``a`` and ``b``, up to ``most``."""
    out = np.empty(len(a), np.int64)
    for lo in range(0, len(a), 8192):
        differ = a[lo : lo + 8192] != b[lo : lo + 8192]
        first = differ.argmax(axis=1)
        out[lo : lo + 8192] = np.where(differ[np.arange(len(first)), first], first, differ.shape[1])
    return np.minimum(out, most)


def expand(group: np.ndarray, left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each anchored suffix the least and the greatest s at which its string repeats (greatest -1: none).

    ``left`` are the bytes before the anchor, nearest first; ``right`` those from the anchor on; n_* say how many exist.
    """
    m = len(group)
    least, most = np.full(m, LENGTH, np.int64), np.full(m, -1, np.int64)
    # Bytes that are not there are zeros; among equal ones a text that ends comes first, so none stands between two that go on.
    order = np.lexsort((n_right, np.ascontiguousarray(right).view(f"S{right.shape[1]}").ravel(), group))
    # ``lcp[i]`` is that of members i - 1 and i of an interval, -1 at the first member of an interval.
    lcp = np.full(m, -1, np.int64)
    a, b = order[:-1], order[1:]
    same = group[a] == group[b]
    lcp[1:][same] = common_prefix(right[a[same]], right[b[same]], np.minimum(n_right[a[same]], n_right[b[same]]))
    for s in range(REACH + 1):
        keep = lcp >= 0
        keep[:-1] |= lcp[1:] >= 0  # intervals of one member end here
        order, lcp = order[keep], lcp[keep]
        if not len(order):
            break
        repeats = lcp >= LENGTH - s
        repeats[:-1] |= repeats[1:]
        found = order[repeats]
        least[found] = np.minimum(least[found], s)
        most[found] = s
        if s == REACH:
            break
        interval = np.cumsum(lcp < 0)
        byte = np.where(n_left[order] > s, left[order, s].astype(np.int16), np.int16(-1))
        new = np.lexsort((byte, interval)) if ((byte[1:] != byte[:-1]) & (lcp[1:] >= 0)).any() or (byte < 0).any() else None
        if new is not None:
            inside = byte[new] >= 0  # no byte before: the string would begin before its text
            new = new[inside]
            order, interval, byte = order[new], interval[new], byte[new]
            joined = np.zeros(len(new), bool)
            joined[1:] = (interval[1:] == interval[:-1]) & (byte[1:] == byte[:-1])
            stayed = np.zeros(len(new), bool)
            stayed[1:] = new[1:] == new[:-1] + 1
            lcp = np.where(joined & stayed, lcp[new], -1)
            apart = np.flatnonzero(joined & ~stayed)
            x, y = order[apart - 1], order[apart]
            lcp[apart] = common_prefix(right[x], right[y], np.minimum(n_right[x], n_right[y]))
    return least, most


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.sha2(text.cast("binary"), 256)
    return docs.select("doc_id", text.alias("text"), digest.alias("sha"), F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("text_id"))


class _Once:
    """Texts that a task has not seen before. Forgetting some only repeats work."""

    def __init__(self, most: int = 1 << 18):
        self.seen: set[int] = set()
        self.most = most

    def __call__(self, name: int) -> bool:
        if name in self.seen:
            return False
        if len(self.seen) >= self.most:
            self.seen.clear()
        self.seen.add(name)
        return True


def often_grams(texts: DataFrame, n_blocks: int, most: int = MOST_ANCHORS) -> np.ndarray:
    """Sorted grams with more than ``most`` anchors. Copies of a text may count again, which can only add grams."""
    kinds = {"gram": np.uint64, "n": np.uint32}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        once, size = _Once(), 0

        def counted() -> pa.RecordBatch:
            gram, n = np.unique(np.concatenate(parts), return_counts=True)
            return _dealt((gram % np.uint64(n_blocks)).astype(np.int64), {"gram": gram, "n": n.astype(np.uint32)})

        for batch in batches:
            data, at = bytes_of(batch.column("text"))
            names = batch.column("text_id").to_pylist()
            for row, _, hashes in row_anchors(data, at):
                if not once(names[row]):
                    continue
                parts.append(hashes)
                size += len(hashes)
                if size >= COUNT_ANCHORS:
                    yield counted()
                    parts, size = [], 0
        if parts:
            yield counted()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _blocks(batches, kinds):
            gram, where = np.unique(c["gram"], return_inverse=True)
            n = np.bincount(where, weights=c["n"]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(gram[n > most].astype(np.int64)), pa.array(n[n > most])], names=["gram", "n"])

    sent = texts.select("text_id", "text").mapInArrow(send, "block long, gram binary, n binary")
    counted = stored(_together(sent, n_blocks).mapInArrow(count, "gram long, n long"), "often-grams")
    by_power = {r["power"]: r["n"] for r in counted.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count("*").alias("n")).collect()}
    least = 0
    while sum(n for p, n in by_power.items() if p >= least) > MOST_OFTEN:
        least += 1
    found = counted.where(F.floor(F.log2("n")) >= least).select("gram").toArrow().column("gram")
    return np.sort(found.to_numpy().astype(np.uint64))


def _is_often(gram: np.ndarray, often: np.ndarray) -> np.ndarray:
    if not len(often):
        return np.zeros(len(gram), bool)
    return often[np.minimum(np.searchsorted(often, gram), len(often) - 1)] == gram


def own_range(places: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest s of strings in a text of n bytes that can have their anchor at these places."""
    lo, hi = np.maximum(LENGTH - n + places, 0), np.minimum(places, REACH)
    value, apart = hashes & ~_LOW, np.diff(places)
    # The string must not hold a neighbour that would be its anchor instead.
    hi[1:] = np.where(value[:-1] <= value[1:], np.minimum(hi[1:], apart - 1), hi[1:])
    lo[:-1] = np.where(value[1:] < value[:-1], np.maximum(lo[:-1], REACH + 1 - apart), lo[:-1])
    return lo, hi


def often_places(texts: DataFrame, often: np.ndarray) -> DataFrame:
    """(text_id, often, places): where texts hold often grams as anchors; copies of a text may name theirs again."""
    shared = texts.sparkSession.sparkContext.broadcast(often)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _Once()
        for batch in batches:
            data, at = bytes_of(batch.column("text"))
            names, out = batch.column("text_id").to_pylist(), []
            for row, places, hashes in row_anchors(data, at):
                here = _is_often(hashes, shared.value)
                if here.any() and once(names[row]):
                    out.append((names[row], places[here].tolist()))
            ids, found = ([r[i] for r in out] for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([True] * len(ids), pa.bool_()), pa.array(found, pa.list_(pa.int64()))], names=["text_id", "often", "places"])

    return texts.select("text_id", "text").mapInArrow(find, "text_id long, often boolean, places array<long>").dropDuplicates(["text_id"])


def _added_up(rows: DataFrame, n_blocks: int, kinds: dict[str, type], name: str, schema: str, finished: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """(text_id, and what ``finished`` makes of the kinds as bytes): members whose key occurs twice or more, a row for each text and block.

    ``rows`` come from ``_Members``. Known members are ready; representatives meet those of other tasks.
    """
    sent = stored(rows, name)
    every = {"key": np.uint64, "text_id": np.int64, **kinds, "known": np.uint8}

    def unpacked(c: dict[str, np.ndarray], keep: np.ndarray) -> pa.RecordBatch:
        return finished(_dealt(c["text_id"][keep], {k: c[k][keep] for k in kinds}).rename_columns(["text_id", *kinds]))

    def ready(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = {k: np.frombuffer(row[k], t) for k, t in every.items()}
                yield unpacked(c, np.ones(len(c["key"]), bool))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _blocks(batches, every):
            order = np.argsort(c["key"], kind="stable")
            c = {k: v[order] for k, v in c.items()}
            again = np.zeros(len(order), bool)
            again[1:] = c["key"][1:] == c["key"][:-1]
            again[:-1] |= again[1:]
            yield unpacked(c, again & (c["known"] == 0))

    known = sent.where("block < 0").mapInArrow(ready, schema)
    return known.unionByName(_together(sent.where("block >= 0"), n_blocks).mapInArrow(meet, schema))


class _Members:
    """Members of intervals in one task, added up: equal ones are known to repeat, and one of them goes on."""

    def __init__(self, kinds: dict[str, type], n_blocks: int, needed: Callable[[dict[str, np.ndarray]], np.ndarray] | None = None):
        self.kinds, self.n_blocks, self.needed = {"key": np.uint64, "text_id": np.int64, **kinds}, n_blocks, needed
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(tuple(c.astype(t) for c, t in zip(columns, self.kinds.values(), strict=True)))
        self.size += len(columns[0])
        if self.size >= COUNT_MEMBERS:
            yield from self.sent()

    def sent(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        c = dict(zip(self.kinds, (np.concatenate(p) for p in zip(*self.parts, strict=True)), strict=True))
        self.parts, self.size = [], 0
        _, first, where, n = np.unique(c["key"], return_index=True, return_inverse=True, return_counts=True)
        c["known"] = (n > 1)[where].astype(np.uint8)
        known = {k: v[c["known"] > 0] for k, v in c.items()}
        if len(known["key"]):
            if self.needed:
                keep = self.needed(known)
                known = {k: v[keep] for k, v in known.items()}
            yield _dealt(np.full(len(known["key"]), -1), known)
        yield _dealt((c["key"][first] % np.uint64(self.n_blocks)).astype(np.int64), {k: v[first] for k, v in c.items()})

    @staticmethod
    def schema(kinds: dict[str, type]) -> str:
        return "block long, " + ", ".join(f"{c} binary" for c in ("key", "text_id", *kinds, "known"))


_SEGMENTS = {"place": np.uint32, "low": np.uint16, "high": np.uint16}


def often_segments(anchored: DataFrame, n_blocks: int) -> DataFrame:
    """(text_id, place, low, high): anchors with the ranges of s whose common bytes occur elsewhere too.

    ``anchored`` has (text_id, text, places), each text once.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = _Members(_SEGMENTS, n_blocks)
        for batch in batches:
            data, at = bytes_of(batch.column("text"))
            wanted = {name: np.unique(np.asarray(own, np.int64)) for name, own in zip(batch.column("text_id").to_pylist(), batch.column("places").to_pylist(), strict=True)}
            names = batch.column("text_id").to_pylist()
            for row, places, hashes in row_anchors(data, at):
                text = data[at[row] : at[row + 1]]
                here = np.isin(places, wanted[names[row]])
                lo, hi = (x[here] for x in own_range(places, hashes, len(text)))
                place = places[here]
                for first in range(0, REACH + 1, SEGMENT):
                    last = min(first + SEGMENT - 1, REACH)
                    a, b = np.maximum(lo, first), np.minimum(hi, last)
                    some = a <= b
                    if some.any():
                        p = place[some]
                        key = mixed(range_hashes(text, p - first, p + LENGTH - last) + np.uint64(first))
                        yield from members.add(key, np.full(len(p), names[row]), p, a[some], b[some])
        yield from members.sent()

    sent = anchored.select("text_id", "text", "places").mapInArrow(send, _Members.schema(_SEGMENTS))
    return _added_up(sent, n_blocks, _SEGMENTS, "segments", "text_id long, " + ", ".join(f"{c} binary" for c in _SEGMENTS), lambda batch: batch)


_STARTS = {"start": np.uint32}


def covering(strings: dict[str, np.ndarray]) -> np.ndarray:
    """Which strings of (text_id, start) are enough to cover the bytes of all: of a chain of neighbouring starts the first, the
    last, and every one a length further on."""
    order = np.lexsort((strings["start"], strings["text_id"]))
    text_id, start = strings["text_id"][order], strings["start"][order].astype(np.int64)
    first = np.r_[True, (text_id[1:] != text_id[:-1]) | (start[1:] > start[:-1] + 1)]
    begin = start[np.maximum.accumulate(np.where(first, np.arange(len(start)), 0))]
    return order[first | np.r_[first[1:], True] | ((start - begin) % LENGTH == 0)]


def often_spans(marked: DataFrame, n_blocks: int) -> DataFrame:
    """(text_id, start, end) of repeats around often grams, packed; ``marked`` has (text_id, text, place, low, high), each text once."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = _Members(_STARTS, n_blocks, covering)
        for batch in batches:
            data, at = bytes_of(batch.column("text"))
            columns = (batch.column(c).to_pylist() for c in ("text_id", *_SEGMENTS))
            for row, (name, *packed) in enumerate(zip(*columns, strict=True)):
                text = data[at[row] : at[row + 1]]
                place, lo, hi = (np.frombuffer(b"".join(x), t).astype(np.int64) for x, t in zip(packed, _SEGMENTS.values(), strict=True))
                for some in range(0, len(place), 8192):
                    low, high = lo[some : some + 8192], hi[some : some + 8192]
                    width = high - low + 1
                    p = np.repeat(place[some : some + 8192], width)
                    s = np.arange(len(p)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(low, width)
                    key = mixed(range_hashes(text, p - s, p - s + LENGTH) + s.astype(np.uint64))
                    yield from members.add(key, np.full(len(p), name), p - s)
        yield from members.sent()

    def ended(batch: pa.RecordBatch) -> pa.RecordBatch:
        starts, ends = [], []
        for packed in batch.column("start").to_pylist():
            a, b = merged(np.frombuffer(packed, np.uint32).astype(np.int64))
            starts.append(a.astype(np.uint32).tobytes())
            ends.append(b.astype(np.uint32).tobytes())
        return pa.RecordBatch.from_arrays([batch.column("text_id"), pa.array(starts, pa.binary()), pa.array(ends, pa.binary())], names=["text_id", "start", "end"])

    sent = marked.select("text_id", "text", *_SEGMENTS).mapInArrow(send, _Members.schema(_STARTS))
    return _added_up(sent, n_blocks, _STARTS, "strings", _SPANS, ended)


_SPANS = "text_id long, start binary, end binary"


def merged(start: np.ndarray, end: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs that ranges cover; without ends they are strings of the length."""
    end = start + LENGTH if end is None else end
    order = np.argsort(start, kind="stable")
    start, upto = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.r_[True, start[1:] > upto[:-1]]) if len(start) else np.zeros(0, np.int64)
    return start[first], upto[np.r_[first[1:] - 1, len(start) - 1]] if len(first) else upto


def repeated_anchors(texts: DataFrame, n_blocks: int, often: np.ndarray, most: int = MOST_ANCHORS) -> DataFrame:
    """(text_id, often, places): anchors of a text whose gram occurs elsewhere too, without those of the grams given as often.

    Those of grams that prove to occur more than ``most`` times are marked as often.
    """
    shared = texts.sparkSession.sparkContext.broadcast(often)
    kinds = {"gram": np.uint64, "text_id": np.int64, "place": np.uint32}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = _Once()
        for batch in batches:
            data, at = bytes_of(batch.column("text"))
            names = batch.column("text_id").to_pylist()
            parts = []
            for row, places, hashes in row_anchors(data, at):
                if once(names[row]):
                    rest = ~_is_often(hashes, shared.value)
                    parts.append((hashes[rest], np.full(int(rest.sum()), names[row]), places[rest].astype(np.uint32)))
            if parts:
                gram, text_id, place = (np.concatenate(c) for c in zip(*parts, strict=True))
                yield _dealt((gram % np.uint64(n_blocks)).astype(np.int64), {"gram": gram, "text_id": text_id, "place": place})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _blocks(batches, kinds):
            order = np.lexsort((c["place"], c["text_id"], c["gram"]))
            gram, text_id, place = c["gram"][order], c["text_id"][order], c["place"][order]
            fresh = np.r_[True, (gram[1:] != gram[:-1]) | (text_id[1:] != text_id[:-1]) | (place[1:] != place[:-1])]
            gram, text_id, place = gram[fresh], text_id[fresh], place[fresh]
            begin = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
            n = np.diff(np.r_[begin, len(gram)])
            for kind, chosen in ((False, (n > 1) & (n <= most)), (True, n > most)):
                again = np.repeat(chosen, n)
                if again.any():
                    columns = [pa.array(text_id[again], pa.int64()), pa.array(place[again].astype(np.int64)), pa.array(np.full(int(again.sum()), kind))]
                    yield pa.RecordBatch.from_arrays(columns, names=["text_id", "place", "often"])

    sent = texts.select("text_id", "text").mapInArrow(send, "block long, gram binary, text_id binary, place binary")
    found = _together(sent, n_blocks).mapInArrow(meet, "text_id long, place long, often boolean")
    return found.groupBy("text_id", "often").agg(F.collect_list("place").alias("places"))


def repeated_spans(anchored: DataFrame, n_blocks: int) -> DataFrame:
    """(text_id, start, end) of repeats around anchors, packed; ``anchored`` has (text_id, text, places)."""
    kinds = {"gram": np.uint64, "text_id": np.int64, "place": np.uint32, "n_left": np.uint16, "n_right": np.uint16, "bytes": np.uint8}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = bytes_of(batch.column("text"))
            names, places = batch.column("text_id").to_pylist(), batch.column("places").to_pylist()
            parts: list[tuple] = []
            size = 0
            for row, (name, own) in enumerate(zip(names, places, strict=True)):
                text = data[at[row] : at[row + 1]]
                for lo in range(0, len(own), 2048):
                    place = np.array(own[lo : lo + 2048], np.int64)
                    padded = np.zeros((len(place), REACH + LENGTH), np.uint8)
                    n_left, n_right = np.minimum(place, REACH), np.minimum(len(text) - place, LENGTH)
                    for i, p in enumerate(place.tolist()):
                        padded[i, REACH - n_left[i] : REACH + n_right[i]] = text[p - n_left[i] : p + n_right[i]]
                    parts.append((range_hashes(text, place, place + GRAM), np.full(len(place), name), place, n_left, n_right, padded))
                    size += len(place)
                    if size >= 4096:
                        yield rows(parts)
                        parts, size = [], 0
            if parts:
                yield rows(parts)

    def rows(parts: list[tuple]) -> pa.RecordBatch:
        gram, text_id, place, n_left, n_right, padded = (np.concatenate(c) for c in zip(*parts, strict=True))
        columns = {"gram": gram, "text_id": text_id, "place": place.astype(np.uint32), "n_left": n_left.astype(np.uint16), "n_right": n_right.astype(np.uint16), "bytes": padded}
        return _dealt((gram % np.uint64(n_blocks)).astype(np.int64), columns)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _blocks(batches, kinds):
            around = c["bytes"].reshape(-1, REACH + LENGTH)
            left = np.ascontiguousarray(around[:, REACH - 1 :: -1])
            least, most = expand(c["gram"], left, np.ascontiguousarray(around[:, REACH:]), c["n_left"].astype(np.int64), c["n_right"].astype(np.int64))
            hit = most >= 0
            if hit.any():
                place = c["place"].astype(np.int64)[hit]
                ranges = {"start": (place - most[hit]).astype(np.uint32), "end": (place - least[hit] + LENGTH).astype(np.uint32)}
                yield _dealt(c["text_id"][hit], ranges).rename_columns(["text_id", "start", "end"])

    sent = anchored.select("text_id", "text", "places").mapInArrow(send, "block long, " + ", ".join(f"{c} binary" for c in kinds))
    return _together(sent, n_blocks).mapInArrow(meet, _SPANS)


def cut(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[bytes, int, int]:
    """What is left without the ranges, removed bytes, and maximal removed runs."""
    start, end = merged(start, end)
    bounds = np.r_[0, np.stack([start, end], axis=1).ravel(), len(data)].tolist()
    kept = b"".join(data[a:b].tobytes() for a, b in zip(bounds[::2], bounds[1::2], strict=True))
    return kept, int((end - start).sum()), len(start)


def deduplicated(docs: DataFrame, most: int = MOST_ANCHORS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256) of every row.

    ``kept`` holds the remaining bytes of texts from which a part was removed; it is null where nothing or all was.
    """
    texts = _texts(docs)
    rows = stored(texts.select("doc_id", "sha", "text_id", F.octet_length("text").cast("long").alias("n_bytes")), "texts")
    kinds = stored(rows.groupBy("text_id").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")), "copies")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    expected = 2 * total / (REACH + 2)
    n_blocks = max(1, math.ceil(expected / (16 * BLOCK_ANCHORS)))
    often = often_grams(texts, n_blocks, most)
    found = stored(repeated_anchors(texts, n_blocks, often, most), "anchors")
    sizes = {r["often"]: r["n"] for r in found.groupBy("often").agg(F.sum(F.size("places")).alias("n")).collect()}

    def one_of_each(keyed: DataFrame) -> DataFrame:
        """Texts with ``keyed``'s columns, from one row of equal texts."""
        wanted = keyed.join(kinds, "text_id")
        return texts.join(wanted, (texts["text_id"] == wanted["text_id"]) & texts["doc_id"].eqNullSafe(wanted["first_id"])).drop(texts["text_id"]).drop("doc_id", "sha", "first_id")

    n_anchors = sizes.get(False, 0)
    spans = stored(repeated_spans(one_of_each(found.where("NOT often")), max(1, math.ceil(n_anchors / BLOCK_ANCHORS))), "spans")
    if len(often) or True in sizes:
        places = found.where("often")
        if len(often):
            places = places.unionByName(often_places(texts, often))
        places = stored(places.groupBy("text_id").agg(F.flatten(F.collect_list("places")).alias("places")), "often-places")
        n_often = places.agg(F.sum(F.size("places"))).first()[0] or 0
        often_blocks = max(1, math.ceil(9 * n_often / (8 * COUNT_MEMBERS)))
        segments = often_segments(one_of_each(places), often_blocks)
        marked = stored(segments.groupBy("text_id").agg(*[F.collect_list(c).alias(c) for c in _SEGMENTS]), "marks")
        spans = spans.unionByName(stored(often_spans(one_of_each(marked), often_blocks), "often-spans"))
    by_text = spans.groupBy("text_id").agg(F.collect_list("start").alias("start"), F.collect_list("end").alias("end"))
    partial = one_of_each(by_text).where("copies = 1")
    schema = T.StructType([T.StructField("text_id", LONG), T.StructField("kept", BINARY), T.StructField("removed", LONG), T.StructField("runs", LONG)])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = bytes_of(batch.column("text"))
            packed = zip(*(batch.column(c).to_pylist() for c in ("start", "end")), strict=True)
            ranges = [[np.frombuffer(b"".join(x), np.uint32).astype(np.int64) for x in pair] for pair in packed]
            out = [cut(data[at[i] : at[i + 1]], *pair) for i, pair in enumerate(ranges)]
            yield pa.RecordBatch.from_arrays([batch.column("text_id"), pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64())], names=schema.names)

    removed = partial.select("text_id", "text", "start", "end").mapInArrow(remove, schema)
    removed = removed.withColumn("kept_sha", F.sha2("kept", 256)).dropDuplicates(["text_id"])
    # A text with many copies is a hot key: its rows meet their mark under a salt, and go past the join with partial removals.
    several = kinds.where("copies > 1").select("text_id", F.lit(True).alias("several"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    spread = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(several, ["text_id", "salt"], "left").drop("salt")
    everything = F.col("several").isNotNull() & (F.col("n_bytes") >= LENGTH)
    alone = spread.where("several IS NULL").join(removed, "text_id", "left")
    joined = alone.unionByName(spread.where("several IS NOT NULL"), allowMissingColumns=True)
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(everything, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(everything, F.lit(1)).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(~everything, F.col("kept")).alias("kept"),
        F.when(everything, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
    )
