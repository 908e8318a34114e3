"""Benchmark decontamination by multi-pattern search over words.

The patterns are the windows of ten words of every benchmark text (a shorter text is one window). As in Wu and Manber's
search, a table over blocks of two words tells how far the search may move on without missing a window; where it says 0,
the hash of the block at the end of the window selects the windows that may stand there, and their bytes are compared.
Windows of other lengths than ten are searched apart, so that a short item does not shorten the shifts of all.

Patterns are sent to the tasks in blocks of bounded size; every block is searched in all documents, one after another.

Defined cases: words are runs of ASCII letters and digits and of all other characters, A-Z in lower case; null texts have
no words; a benchmark row without words or id is left out; equal ids of several rows count once; rows of documents are
judged on their own (repeated rows give repeated results); added columns replace columns of the same name.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.llm.arrow import ALNUM, LOWER, appended, bytes_of, range_hashes, steps, words
from remitlens.llm.common import LONG, STRING, shielded, without
from remitlens.storage import stored

WINDOW = 10
#: Text of benchmark items that the driver and each task hold at a time.
BLOCK_BYTES = 2 << 20
#: Words that one cursor walks; longer texts are walked by several at once.
SPAN = 512
_RUN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_ADDED = (
    T.StructField("n_words", LONG),
    T.StructField("hit_runs", T.ArrayType(T.StructType([T.StructField("start", LONG), T.StructField("end", LONG)]))),
    T.StructField("items", T.ArrayType(STRING)),
)


class Patterns:
    """Shift tables and window buckets of one block of items."""

    def __init__(self, items: list[tuple[str, str]]):
        self.windows: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            data = LOWER[np.frombuffer(text.encode(), np.uint8)]
            starts, ends, _ = words(data, np.array([0, len(data)]), ALNUM)
            own = [data[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
            m = min(WINDOW, len(own))
            for i in range(len(own) - m + 1 if m else 0):
                self.windows[m][b" ".join(own[i : i + m])].add(item)
        self.tables = {m: self._table(m, list(found)) for m, found in self.windows.items()}

    @staticmethod
    def _table(m: int, found: list[bytes]) -> tuple[np.ndarray, int, np.ndarray, int]:
        """Shift by block, bits to drop from a block's hash, sorted window hashes, words in a block."""
        data = np.frombuffer(b"\n".join(found), np.uint8)
        starts, ends, _ = words(data, np.array([0, len(data)]), ALNUM)
        hashes = range_hashes(data, starts, ends).reshape(-1, m)
        block = min(2, m)
        bits = min(24, max(10, math.ceil(math.log2(16 * hashes.size))))
        shift = np.full(1 << bits, m - block + 1, np.uint8)
        for end in range(block, m + 1):
            key = blocks(hashes[:, :end].ravel(), np.arange(1, len(hashes) + 1) * end - 1, block) >> np.uint64(64 - bits)
            np.minimum.at(shift, key.astype(np.int64), m - end)
        at = np.arange(len(hashes)) * m
        return shift, 64 - bits, np.unique(range_hashes(hashes.ravel(), at, at + m)), block


def blocks(hashes: np.ndarray, ends: np.ndarray, block: int) -> np.ndarray:
    """Hash of the last ``block`` words up to each position."""
    return hashes[ends] if block == 1 else hashes[ends - 1] * np.uint64(0xD6E8FEB86659FD93) + hashes[ends]


def candidates(hashes: np.ndarray, first: np.ndarray, m: int, table) -> np.ndarray:
    """Last words of places where a window of ``m`` words may stand."""
    shift, drop, known, block = table
    lengths = np.diff(first)
    n_spans = np.where(lengths >= m, -(-lengths // SPAN), 0)
    rows = np.repeat(np.arange(len(lengths)), n_spans)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(n_spans) - n_spans, n_spans)
    span_start, limit = first[rows] + nth * SPAN, first[rows + 1]
    # a span owns the windows that end in it
    cursor = np.maximum(span_start, first[rows] + m - 1)
    stop = np.minimum(span_start + SPAN, limit)
    places = []
    live = cursor < stop
    cursor, stop = cursor[live], stop[live]
    while len(cursor):
        step = shift[(blocks(hashes, cursor, block) >> np.uint64(drop)).astype(np.int64)]
        here = step == 0
        if here.any():
            places.append(cursor[here])
        cursor = cursor + np.maximum(step, 1)
        live = cursor < stop
        cursor, stop = cursor[live], stop[live]
    if not places:
        return np.zeros(0, np.int64)
    ends = np.sort(np.concatenate(places))
    window = range_hashes(hashes, ends - (m - 1), ends + 1)
    near = known[np.minimum(np.searchsorted(known, window), len(known) - 1)]
    return ends[near == window]


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def search(data: np.ndarray, at: np.ndarray, patterns: Patterns) -> tuple[np.ndarray, dict[int, tuple[list, set]]]:
    """Words of each row; for rows with hits their runs of words and items."""
    data = LOWER[data]
    starts, ends, first = words(data, at, ALNUM)
    found: dict[int, tuple[list, set]] = {}
    if len(starts) == 0:
        return np.diff(first), found
    hashes = range_hashes(data, starts, ends)
    for m, table in patterns.tables.items():
        known = patterns.windows[m]
        for end in candidates(hashes, first, m, table).tolist():
            text = b" ".join(data[starts[k] : ends[k]].tobytes() for k in range(end - m + 1, end + 1))
            if items := known.get(text):
                row = int(np.searchsorted(first, end, "right")) - 1
                runs, names = found.setdefault(row, ([], set()))
                begin = end - m + 1 - int(first[row])
                runs.append((begin, begin + m))
                names |= items
    return np.diff(first), found


def _scan(df: DataFrame, items: list[tuple[str, str]], again: bool) -> DataFrame:
    """``df`` with the hits of one block of items; ``again``: it has those of earlier blocks."""
    sent = df.sparkSession.sparkContext.broadcast(items)
    names = [f.name for f in _ADDED]
    schema = T.StructType([*(f for f in df.schema if not (again and f.name in names)), *_ADDED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns(sent.value)
        for batch in batches:
            data, at = bytes_of(batch.column("text"))
            counts = np.zeros(batch.num_rows, np.int64)
            before = zip(batch.column("hit_runs").to_pylist(), batch.column("items").to_pylist(), strict=True) if again else ()
            hits = {i: ([(r["start"], r["end"]) for r in runs], set(own)) for i, (runs, own) in enumerate(before) if runs}
            for lo, hi in steps(at):
                counts[lo:hi], found = search(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], patterns)
                for row, (runs, own) in found.items():
                    have = hits.setdefault(lo + row, ([], set()))
                    have[0].extend(runs)
                    have[1].update(own)
            rest = batch.select([c for c in batch.schema.names if not (again and c in names)])
            runs = [[{"start": s, "end": e} for s, e in merged(hits[i][0])] if i in hits else [] for i in range(batch.num_rows)]
            own = [sorted(hits[i][1]) if i in hits else [] for i in range(batch.num_rows)]
            yield appended(rest, {"n_words": pa.array(counts), "hit_runs": pa.array(runs, pa.list_(_RUN)), "items": pa.array(own, pa.list_(pa.string()))})

    return df.mapInArrow(run, schema)


def with_hits(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, hit_runs (runs of words inside windows, ends exclusive) and items (ids as strings, sorted)."""
    named = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    dealt = named.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    df = without(docs, *[f.name for f in _ADDED])
    for k in range(n):
        items = [(r.item_id, r.text) for r in dealt.where(F.col("_block") == k).select("item_id", "text").collect()]
        df = _scan(stored(df, "decontaminate") if k else df, items, again=k > 0)
    return df


def n_hit() -> Column:
    return F.aggregate("hit_runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any window of a benchmark item, with their own columns."""
    rows, restored = shielded(docs, *[f.name for f in _ADDED])
    return restored(with_hits(rows, benchmark).where(F.size("hit_runs") == 0))
