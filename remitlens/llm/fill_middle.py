"""Fill-in-the-middle transformation with a sparse exception index.

A text is cut twice, at units (lines or code points) that a hash of its id draws, and written as ``<P>`` prefix ``<S>``
suffix ``<M>`` middle, or suffix first. Texts are worked on as the UTF-8 bytes they are. An exception index holds, for the
characters of more than one byte alone, where they stand and how many bytes they have in excess, as a running sum. A cut
at byte b is at code point b less the excess before it, one at code point c at byte c plus the excess before it; both
look the sum up with a binary search among the exceptions. Spans of ASCII need nothing but the subtraction.

A text that holds a sentinel stays plain, so a sentinel in an output is structure: none can arise across a joint, since
sentinels begin with their only ``<``. ``restored`` rebuilds the exact text from output and form.

Every row is a job of its own: no shuffle, and a task holds a batch of rows and the exceptions of a few texts.

Defined cases: null and empty texts are plain and have no units; a null id draws as the empty text; a last line without line
feed is a line; long texts are taken whole, one at a time; ties and repeated rows do not arise as rows do not meet; columns
of the input under the names that are added are replaced, all others stay; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.llm.arrow import bytes_of, steps
from remitlens.llm.common import LONG, STRING, without

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")
_DRAWS = ("_draw1", "_draw2", "_draw3", "_draw4")
_LINE_FEED = 10


class Exceptions:
    """The multibyte characters of some bytes: their places, and the running sum of their excess bytes."""

    def __init__(self, data: np.ndarray):
        self.places = np.flatnonzero(data >= 0xC0)
        lead = data[self.places]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate([np.zeros(1, np.int64), np.cumsum(excess)])
        self.points = self.places - self.before[:-1]

    def point_of(self, byte: np.ndarray) -> np.ndarray:
        """Code points before each byte place; the places begin characters."""
        return byte - self.before[np.searchsorted(self.places, byte)]

    def byte_of(self, point: np.ndarray) -> np.ndarray:
        """Bytes before each code point."""
        return point + self.before[np.searchsorted(self.points, point)]


def sentinel_rows(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which rows hold a sentinel."""
    if len(data) < 3:
        return np.zeros(len(at) - 1, bool)
    kind = np.isin(data[1:-1], np.frombuffer((PREFIX[1] + SUFFIX[1] + MIDDLE[1]).encode(), np.uint8))
    found = np.flatnonzero((data[:-2] == ord("<")) & kind & (data[2:] == ord(">")))
    row = np.searchsorted(at, found, "right") - 1
    out = np.zeros(len(at) - 1, bool)
    out[row[found + 3 <= at[row + 1]]] = True
    return out


class Units:
    """The units of rows of bytes and where they end. ``at`` begins at 0."""

    def __init__(self, data: np.ndarray, at: np.ndarray, unit: str):
        self.at, self.exceptions = at, Exceptions(data)
        self.points = self.exceptions.point_of(at)
        self.feeds = None
        if unit == "line":
            self.feeds = np.flatnonzero(data == _LINE_FEED)
            self.first = np.searchsorted(self.feeds, at)
            open_end = at[1:] > at[:-1]
            open_end[open_end] = data[at[1:][open_end] - 1] != _LINE_FEED
            self.n = np.diff(self.first) + open_end
        else:
            self.n = np.diff(self.points)

    def ends(self, k: np.ndarray) -> np.ndarray:
        """Byte at which the k-th unit of each row ends; its begin for 0."""
        if self.feeds is None:
            return self.exceptions.byte_of(self.points[:-1] + k)
        feed = self.first[:-1] + k - 1
        inside = (k > 0) & (feed < self.first[1:])
        out = np.where(k > 0, self.at[1:], self.at[:-1])
        out[inside] = self.feeds[feed[inside]] + 1
        return out


def _draws(seed: int) -> dict[str, Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return {name: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i, name in enumerate(_DRAWS)}


def transformed(docs: DataFrame, unit: str = "line", seed: int = 7, rate: int = 100, suffix_first: int = 50) -> DataFrame:
    """``docs`` with n (units), form, prefix_chars, middle_chars and output.

    ``rate`` percent of the texts are transformed, ``suffix_first`` percent of these with the suffix first.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unit is line or char, not {unit}")
    base = without(docs, *ADDED)
    schema = T.StructType([*base.schema, *(T.StructField(c, STRING if c in ("form", "output") else LONG) for c in ADDED)])
    where, width, names = base.columns.index("text"), len(base.columns), schema.names
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = bytes_of(batch.column(where))
            draws = [batch.column(width + i).to_numpy() for i in range(4)]
            for lo, hi in steps(at):
                own = data[at[lo] : at[hi]]
                begin = at[lo : hi + 1] - at[lo]
                units = Units(own, begin, unit)
                h1, h2, h3, h4 = (d[lo:hi] for d in draws)
                c1, c2 = h1 % (units.n + 1), h2 % (units.n + 1)
                a, b = units.ends(np.minimum(c1, c2)), units.ends(np.maximum(c1, c2))
                plain = (begin[1:] == begin[:-1]) | sentinel_rows(own, begin) | (h3 % 100 >= rate)
                late = h4 % 100 < suffix_first
                point = units.exceptions.point_of
                prefix, middle = point(a) - units.points[:-1], point(b) - point(a)
                raw, output = own.tobytes(), []
                for x, y, z, w, whole, spm in zip(begin[:-1].tolist(), a.tolist(), b.tolist(), begin[1:].tolist(), plain.tolist(), late.tolist(), strict=True):
                    if whole:
                        output.append(raw[x:w])
                    elif spm:
                        output.append(b"".join((s, raw[z:w], p, raw[x:y], m, raw[y:z])))
                    else:
                        output.append(b"".join((p, raw[x:y], s, raw[z:w], m, raw[y:z])))
                form = np.where(plain, PLAIN, np.where(late, SPM, PSM))
                new = [
                    pa.array(units.n.astype(np.int64)),
                    pa.array(form.tolist(), pa.string()),
                    pa.array(prefix.astype(np.int64), mask=plain),
                    pa.array(middle.astype(np.int64), mask=plain),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ]
                rows = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*rows.columns[:width], *new], names=names)

    return base.select("*", *[c.alias(n) for n, c in _draws(seed).items()]).mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed, from the output alone and its form."""
    length = len(PREFIX)
    p, s, m = (F.instr(output, x) for x in (PREFIX, SUFFIX, MIDDLE))

    def between(begin: Column, end: Column) -> Column:
        return F.substr(output, begin + length, end - begin - length)

    last = F.substr(output, m + length)
    psm = F.concat(between(p, s), last, between(s, m))
    spm = F.concat(between(p, m), last, between(s, p))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
