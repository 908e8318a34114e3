"""Conversation structure repair: bidirectional Dijkstra over the edit lattice of a conversation.

A repaired conversation has turns whose roles begin like ``(s?(ua)+)?``. Edits and costs: Keep 0, Rerole to user or assistant
3, Delete 4, Insert an empty turn 3; blank turns and repeated ones must go, a truncated turn that stays adds 3. The lattice
has a node for each number of turns read and each state of that grammar; an edit is an edge. Two searches, one
from the begin and one from the end, settle nodes by cost, then by turns read, so that edges without cost are passed in
order and a node's least audit is known when it settles. They end when no path as cheap as the best one can be unseen; among
all crossings of that cost, nodes and edges, the least concatenation of both audits wins.

The lattice depends on the turns' kinds alone, one letter each. These letters, without any text, are dealt out by ranges of
(conversation, turn) and cut into segments, so that a conversation with a third of all turns is many segments in many
tasks. A whole conversation in one segment, the common case, is solved at once (equal ones of a task once). Segments of longer ones
are solved between each pair of states at their ends; Insert belongs to the turn read next, so that of two audits of a segment
none begins the other, and least audits of segments make up the least audit. One pass over a conversation's costs and ranks,
32 small numbers a segment, then picks the states. The texts move once, behind the audit, through one formatter for
each conversation that holds a turn and one letter for each turn.

Defined cases: turns go by number (null first), ties by role, then by digest of role and text; of equal rows the first is
none seen earlier; a null conv_id is a conversation; null roles and texts are read as one space; a role of no letters begins like no
role; roles with other initials can be reroled or deleted; long texts pass one at a time; columns beside conv_id, turn, role and
text are ignored, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from remitlens.llm.common import LONG, SPACES, STRING
from remitlens.storage import stored

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3
ROLES = {"u": "user", "a": "assistant"}
#: Grammar: from each state, the initials that may follow and the states they lead to. 0: nothing yet; 3: may end, as may 0.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
STATES, ENDS = 4, (0, 3)
_BEFORE = tuple([(q, c) for q in range(STATES) for c, to in NEXT[q].items() if to == state] for state in range(STATES))
#: What ends a conversation from each state: two, one or no Inserts.
TAIL = ("", INSERT * 2, INSERT, "")
#: Letters of turns: initial of the role (o: none of s, u, a) in lower case, in upper case if truncated; x: must go.
GONE = "x"
LEGAL = ("su", "ua", "au")
SEGMENT = 512
SALTS = 16


def _edges(i: int, q: int, kinds: str, tail: bool) -> Iterator[tuple[int, int, int, str]]:
    """(turns read, state, cost, letter) after each edit at a node."""
    if i < len(kinds) or tail:
        for c, to in NEXT[q].items():
            if c in ROLES:
                yield i, to, COST[INSERT], INSERT
    if i < len(kinds):
        yield i + 1, q, COST[DELETE], DELETE
        if kinds[i] != GONE:
            own, more = kinds[i].lower(), TRUNCATED if kinds[i].isupper() else 0
            for c, to in NEXT[q].items():
                if c == own:
                    yield i + 1, to, COST[KEEP] + more, KEEP
                if c in ROLES:
                    yield i + 1, to, COST[REROLE] + more, REROLE


def _back_edges(i: int, q: int, kinds: str, tail: bool) -> Iterator[tuple[int, int, int, str]]:
    """(turns read, state, cost, letter) before each edit that leads to a node."""
    if i < len(kinds) or tail:
        for before, c in _BEFORE[q]:
            if c in ROLES:
                yield i, before, COST[INSERT], INSERT
    if i > 0:
        yield i - 1, q, COST[DELETE], DELETE
        kind = kinds[i - 1]
        if kind != GONE:
            own, more = kind.lower(), TRUNCATED if kind.isupper() else 0
            for before, c in _BEFORE[q]:
                if c == own:
                    yield i - 1, before, COST[KEEP] + more, KEEP
                if c in ROLES:
                    yield i - 1, before, COST[REROLE] + more, REROLE


class _Side:
    """One of the two searches: labels (cost, audit) of nodes, and which of them are settled."""

    def __init__(self, sources: list[tuple[int, int]], edges, sign: int, kinds: str, tail: bool):
        self.sources = set(sources)
        self.labels = dict.fromkeys(sources, (0, ""))
        self.heap = sorted((0, sign * i, q) for i, q in sources)
        self.settled: set[tuple[int, int]] = set()
        self.edges, self.sign, self.kinds, self.tail = edges, sign, kinds, tail

    def top(self) -> int | None:
        while self.heap and (self.sign * self.heap[0][1], self.heap[0][2]) in self.settled:
            heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def settle(self, other: _Side) -> int | None:
        """Settle the next node and label its neighbours; the least cost of a crossing that this shows."""
        cost, at, q = heappop(self.heap)
        node = (self.sign * at, q)
        self.settled.add(node)
        audit, best = self.labels[node][1], None
        if node in other.labels:
            best = cost + other.labels[node][0]
        for i, to, price, letter in self.edges(*node, self.kinds, self.tail):
            near = (i, to)
            label = (cost + price, audit + letter if self.sign > 0 else letter + audit)
            if near not in self.labels or label < self.labels[near]:
                if near not in self.labels or label[0] < self.labels[near][0]:
                    heappush(self.heap, (label[0], self.sign * i, to))
                self.labels[near] = label
            if near in other.labels:
                whole = label[0] + other.labels[near][0]
                best = whole if best is None else min(best, whole)
        return best


def cheapest(kinds: str, begin: int = 0, ends: tuple[int, ...] = ENDS, tail: bool = True) -> tuple[int, str] | None:
    """Least cost, and the least audit of that cost, from state ``begin`` to one of ``ends`` over all turns.

    ``tail`` allows Inserts behind the last turn. None if no edits lead there.
    """
    forth = _Side([(0, begin)], _edges, 1, kinds, tail)
    back = _Side([(len(kinds), q) for q in ends], _back_edges, -1, kinds, tail)
    best: int | None = None
    while (f := forth.top()) is not None and (b := back.top()) is not None and (best is None or f + b <= best):
        found = forth.settle(back) if f <= b else back.settle(forth)
        if found is not None and (best is None or found < best):
            best = found
    if best is None:
        return None
    for side in (forth, back):  # sources have their labels for good, if the search ended before it came to them
        side.settled |= side.sources
    audits = []
    for node in forth.settled:
        cost, audit = forth.labels[node]
        if node in back.settled and cost + back.labels[node][0] == best:
            audits.append(audit + back.labels[node][1])
        for i, to, price, letter in _edges(*node, kinds, tail):
            if (i, to) in back.settled and cost + price + back.labels[(i, to)][0] == best:
                audits.append(audit + letter + back.labels[(i, to)][1])
    return best, min(audits)


@lru_cache(maxsize=1 << 14)
def _whole(kinds: str) -> tuple[int, str]:
    return cheapest(kinds)


def between(kinds: str) -> list[tuple[int, str] | None]:
    """``cheapest`` of a segment for each pair of states, begin by begin, without Inserts behind it."""
    return [cheapest(kinds, a, (b,), False) for a in range(STATES) for b in range(STATES)]


def picks(costs: list[list[int | None]], orders: list[list[int]]) -> list[int]:
    """For each segment of a conversation the pair of states on the cheapest, then least, way.

    ``orders`` rank the audits of a segment among those with the same begin.
    """
    rest = [[COST[INSERT] * len(t) for t in TAIL]]
    for own in reversed(costs):
        rest.append([min((c + rest[-1][b] for b in range(STATES) if (c := own[STATES * a + b]) is not None), default=1 << 60) for a in range(STATES)])
    rest.reverse()
    out, a = [], 0
    for own, order, before, after in zip(costs, orders, rest[:-1], rest[1:], strict=True):
        pairs = [STATES * a + b for b in range(STATES) if own[STATES * a + b] is not None and own[STATES * a + b] + after[b] == before[a]]
        out.append(min(pairs, key=order.__getitem__))
        a = out[-1] % STATES
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with turns dropped, emptied, stripped, repeated or given to the user, by a checksum of their place."""
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    draw = F.crc32(place.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), draw.alias("_draw"))
    text = F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_draw") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("_draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where("_draw <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_time")).drop("_time")


def _keyed(conversations: DataFrame) -> DataFrame:
    """(conv, conv_id, turn, role, text, digest); conv is conv_id as a text that is never null."""
    space = F.lit(" ")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    return rows.select(_name(), "*", digest.alias("digest"))


def _name() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv")


_ORDER = ("turn", "role", "digest")


def _turns(keyed: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, initial, fault) without texts; fault is blank, duplicate, truncated or null.

    Duplicates are those of an earlier turn number; equal rows of one number come next to each other later on. A digest
    in many turns of one conversation is counted with partial sums and joined under a salt.
    """
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    blank = end == ""
    first = F.substring("role", 1, 1)
    initial = F.when(first.isin("s", "u", "a"), first).otherwise("o")
    rows = keyed.select("conv", *_ORDER, initial.alias("initial"), blank.alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("open"))
    rows = stored(rows, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    firsts = rows.where("NOT blank").groupBy("conv", "digest").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")
    firsts = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = rows.withColumn("salt", F.pmod(F.xxhash64("turn"), F.lit(SALTS)).cast("int")).join(firsts, ["conv", "digest", "salt"], "left")
    fault = F.when(F.col("blank"), "blank").when(place > F.col("first"), "duplicate").when(F.col("open"), "truncated")
    return met.select("conv", *_ORDER, "initial", fault.alias("fault"))


_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _segments(turns: DataFrame, length: int) -> DataFrame:
    """(conv, part, seq, kinds, first, last, counts): runs of at most ``length`` turns, in order of (part, seq)."""
    fields = (("conv", STRING), ("part", LONG), ("seq", LONG), ("kinds", STRING), ("first", STRING), ("last", STRING), *((c, LONG) for c in _COUNTS))
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    kinds_of = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *(pa.int64() for _ in _COUNTS))
    names = [n for n, _ in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        now, kinds, first, last, counts = None, [], "", "", dict.fromkeys(_COUNTS, 0)
        before = None
        out: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds_of)], names=names)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv", "turn", "digest", "initial", "fault"))
            for conv, turn, digest, initial, fault in zip(*columns, strict=True):
                if kinds and (conv != now or len(kinds) >= length):
                    out.append((now, part, seq, "".join(kinds), first, last, *counts.values()))
                    seq, kinds, counts = seq + 1, [], dict.fromkeys(_COUNTS, 0)
                if not kinds:
                    first = initial
                elif last + initial not in LEGAL:
                    counts["illegal"] += 1
                if fault != "blank" and before == (conv, turn, digest):
                    fault = "duplicate"
                if fault:
                    counts[fault] += 1
                kinds.append(initial if fault is None else initial.upper() if fault == "truncated" else GONE)
                now, last, before = conv, initial, (conv, turn, digest)
            if len(out) >= 4096:
                yield batch_of(out)
                out = []
        if kinds:
            out.append((now, part, seq, "".join(kinds), first, last, *counts.values()))
        yield batch_of(out)

    return turns.repartitionByRange("conv", *_ORDER).sortWithinPartitions("conv", *_ORDER).mapInArrow(run, schema)


def _solved(segments: DataFrame) -> DataFrame:
    """(conv, part, seq, whole, costs, orders, audits) of segments; a whole conversation has one cost and one audit."""
    schema = "conv string, part long, seq long, whole boolean, costs array<long>, orders array<long>, audits array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs, orders, audits = [], [], []
            for kinds, whole in zip(batch.column("kinds").to_pylist(), batch.column("whole").to_pylist(), strict=True):
                found = [_whole(kinds)] if whole else between(kinds)
                costs.append([f and f[0] for f in found])
                audits.append([f and f[1] for f in found])
                place = {audit: i for i, audit in enumerate(sorted({f[1] for f in found if f}))}
                orders.append([place[f[1]] if f else None for f in found])
            new = (pa.array(costs, pa.list_(pa.int64())), pa.array(orders, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "part", "seq", "whole")), *new], names=["conv", "part", "seq", "whole", "costs", "orders", "audits"])

    return segments.select("conv", "part", "seq", "kinds", "whole").mapInArrow(run, schema)


def _picked(solved: DataFrame) -> DataFrame:
    """(conv, part, seq, pick, tail): the pair of states of each segment, and the Inserts that end the last one."""
    names = ["conv", "part", "seq", "pick", "tail"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, []

        def done() -> pa.RecordBatch:
            chosen = picks([r[2] for r in own], [r[3] for r in own])
            tails = [""] * (len(own) - 1) + [TAIL[chosen[-1] % STATES]]
            columns = ([now] * len(own), [r[0] for r in own], [r[1] for r in own], chosen, tails)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=names)

        for batch in batches:
            for conv, *row in zip(*(batch.column(c).to_pylist() for c in ("conv", "part", "seq", "costs", "orders")), strict=True):
                if conv != now:
                    if own:
                        yield done()
                    now, own = conv, []
                own.append(row)
        if own:
            yield done()

    rows = solved.select("conv", "part", "seq", "costs", "orders").repartition("conv").sortWithinPartitions("conv", "part", "seq")
    return rows.mapInArrow(run, "conv string, part long, seq long, pick long, tail string")


def repairs(conversations: DataFrame, length: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """What is wrong with each conversation, and its cheapest edits.

    First (conv, blank, duplicate, truncated, illegal, cost, audit), a row for each conversation; then (conv, part, seq,
    audit, cost), the audits in pieces of bounded size, from which ``repaired`` makes the turns.
    """
    cut = stored(_segments(stored(_turns(_keyed(conversations)), "turn-faults"), length), "segments")
    several = cut.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select("conv", F.lit(False).alias("whole"))
    marked = cut.join(several, "conv", "left").withColumn("whole", F.coalesce("whole", F.lit(True)))
    solved = stored(_solved(marked.repartition("conv", "part", "seq")), "solved")
    alone = solved.where("whole").select("conv", "part", "seq", F.col("audits")[0].alias("audit"), F.col("costs")[0].alias("cost"))
    met = solved.where("NOT whole").join(_picked(solved.where("NOT whole")), ["conv", "part", "seq"])
    at = (F.col("pick") + 1).cast("int")
    pieces = met.select("conv", "part", "seq", F.concat(F.element_at("audits", at), "tail").alias("audit"), (F.element_at("costs", at) + COST[INSERT] * F.length("tail")).alias("cost"))
    pieces = stored(alone.unionByName(pieces), "audits")
    order = Window.partitionBy("conv").orderBy("part", "seq")
    joint = F.concat(F.lag("last").over(order), "first")
    counts = cut.withColumn("illegal", F.col("illegal") + F.when(joint.isNull() | joint.isin(*LEGAL), 0).otherwise(1))
    counts = counts.groupBy("conv").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "seq", "audit"))), lambda p: p["audit"]), "")
    return counts.join(pieces.groupBy("conv").agg(F.sum("cost").alias("cost"), joined.alias("audit")), "conv"), pieces


def gaps(conversations: DataFrame) -> DataFrame:
    """(conv, gaps): turn numbers between the least and the greatest that no turn has."""
    numbers = conversations.select(_name(), "turn").where("turn IS NOT NULL").groupBy("conv", "turn").agg(F.lit(1).alias("_one"))
    return numbers.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).cast("long").alias("gaps"))


class _Editor:
    """Edits one conversation as its turns stream by: the audit first, then turn by turn."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id, self.audit, self.pieces = conv_id, "", []
        self.at = self.state = self.position = 0

    def _said(self, role: str, text: str) -> tuple:
        self.state = NEXT[self.state][role[0]]
        self.position += 1
        return self.conv_id, self.position - 1, role, text

    def _due(self) -> str:
        return ROLES[next(c for c in ROLES if c in NEXT[self.state])]

    def inserted(self) -> Iterator[tuple]:
        if self.pieces:
            self.audit, self.pieces = "".join(self.pieces), []
        while self.audit[self.at : self.at + 1] == INSERT:
            self.at += 1
            yield self._said(self._due(), "")

    def turn(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != DELETE:
            yield self._said(role if edit == KEEP else self._due(), text)


def repaired(conversations: DataFrame, pieces: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): turns after the edits of ``pieces``, together and in order for each conversation."""
    key = conversations.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", key), T.StructField("position", LONG), T.StructField("role", STRING), T.StructField("text", STRING)])
    names, none = schema.names, F.lit(None)
    turns = _keyed(conversations).withColumns({"is_turn": F.lit(True), "part": none.cast("long"), "seq": none.cast("long"), "audit": none.cast("string")})
    # Every piece names its conversation, so that Inserts have one too.
    ids = conversations.select(_name(), "conv_id").distinct()
    edits = pieces.join(ids, "conv").select("conv", "conv_id", "part", "seq", "audit", F.lit(False).alias("is_turn"))
    rows = turns.unionByName(edits, allowMissingColumns=True).repartition("conv").sortWithinPartitions("conv", "is_turn", "part", "seq", *_ORDER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, editor, out = None, None, []
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for conv, conv_id, is_turn, role, text, piece in zip(*(batch.column(c).to_pylist() for c in ("conv", "conv_id", "is_turn", "role", "text", "audit")), strict=True):
                if conv != now:
                    if editor:
                        out.extend(editor.inserted())
                    now, editor = conv, _Editor(conv_id)
                if is_turn:
                    out.extend(editor.turn(role, text))
                else:
                    editor.pieces.append(piece)
            yield _batch(out, kind, names)
            out = []
        if editor:
            yield _batch(list(editor.inserted()), kind, names)

    return rows.mapInArrow(run, schema)


def _batch(rows: list[tuple], key: pa.DataType, names: list[str]) -> pa.RecordBatch:
    kinds = (key, pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def digests(turns: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): digest of ``role:text`` lines of each conversation that has turns left, as ``repaired`` leaves them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            out = []
            for conv, position, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "position", "role", "text")), strict=True):
                if conv != now:
                    if digest:
                        out.append((now, digest.hexdigest()))
                    now, digest = conv, hashlib.sha256()
                digest.update(f"{chr(10) if position else ''}{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.string()) for i in (0, 1)], names=["conv", "repaired_sha256"])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], names=["conv", "repaired_sha256"])

    return turns.select(_name(), "position", "role", "text").mapInArrow(run, "conv string, repaired_sha256 string")


def report(original: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation of ``original``.

    ``rows`` are the turns that are left of it; conversations without any have zeros and an empty audit.
    """
    wrong, pieces = repairs(rows)
    out = original.select("conv_id").distinct().select("conv_id", _name())
    for found in (gaps(rows), wrong, digests(repaired(rows, pieces))):
        out = out.join(found, "conv", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *_COUNTS, "cost")]
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
