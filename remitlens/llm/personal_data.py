"""Personal data: fixed patterns, and bootstrapped contextual extraction of what they miss.

The fixed patterns give the base entities. Every identifier-like run of tokens (tokens with a digit or an at sign) is an
instance; instances that a base entity overlaps are seeds of its kind. The words before an instance are its lexical
pattern. Patterns and instances form a weighted graph that is scored in rounds over the whole corpus: a pattern is worth
the share of its occurrences that are instances of a kind, an instance what the patterns it occurs in are worth. Patterns
that enough different seeds support and whose score is high enough mark their other instances as entities of that kind.
After each round, instances that trusted patterns make worth enough are seeds as well, over all their occurrences, until no
new pattern is trusted. An instance right behind another one, without a word between, is in the list of the pattern before;
one that begins its text is in a context of that place.

Only DataFrame expressions are used. What is shuffled is one narrow row for each instance, summed before it moves. A hot
pattern or instance is summed on the map side; joins back to occurrences are left to adaptive execution.

Positions are code points, ends exclusive. Matches come from ``split`` and ``regexp_extract_all`` with one pattern, so that
gaps and matches add up to positions. Running sums over an array of n go by chunks of about the cube root of 2n, n^(4/3) steps in
all. Which base entity an instance overlaps is found by a sort of both by place, not pair by pair. So a text with 50 000
entities takes seconds.

Defined cases: null texts are empty; rows are judged on their own, so repeated rows give repeated results (and count as
often in the graph); null ids stay; columns that carry an added name are replaced; ties between patterns of one score go to the
greater kind; long texts are searched whole; an empty table gives an empty one, without patterns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.llm.common import LONG, let, shielded, without
from remitlens.storage import stored

# The contract's patterns, written so that a search never tries a run of characters again from its middle: a match begins
# at the begin of its run or where the last match ended. Possessive groups keep long matches off the stack.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
#: What a text must hold before a pattern is worth a search.
_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_PATTERN = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE}

_TOKEN = r"[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
_INSTANCE = rf"(?<![^\x20\x09-\x0D]){_TOKEN}(?:\x20{_TOKEN})*+"
_OPENING, _CLOSING = r"^[\x21-\x2A\x2C-\x2F\x3A-\x3F\x5B-\x60\x7B-\x7E]+", r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+$"
CONTEXT_WORDS = 2
#: Code points of a text that are addressed at a time when pieces are cut out of it.
TEXT_CHUNK = 1024
#: Ends the pattern of an instance without words before it; words hold no white space.
LISTED = "\n"
#: Rounds at least; there are more as long as each makes a new pattern trusted.
ROUNDS = 3
LEAST_SEEDS, LEAST_SCORE = 5, 0.8
ADDED = ("base", "found")
_SPANS = "array<struct<start:bigint,end:bigint,kind:string>>"


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast(LONG), lambda a, b: a + b)


def running(values: Column, fold: Callable[[Column], Column], joined: Callable[[Column, Column], Column], body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``body`` of a function that gives, for a place, the ``fold`` of all values of the array (a bound one) before it.

    Folds of whole chunks are computed once; ``joined`` adds that of a part. Chunks of the cube root of 2n make the sum of both
    kinds of work least.
    """

    def chunked(length: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.greatest(F.floor((F.size(values) - 1) / length), F.lit(0)).cast("int"))

        def from_parts(parts: Column) -> Column:
            def from_heads(heads: Column) -> Column:
                def before(i: Column) -> Column:
                    chunk = F.floor(i / length).cast("int")
                    return joined(F.get(heads, chunk), fold(F.slice(values, chunk * length + 1, i % length)))

                return body(before)

            return let(F.transform(chunks, lambda c: fold(F.slice(parts, F.lit(1), c))), from_heads)

        return let(F.transform(chunks, lambda c: fold(F.slice(values, c * length + 1, length))), from_parts)

    return let(F.greatest(F.lit(16), F.ceil(F.cbrt(2 * F.size(values))).cast("int")), chunked)


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, match, gap) of the leftmost non-overlapping matches; gap is the text since the one before."""

    def placed(found: Column) -> Column:
        def from_gaps(gaps: Column) -> Column:
            def from_steps(step: Column) -> Column:
                def from_before(before: Callable[[Column], Column]) -> Column:
                    def one(m: Column, i: Column) -> Column:
                        end = before(i) + F.get(step, i)
                        return F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("match"), F.get(gaps, i).alias("gap"))

                    return F.transform(found, one)

                return running(step, _sum, lambda a, b: a + b, from_before)

            return let(F.transform(found, lambda m, i: (F.length(F.get(gaps, i)) + F.length(m)).cast(LONG)), from_steps)

        return let(F.split(text, pattern, -1), from_gaps)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _luhn(digits: Column) -> Column:
    def worth(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return _sum(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), worth)) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]+", "")
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.rlike(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(8, 15)


def base_entities(text: Column) -> Column:
    """The contract's entities as array of (start, end, kind), by kind and start."""

    def of_kind(kind: str) -> Column:
        good = F.filter(matches(text, _PATTERN[kind]), lambda m: _valid(kind, m["match"]))
        spans = F.transform(good, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(kind).alias("kind")))
        return F.when(text.rlike(_HINT[kind]), spans).otherwise(F.array().cast(_SPANS))

    return F.concat(*[of_kind(kind) for kind in KINDS])


def _in_lists(found: Column) -> Column:
    """``found`` with patterns for instances without words before: the last pattern before, and LISTED behind it."""

    def last(patterns: Column) -> Column:
        return F.aggregate(patterns, F.lit(""), lambda now, p: F.when(p != "", p).otherwise(now))

    def from_patterns(patterns: Column) -> Column:
        def from_before(before: Callable[[Column], Column]) -> Column:
            def one(m: Column, i: Column) -> Column:
                pattern = F.when(m["pattern"] != "", m["pattern"]).otherwise(F.concat(before(i), F.lit(LISTED)))
                return F.struct(m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"), pattern.alias("pattern"))

            return F.transform(found, one)

        return running(patterns, last, lambda a, b: F.when(b != "", b).otherwise(a), from_before)

    return let(F.transform(found, lambda m: m["pattern"]), from_patterns)


def instances(text: Column) -> Column:
    """Identifier-like runs without their punctuation: array of (start, end, value, pattern)."""

    def one(m: Column) -> Column:
        front = F.length(F.regexp_extract(m["match"], _OPENING, 0))
        back = F.length(F.regexp_extract(m["match"], _CLOSING, 0))
        before = F.transform(F.slice(F.reverse(F.filter(F.split(m["gap"], r"[\x20\x09-\x0D]+"), lambda w: w != "")), 1, CONTEXT_WORDS), lambda w: F.lower(w))
        value = F.substring(m["match"], front + 1, F.length(m["match"]) - front - back)
        return F.struct((m["start"] + front).alias("start"), (m["end"] - back).alias("end"), value.alias("value"), F.array_join(F.reverse(before), " ").alias("pattern"))

    found = let(F.filter(F.transform(matches(text, _INSTANCE), one), lambda m: m["end"] > m["start"]), _in_lists)
    return F.when(text.rlike("[0-9@]"), found).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,value:string,pattern:string>>"))


def graph(occurrences: DataFrame) -> DataFrame:
    """Edges (pattern, value, kind, n): an instance's occurrences behind a pattern; kind is null where no seed is."""
    return occurrences.groupBy("pattern", "value", "kind").agg(F.count("*").alias("n"))


def trusted_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, score) of the patterns to extract with.

    In each round the instances' scores flow to patterns and back. Seeds keep score 1 for their kind; another instance
    takes the occurrence-weighted mean of its patterns. Where that is high enough it is a seed in the next rounds.
    """
    kinds = F.explode(F.array(*[F.lit(k) for k in KINDS])).alias("kind")
    seeds = stored(edges.where("kind IS NOT NULL").select("value", "kind").distinct(), "seeds")
    links = stored(edges.groupBy("pattern", "value").agg(F.sum("n").alias("n")), "graph")
    score = seeds.withColumn("score", F.lit(1.0))
    turn, n_trusted = 0, 0
    while True:
        support = stored(links.join(seeds, "value").groupBy("pattern", "kind").agg(F.count("*").alias("n_seeds")).where(F.col("n_seeds") >= LEAST_SEEDS), f"support{turn}")
        # Only patterns behind which enough seeds stand can gain trust.
        by_kind = links.join(support.select("pattern").distinct(), "pattern", "left_semi").select("pattern", "value", "n", kinds)
        worth = by_kind.join(score, ["value", "kind"], "left").groupBy("pattern", "kind").agg((F.sum(F.col("n") * F.coalesce("score", F.lit(0.0))) / F.sum("n")).alias("score"))
        patterns = stored(worth, f"patterns{turn}")
        trusted = patterns.join(support, ["pattern", "kind"]).where(F.col("score") >= LEAST_SCORE).select("pattern", "kind", "score")
        before, n_trusted = n_trusted, trusted.count()
        turn += 1
        if turn >= rounds and n_trusted <= before:
            return trusted
        passed = by_kind.join(patterns, ["pattern", "kind"]).groupBy("value", "kind").agg((F.sum(F.col("n") * F.col("score")) / F.sum("n")).alias("passed"))
        passed = stored(passed, f"instances{turn}")
        seeds = stored(seeds.union(passed.where(F.col("passed") >= LEAST_SCORE).select("value", "kind")).distinct(), f"seeds{turn}")
        known = seeds.withColumn("seed", F.lit(1.0))
        score = passed.join(known, ["value", "kind"], "full").select("value", "kind", F.coalesce("seed", "passed").alias("score"))


def _occurrences(rows: DataFrame) -> DataFrame:
    """(_row, start, end, value, pattern, kind): instances, with the kind of the first base entity that overlaps them.

    Entities of one kind do not overlap each other, so of those that begin before an instance ends, the last one reaches
    furthest: in order of place, a running maximum for each kind tells whether it reaches into the instance.
    """
    some = rows.where(F.size("_instances") > 0)
    given = some.select("_row", (F.size("base") > 0).alias("mixed"), F.explode("_instances").alias("x")).select("_row", "mixed", "x.*")
    alone = given.where("NOT mixed").drop("mixed").withColumn("kind", F.lit(None).cast("string"))
    ends = given.where("mixed").drop("mixed").withColumns({"at": F.col("end"), "is_base": F.lit(False)})
    bases = some.where(F.size("base") > 0).select("_row", F.explode("base").alias("b"))
    bases = bases.select("_row", F.col("b.start").alias("at"), F.lit(True).alias("is_base"), F.col("b.end").alias("base_end"), F.col("b.kind").alias("base_kind"))
    window = Window.partitionBy("_row").orderBy("at", "is_base").rowsBetween(Window.unboundedPreceding, 0)
    reach = {k: F.max(F.when(F.col("base_kind") == k, F.col("base_end"))).over(window) for k in KINDS}
    both = ends.unionByName(bases, allowMissingColumns=True).withColumns({f"_{k}": c for k, c in reach.items()}).where("NOT is_base")
    kind = F.coalesce(*[F.when(F.col(f"_{k}") > F.col("start"), k) for k in KINDS])
    return alone.unionByName(both.select("_row", "start", "end", "value", "pattern", kind.alias("kind")))


def entities(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``base`` and ``found``: arrays of (start, end, kind), of the fixed patterns and of all entities.

    Each is in order of kind and start. Found entities never overlap base ones. Without ``keep_text`` the texts are read
    and left behind, which spares a stored copy of them.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = without(docs, *ADDED, "_row", "_instances").withColumns({"base": base_entities(text), "_instances": instances(text)})
    rows = rows if keep_text else rows.drop("text")
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "entities")

    seen = stored(_occurrences(rows), "occurrences")
    trusted = trusted_patterns(stored(graph(seen), "edges"))
    best = trusted.groupBy("pattern").agg(F.max(F.struct("score", F.col("kind").alias("k")))["k"].alias("k"))
    new = seen.where("kind IS NULL").join(best, "pattern").groupBy("_row").agg(F.collect_list(F.struct("start", "end", F.col("k").alias("kind"))).alias("_new"))
    order = {k: i for i, k in enumerate(KINDS)}
    rank = F.create_map(*[x for k, i in order.items() for x in (F.lit(k), F.lit(i))])

    def ordered(spans: Column) -> Column:
        keyed = F.transform(spans, lambda s: F.struct(F.element_at(rank, s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
        return F.transform(F.sort_array(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))

    joined = rows.drop("_instances").join(new, "_row", "left")
    everything = F.when(F.col("_new").isNull(), F.col("base")).otherwise(ordered(F.concat("base", F.coalesce("_new", F.array().cast(_SPANS)))))
    return joined.withColumn("found", everything).drop("_row", "_new")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every entity replaced by its kind in angle brackets; overlapping ones by that of the first."""
    shielded_docs, restored = shielded(docs, *ADDED, "_row", "_instances", "_new")
    rows = entities(shielded_docs)

    def cut(text: Column) -> Column:
        def from_spans(spans: Column) -> Column:
            def from_chunks(chunks: Column) -> Column:
                def between(a: Column, b: Column) -> Column:
                    first, last = (F.floor(x / TEXT_CHUNK).cast("int") for x in (a, b))
                    head = F.coalesce(F.substr(F.get(chunks, first), (a % TEXT_CHUNK + 1).cast("int")), F.lit(""))
                    end = F.coalesce(F.substr(F.get(chunks, last), F.lit(1), (b % TEXT_CHUNK).cast("int")), F.lit(""))
                    across = F.concat(head, F.array_join(F.slice(chunks, first + 2, last - first - 1), ""), end)
                    inside = F.substr(F.get(chunks, first), (a % TEXT_CHUNK + 1).cast("int"), (b - a).cast("int"))
                    return F.when(b <= a, "").when(first == last, inside).otherwise(across)

                def from_before(before: Callable[[Column], Column]) -> Column:
                    placed = F.transform(spans, lambda s, i: F.struct(before(i).alias("free"), s["start"].alias("start"), s["kind"].alias("kind")))
                    clear = F.filter(placed, lambda p: p["start"] >= p["free"])
                    out = F.transform(clear, lambda p: F.concat(between(p["free"], p["start"]), F.lit("<"), p["kind"], F.lit(">")))
                    return F.concat(F.array_join(out, ""), between(before(F.size(spans)), F.length(text).cast(LONG)))

                def furthest(part: Column) -> Column:
                    return F.coalesce(F.array_max(part), F.lit(0).cast(LONG))

                return let(F.transform(spans, lambda s: s["end"]), lambda ends: running(ends, furthest, F.greatest, from_before))

            return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_CHUNK}}}"), F.lit(0)), from_chunks)

        return let(F.sort_array("found"), from_spans)

    text = F.when(F.size("found") > 0, cut(F.col("text"))).otherwise(F.col("text"))
    rows = rows.withColumn("text", text)
    if "n_chars" in rows.columns:  # the length follows the text
        kind = rows.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.size("found") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return restored(rows)
