"""Document operators against plain Python on edge cases, and on empty tables."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from remitlens.llm import decontaminate, license_scan, mixing, ngram_join, personal_data, quality_rules, suffix_dedup
from remitlens.llm.common import joined_sha256
from tests.llm import brute, cases


@pytest.fixture(scope="module")
def docs(spark):
    return cases.frame(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return cases.frame(spark, [])


def same(df, columns, expected):
    got = Counter(tuple(r[c] for c in columns) for r in df.select(*columns).collect())
    assert got == Counter(expected)


def test_quality_ledger(docs, empty):
    rows = quality_rules.ledger(docs).withColumn("failed", quality_rules.rejected(quality_rules.BASE))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed"]
    same(rows, columns, [(i, *brute.quality(t)) for i, t, *_ in cases.rows()])
    kept = quality_rules.passing(docs)
    assert kept.columns == docs.columns and {r.n_words for r in kept.collect()} == {"kept n_words"}
    gone = {i for i, t, *_ in cases.rows()} - {r.doc_id for r in kept.collect()}
    assert {1, 2, 3, 4, 12, 19, 22} <= gone and not {5, 6, 7, 10, 16} & gone
    assert quality_rules.passing(empty).count() == 0


def test_policies_and_ablation(docs):
    rows = quality_rules.ledger(docs).select("fail_bits").cache()
    out = {r.rule: (r.n_failed, r.n_only, r.n_kept) for r in quality_rules.ablation(rows, quality_rules.V1).collect()}
    bits = [r.fail_bits for r in rows.collect()]
    mask = quality_rules.V1.mask(quality_rules.RULES)
    for rule in quality_rules.RULES:
        bit = 1 << rule.bit
        assert out[rule.name] == (sum(bool(b & bit) for b in bits), sum(b & mask == bit for b in bits), sum(b & mask == 0 for b in bits))


def test_license_scan(docs, empty):
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    rows = license_scan.scan(docs).cache()
    same(rows, columns, [(i, *brute.licenses(t)) for i, t, *_ in cases.rows()])
    found = {r.doc_id: r for r in rows.collect()}
    assert found[14].labels == "apache,cc-by-nc,gpl,mit" and found[14].score == 1.0
    assert found[5].labels == "" and found[5].score == 0.0 and found[5].node == "kept node"
    assert license_scan.scan(empty).count() == 0


def test_license_alignment_tolerates_changes(spark):
    notice = "Permission is hereby granted, free of charge, to each person obtaining a copy of this software and associated documentation files"
    broken = "Permission is granted to any person obtaining a copy of this program and associated documents"
    rows = license_scan.scan(cases.frame(spark, [(1, "x y " + notice, "en", "a", 1), (2, broken, "en", "a", 1)], clash=False))
    got = {r.doc_id: (r.labels, r.n_base) for r in rows.collect()}
    assert got == {1: ("mit", 0), 2: ("", 0)}


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 400])
def test_decontaminate(spark, docs, empty, block_bytes):
    benchmark = spark.createDataFrame(cases.BENCHMARK, "item_id long, text string")
    rows = decontaminate.with_hits(docs, benchmark, block_bytes)
    rows = rows.withColumns({"hit": decontaminate.n_hit(), "ids": F.array_join("items", ","), "sha": joined_sha256(F.col("items"))})
    expected = [(i, *brute.benchmark_hits(t, cases.BENCHMARK)) for i, t, *_ in cases.rows()]
    same(rows, ["doc_id", "n_words", "hit", "ids"], expected)
    assert {r.sha for r in rows.collect()} == {brute.sha(e[3]) for e in expected}
    if block_bytes > 400:
        kept = decontaminate.clean(docs, benchmark)
        assert kept.columns == docs.columns
        same(kept, ["doc_id", "items"], [(e[0], "kept items") for e in expected if e[2] == 0])
        assert decontaminate.with_hits(empty, benchmark).count() == 0
        assert decontaminate.with_hits(docs, benchmark.limit(0)).where("size(items) > 0").count() == 0


def test_personal_data(docs, empty):
    def spans(c):
        return personal_data.listed(F.col(c))

    rows = personal_data.entities(docs).withColumns({"b": spans("base"), "f": spans("found")}).cache()
    expected = [(i, ",".join(f"{k}:{a}:{b}" for k, a, b in brute.personal(t))) for i, t, *_ in cases.rows()]
    same(rows, ["doc_id", "b"], expected)
    assert all(r.b == r.f for r in rows.collect())
    masked = {r.doc_id: r for r in personal_data.masked(docs).collect() if r.doc_id is not None}
    assert masked[15].text == "mail <email><email> or <phone>, card <card> from <ip> not 10.0.0.256 nor <ip>.5"
    assert masked[15].n_chars == len(masked[15].text) and masked[15].found == "kept found" and masked[1].text is None
    assert personal_data.masked(empty).count() == 0


def test_personal_data_bootstraps(spark):
    """Identifiers of a shape the fixed patterns miss, behind words that mark the kind elsewhere."""
    seeds = [(i, f"{cases.prose(i, 20)} Call me at +1 (202) 555-{1000 + i} now", "en", "a", 1) for i in range(30)]
    unseen = [(100, "Call me at 030/2345-678, please", "en", "a", 1), (101, "sold at 12/34-567 each", "en", "a", 1)]
    rows = personal_data.entities(cases.frame(spark, seeds + unseen, clash=False)).where("doc_id >= 100")
    got = {r.doc_id: r.s for r in rows.select("doc_id", personal_data.listed(F.col("found")).alias("s")).collect()}
    assert got == {100: "phone:11:23", 101: ""}


def test_personal_data_bootstraps_over_hops(spark):
    """Identifiers found through trusted words make other words trusted, none of which stands before a fixed pattern."""
    rows = [(i, f"{cases.prose(i, 20)} Call me at +1 (202) 555-{1000 + i} now", "en", "a", 1) for i in range(60)]
    rows += [(100 + i, f"{cases.prose(i, 20)} Call me at 030/2345-60{i} now", "en", "a", 1) for i in range(6)]
    rows += [(200 + i, f"my tel: 030/2345-60{i} now", "en", "a", 1) for i in range(6)]
    rows += [(300 + i, f"my tel: 040/99-70{i} now", "en", "a", 1) for i in range(1)]
    rows += [(400, "sold at 12/34-567 each", "en", "a", 1)]
    got = {r.doc_id: r.s for r in personal_data.entities(cases.frame(spark, rows, clash=False)).where("doc_id >= 100").select("doc_id", personal_data.listed(F.col("found")).alias("s")).collect()}
    assert all(got[200 + i] == "phone:8:20" for i in range(6)) and got[300] == "phone:8:18" and got[400] == ""


def test_personal_data_in_lists(spark):
    """Identifiers on lines of their own are in the list of the words before."""
    rows = [(i, f"Our staff lines:\n+1 (202) 555-{1000 + i}\n+1 (202) 555-{2000 + i}\n+1 (202) 555-{3000 + i}", "en", "a", 1) for i in range(30)]
    rows += [(100, "Our staff lines:\n+1 (202) 555-4000\n030/2345-678", "en", "a", 1), (101, "12/34\n" + "\n".join(f"7/{i}" for i in range(600)), "en", "a", 1)]
    df = cases.frame(spark, rows, clash=False)
    got = {r.doc_id: r.s for r in personal_data.entities(df).where("doc_id >= 100").select("doc_id", personal_data.listed(F.col("found")).alias("s")).collect()}
    assert got == {100: "phone:17:34,phone:35:47", 101: ""}
    (own,) = df.where("doc_id = 100").select(personal_data.instances(F.col("text"))["pattern"].alias("p")).collect()
    assert own.p == ["staff lines:", "staff lines:\n"]


def test_long_match_lists(spark):
    text = " ".join(f"u{i}@ex.org" for i in range(1500))
    rows = personal_data.entities(cases.frame(spark, [(1, text, "en", "a", 1)], clash=False))
    (r,) = rows.select(personal_data.listed(F.col("base")).alias("s")).collect()
    assert r.s == ",".join(f"{k}:{a}:{b}" for k, a, b in brute.personal(text))


def _masked(text):
    """Entities replaced by their kind, overlapping ones by that of the first."""
    out, at = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in brute.personal(text)):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_personal_data_of_one_long_text(spark):
    """Tens of thousands of entities in one text, also overlapping ones and ones beyond a chunk of text."""
    parts = [f"é mail a{i}.b@host{i}.example.org or +49 {i:05d} 5550123 at 10.{i % 250}.0.1 " + "ü" * (2000 if i % 1000 == 0 else 3) for i in range(4000)]
    given = [(1, "".join(parts), "en", "a", 1), (2, " ".join(f"u{i}@x.org" for i in range(50_000)), "en", "a", 1)]
    for r in personal_data.masked(cases.frame(spark, given, clash=False)).collect():
        assert r.text == _masked(given[r.doc_id - 1][1])


def test_license_words_in_one_long_text(spark):
    """Hundreds of thousands of licence words, with and without alignments at each."""
    notice = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License. "
    given = [(1, "license mit " * 150_000, "en", "a", 1), (2, notice * 8_000, "en", "a", 1)]
    rows = {r.doc_id: r for r in license_scan.scan(cases.frame(spark, given, clash=False)).collect()}
    for i, text, *_ in given:
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.licenses(text)
    assert rows[2].labels == "gpl" and rows[2].score == 1.0


def test_suffix_dedup(docs, empty):
    given = cases.rows()
    expected = [(i, *e) for (i, *_), e in zip(given, brute.repeats([t for _, t, *_ in given], suffix_dedup.LENGTH), strict=True)]
    same(suffix_dedup.deduplicated(docs), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], expected)
    assert suffix_dedup.deduplicated(empty).count() == 0


def test_suffix_dedup_with_nul_bytes(spark):
    """A text that ends between two that go on with NUL bytes does not part them."""
    r = random.Random(8)
    base = "".join(r.choice("abcdefgh") for _ in range(330))
    texts = [base + "\0" * n + end for n in (0, 1, 40, 70, 71, 200) for end in ("", "\0", "x", "y", "\0z", "z" * 40)]
    texts += [head + base[k:] + "\0" * 90 + tail for k, head in enumerate(["q", "\0", "\0\0w", ""]) for tail in ("1", "2", "")]
    given = [(i, t, "en", "a", 1) for i, t in enumerate(texts)]
    expected = [(i, *e) for (i, *_), e in zip(given, brute.repeats(texts, suffix_dedup.LENGTH), strict=True)]
    assert sum(e[2] > 0 for e in expected) > 12
    for most in (3, suffix_dedup.MOST_ANCHORS):
        same(suffix_dedup.deduplicated(cases.frame(spark, given), most), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], expected)


def test_suffix_dedup_beyond_a_step(spark):
    """A text longer than what is taken at a time, with repeats across the cut."""
    size = suffix_dedup.STEP_BYTES
    body = cases.prose(77, 600).encode().decode("ascii", "ignore")[:3000]
    noise = "".join(f"{i:x}," for i in range(size // 6))
    given = [(1, noise + body + noise[::-1][:5000], "en", "a", 1), (2, "z" * 10 + body[:900], "en", "a", 1), (3, noise[: size - 200], "en", "a", 1)]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup.deduplicated(cases.frame(spark, given, clash=False)).collect()}
    assert got[2] == (900, 1)
    assert got[3][1] >= 1 and got[3][0] == min(size - 200, len(noise))


def test_suffix_dedup_of_often_grams(spark, monkeypatch):
    """A passage in many texts: its anchors never meet in a block, with the same result as plain Python."""
    passage = cases.prose(50, 110)
    given = [(i, cases.prose(100 + i, 50 + i) + passage[i % 3 :] + cases.prose(200 + i, 70), "en", "a", 1) for i in range(24)]
    given += [(30, given[0][1], "en", "a", 1), (31, passage, "en", "a", 1), (32, passage + passage, "en", "a", 1), (33, passage[:450], "en", "a", 1)] + cases.rows()
    df = cases.frame(spark, given, clash=False)
    expected = [(i, *e) for (i, *_), e in zip(given, brute.repeats([t for _, t, *_ in given], suffix_dedup.LENGTH), strict=True)]
    for most in (3, 10):
        same(suffix_dedup.deduplicated(df, most), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], expected)
    texts = suffix_dedup._texts(df)
    often = suffix_dedup.often_grams(texts, 1, 10)
    # Blocks sort out the often grams that tasks are not told of, and members are added up in small portions.
    monkeypatch.setattr(suffix_dedup, "MOST_OFTEN", len(often) // 2)
    monkeypatch.setattr(suffix_dedup, "COUNT_MEMBERS", 50)
    assert 0 <= len(suffix_dedup.often_grams(texts, 1, 10)) <= len(often) // 2
    same(suffix_dedup.deduplicated(df, 10), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], expected)
    met = suffix_dedup.repeated_anchors(texts, 1, often).join(texts.dropDuplicates(["text_id"]), "text_id").select("text_id", F.explode("places").alias("p"), "text").collect()
    grams = Counter(r.text.encode()[r.p : r.p + suffix_dedup.GRAM] for r in met)
    assert len(often) and max(grams.values()) <= 10


def test_near_duplicates(docs, empty):
    given = [(i, t) for i, t, *_ in cases.rows()]
    rows = ngram_join.near_duplicates(docs).cache()
    expected = [(i, *e) for (i, _), e in zip(given, brute.components(given), strict=True)]
    same(rows, ["doc_id", "n_shingles", "component_id"], expected)
    kept = ngram_join.unique(docs)
    assert kept.columns == docs.columns
    same(kept, ["doc_id", "node"], [(i, "kept node") for i, _, comp in expected if i == comp])
    assert len({i for i, _, comp in expected if i != comp}) >= 3
    assert ngram_join.near_duplicates(empty).count() == 0


def test_near_duplicates_of_frequent_tokens(spark):
    """Groups far above the limit for frequent tokens, in several sizes, linked in chains."""
    given = []
    for size in (3, 6, 9, 14, 40, 150):
        base = cases.prose(size, size)
        for k in range(14):
            given.append((1000 * size + k, edited_chain(base, k), "en", "a", 1))
    pairs = [(i, t) for i, t, *_ in given]
    rows = ngram_join.near_duplicates(cases.frame(spark, given, clash=False))
    same(rows, ["doc_id", "n_shingles", "component_id"], [(i, *e) for (i, _), e in zip(pairs, brute.components(pairs), strict=True)])


def edited_chain(text, k):
    words = text.split(" ")
    for i in range(k):
        words[(i * 7) % len(words)] = f"new{i}"
    return " ".join(words)


def test_hopeless_members_of_large_groups():
    """Bounds discard members at every size, as comparing all with all does."""
    r = random.Random(5)
    for size in (2, 3, 17, 700):
        n = np.array([r.randrange(4, 60) for _ in range(size)])
        bound = np.array([max(1, int(x * r.choice((0.6, 0.8, 0.86, 0.9, 1)))) for x in n])
        near = 7 * np.minimum.outer(bound, bound) >= 3 * np.add.outer(n, n)
        np.fill_diagonal(near, False)
        assert (ngram_join.hopeful(n, bound) == near.any(axis=1)).all()
    who = np.arange(700)
    assert not ngram_join._groups(np.zeros(700, np.uint32), who, np.full(700, 100), np.full(700, 76))


def test_open_pairs_in_tiles(spark, monkeypatch):
    """A group over the size of a tile: no task compares it with itself, and no pair is missing or there twice."""
    monkeypatch.setattr(ngram_join, "TILE_ROWS", 20)
    rows = [(7, i, 100, 86 + i % 3 * 5 - i % 2 * 3) for i in range(90)] + [(8, i, 100, 100) for i in range(5)]
    comps = {i: i % 4 for i in range(80)}
    groups = spark.createDataFrame(rows, "gid long, node long, n long, bound long")
    got = ngram_join.open_pairs(groups, spark.createDataFrame(list(comps.items()), "node long, comp long")).collect()
    expected = {(a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and comps.get(a[1], a[1]) != comps.get(b[1], b[1]) and 7 * min(a[3], b[3]) >= 600}
    assert Counter((r.a, r.b) for r in got) == Counter(expected)
    dealt = ngram_join.tiled(groups.where("gid = 7"), spark.createDataFrame([(7, 90)], "gid long, size long"))
    assert max(r["count"] for r in dealt.groupBy("i", "j").count().collect()) < 90


def test_mixing(docs, empty):
    rows = mixing.with_copies(docs).cache()
    got = rows.collect()
    assert len(got) == len(cases.rows()) and rows.columns.count("copies") == 1
    total = sum(r.size for r in got)
    by_source = {}
    for r in got:
        assert 0 <= r.copies <= 3 and r.size == len(brute.spaced(r.text))
        s = by_source.setdefault(r.source, [r.source_size, r.target, 0, 0, 0])
        s[2] += r.size
        s[3] += r.size * r.copies
        s[4] = max(s[4], r.size)
    assert sum(s[1] for s in by_source.values()) == pytest.approx(total)
    for size, target, real, taken, longest in by_source.values():
        assert size == real and target <= 3 * size + 1e-9 and abs(taken - target) <= longest
    free = {n: s[1] / w for n, s, w in zip(["Z", "a", "b", "ü", None], [by_source[k] for k in ["Z", "a", "b", "ü", None]], [1, 2, 3, 1, 2], strict=True) if s[1] < 3 * s[0] - 1e-9}
    assert max(free.values()) == pytest.approx(min(free.values()))
    again = {(r.doc_id, r.text): r.copies for r in mixing.with_copies(docs.repartition(7)).collect()}
    assert all(again[r.doc_id, r.text] == r.copies for r in got if r.doc_id != 6)
    assert mixing.emitted(docs).count() == sum(r.copies for r in got)
    assert mixing.emitted(empty).count() == 0
