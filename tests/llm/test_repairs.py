"""Conversation repair, URL filters and fill-in-the-middle against plain Python."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from remitlens.llm import fill_middle, registry, turn_repair, url_filter
from remitlens.verification.compare import difference
from tests.llm import brute, cases

_KINDS = st.text(alphabet="suaoSUAOx", max_size=24)


def _pairs(kinds):
    return [("", "blank") if k == "x" else (k.lower(), "truncated" if k.isupper() else None) for k in kinds]


@settings(max_examples=400, deadline=None)
@given(_KINDS)
def test_cheapest_edits(kinds):
    assert turn_repair.cheapest(kinds) == brute.cheapest_edits(_pairs(kinds))


@settings(max_examples=100, deadline=None)
@given(_KINDS.filter(bool), st.integers(1, 7))
def test_segments_make_up_the_whole(kinds, length):
    segments = [turn_repair.between(kinds[i : i + length]) for i in range(0, len(kinds), length)]
    costs = [[f and f[0] for f in own] for own in segments]
    orders = []
    for own in segments:
        place = {a: i for i, a in enumerate(sorted({f[1] for f in own if f}))}
        orders.append([place[f[1]] if f else None for f in own])
    chosen = turn_repair.picks(costs, orders)
    tail = turn_repair.TAIL[chosen[-1] % turn_repair.STATES]
    cost = sum(own[p][0] for own, p in zip(segments, chosen, strict=True)) + 3 * len(tail)
    assert (cost, "".join(own[p][1] for own, p in zip(segments, chosen, strict=True)) + tail) == turn_repair.cheapest(kinds)


def _conversations():
    r = random.Random(5)
    said = ["Yes.", "No!", "", " \t", "cut off", "What?", "a\nb.", "ends here. ", "ü" * 3000, "end.\x0b\n", "x \u00a0"]
    rows = [(1, None, None, None), (1, None, "user", "Hi."), (1, 3, "tool", "x."), (2, 5, "", ""), (None, 1, "user", "a."), (None, 1, "user", "a."), (None, 2, None, None)]
    rows += [(3, t, "assistant", "Same.") for t in (4, 4, 7, 9, 9)] + [(3, 2, "system", "Rules.")] * 2
    for conv in range(10, 90):
        n = r.randrange(1, 12)
        rows += [(conv, r.choice([None, *range(n)]) if conv % 7 == 0 else t, r.choice(["user", "assistant", "user", "assistant", "system", "ursa", "bot"]), r.choice(said)) for t in range(n)]
    rows += [(99, t, ("user", "assistant")[(t + r.randrange(8) // 7) % 2], r.choice(said) + (f" {t}." if r.random() < 0.8 else "")) for t in range(900)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("length", [7, turn_repair.SEGMENT])
def test_repaired_conversations(spark, length, monkeypatch):
    monkeypatch.setattr(turn_repair.repairs, "__defaults__", (length,))
    rows = _conversations()
    given = spark.createDataFrame([(*x, "kept") for x in rows], "conv_id long, turn long, role string, text string, audit string").repartition(5)
    want = {conv: [] for conv, *_ in rows}
    for conv, *turn in brute.damaged(rows):
        want[conv].append(turn)
    got = turn_repair.report(given, turn_repair.damaged(given)).collect()
    assert len(got) == len(want) and {r.conv_id for r in got} == set(want)
    for r in got:
        if want[r.conv_id]:
            assert tuple(r)[1:] == brute.repair(want[r.conv_id]), r.conv_id
        else:
            assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", brute.sha(""))


def test_repaired_turns_are_legal(spark):
    given = spark.createDataFrame(_conversations(), "conv_id long, turn long, role string, text string")
    _, pieces = turn_repair.repairs(given)
    turns = defaultdict(list)
    for r in turn_repair.repaired(given, pieces).collect():
        turns[r.conv_id].append((r.position, r.role))
    for own in turns.values():
        assert [p for p, _ in sorted(own)] == list(range(len(own)))
        initials = "".join(role[0] for _, role in sorted(own)).removeprefix("s")
        assert initials and initials == "ua" * (len(initials) // 2)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.report(empty, turn_repair.damaged(empty)).collect() == []


def _folder(tmp_path, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_repair_query(spark, tables):
    rows = [tuple(r) for r in spark.read.parquet(f"{tables}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left = defaultdict(list)
    for conv, *turn in brute.damaged(rows):
        left[conv].append(turn)
    got = registry.QUERIES["op11_turn_repair"](spark, tables).collect()
    assert {r.conv_id for r in got} == {r[0] for r in rows} and len(got) == len({r[0] for r in rows})
    for r in got:
        assert tuple(r)[1:] == (brute.repair(left[r.conv_id]) if left[r.conv_id] else (0, 0, 0, 0, 0, 0, "", brute.sha("")))


def _pages():
    r = random.Random(9)
    hosts = [f"h{i}.{zone}" for i in range(12) for zone in ("com", "net", "org")] + ["www.example.com", "a.www.example.com", "example.com", "EXAMPLE.com", "net", "notcom"]
    paths = ["", "/", "/en/1", "/es/2?q=/fr/", "/fr/", "/fr", "/x#y", "?a://b.com/"]
    pages = [(None, None), ("", "<p>"), ("no scheme.com/", "<a href='http://h1.org/'>"), ("://", None), ("http://", "x"), ("http://a.net/fr/\nx", "a")]
    for i in range(400):
        links = "".join(f' <a class=x {r.choice(["href", "HREF", "data-href"])}={r.choice(["", chr(34), chr(39)])}{r.choice(["http:", "https:", ""])}//{r.choice(hosts)}{r.choice(paths)}> ' for _ in range(r.randrange(3)))
        pages.append((f"{r.choice(['http', 'https'])}://{r.choice(hosts)}{r.choice(paths)}", r.choice([None, links, links, f"<a href=/en/>{links}"])))
    for i in range(3):  # who links to blocked hosts, over two steps; who trusted hosts link to
        pages += [(f"http://h{i}.net/es/", "")] * 30 + [(f"http://farm{i}.org/", f"<a href=http://h{i}.net/>")] * (i + 1) + [(f"http://feeds{i}.org/", f"<a href=//farm{i}.org/p>")]
        pages += [(f"http://t{i}.com/", f"<a href=http://good{i}.org/x>"), (f"http://good{i}.org/", "")]
    return [(k, u, h) for k, (u, h) in enumerate(pages)] + [(5, "http://h1.net/x", "")] * 2


def test_url_verdicts(spark, tmp_path):
    import duckdb

    pages = _pages()
    df = spark.createDataFrame([(*p, "kept", 3) for p in pages], "page_id long, url string, html string, _bad string, host long").repartition(4)
    got = url_filter.judged(df)
    assert got.columns == ["page_id", "url", "html", "_bad", "host", "path", "rule", "verdict"]
    want = brute.url_verdicts([p[1:] for p in pages])
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()) == Counter((p[0], *w) for p, w in zip(pages, want, strict=True))
    method = {(w[0], w[3]) for w in want if w[2] is None}
    assert ("farm0.org", "block") in method and ("feeds0.org", "block") in method and ("good0.org", "allow") in method
    db = duckdb.connect()
    folder = _folder(tmp_path, pages=df.select("page_id", "url", "html"))
    db.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{folder}/pages.parquet/*.parquet')")
    assert difference(registry.QUERIES["op12_url_filter"](spark, folder), db.execute(registry.ORACLE["op12_url_filter"])) is None


def test_no_pages(spark):
    assert url_filter.judged(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


_TEXT = st.text(alphabet=st.sampled_from("a<PSM>\néß€𝄞 \r"), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(_TEXT, min_size=1, max_size=5))
def test_exception_index(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.cumsum([0, *(len(t.encode()) for t in texts)])
    whole = "".join(texts)
    ends = [len(whole[:i].encode()) for i in range(len(whole) + 1)]
    index = fill_middle.Exceptions(data)
    assert index.byte_of(np.arange(len(whole) + 1)).tolist() == ends
    assert index.point_of(np.array(ends)).tolist() == list(range(len(whole) + 1))
    assert fill_middle.sentinel_rows(data, at).tolist() == [any(s in t for s in ("<P>", "<S>", "<M>")) for t in texts]
    units = fill_middle.Units(data, at, "char")
    assert units.n.tolist() == [len(t) for t in texts]
    half = np.array([len(t) // 2 for t in texts])
    assert units.ends(half).tolist() == [a + len(t[: len(t) // 2].encode()) for a, t in zip(at.tolist(), texts)]


def test_fill_middle(spark):
    texts = [(i, t) for i, t, *_ in cases.rows()]
    texts += [(100 + i, "ÄÖ\n€𝄞\n" * i + "<" * (i % 3) + "S" * (i % 2)) for i in range(40)] + [(200, "a<P>b"), (201, "<\nM>"), (202, "line\n" * 300_000), (203, "é" * 700_000)]
    df = cases.frame(spark, [(i, t, "en", None, 0) for i, t in texts])
    for unit in ("line", "char"):
        out = fill_middle.transformed(df, unit=unit, rate=100 if unit == "line" else 60)
        assert set(cases.CLASHES) - {"n"} < set(out.columns) and out.columns[-5:] == list(fill_middle.ADDED)
        rows = out.withColumn("back", fill_middle.restored(out["output"], out["form"])).collect()
        assert Counter((r.doc_id, r.back) for r in rows) == Counter((i, t or "") for i, t in texts)
        if unit == "line":
            assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows) == Counter((i, *brute.fill_middle(i, t)) for i, t in texts)
        else:
            assert {r.form for r in rows} == {"plain", "psm", "spm"} and all(r.n == len(r.text or "") for r in rows)
    assert fill_middle.transformed(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        fill_middle.transformed(df, unit="word")
