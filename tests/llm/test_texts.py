"""Conversations, token files and pages: round trips and small fixtures."""

import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from remitlens.llm import chat_format, html_text, token_scan
from tests.llm import brute, cases

_PIECES = st.sampled_from(["###", "### ", "\\", "</turn>", "\n</turn>\n", "### user:\n", "\\###", "\\\\</turn>", "a", ":\n", "\n", ""])
_TEXT = st.one_of(st.text(max_size=20), st.lists(_PIECES, max_size=8).map("".join))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(_TEXT, _TEXT), max_size=5))
def test_formatted_turns_read_back(turns):
    parser, out, at = chat_format.Parser(), [], 0
    pieces = [chat_format.formatted_turn(role, text) for role, text in turns]
    for piece in pieces:
        for role, text, first, end in parser.feed(piece):
            out.append((role, text))
            assert chat_format.unescaped("".join(pieces)[first:end]) == text
        at += len(piece)
    assert out == turns and not parser.rest
    whole = chat_format.Parser()
    assert [t[:2] for t in whole.feed("".join(pieces))] == turns


def test_plain_turns_stay_plain():
    assert chat_format.formatted_turn("user", "a \\ b") == "### user:\na \\ b\n</turn>\n"
    assert chat_format.formatted_turn("user", "</turn>") == "### user:\n\\</turn>\n</turn>\n"


def test_not_a_turn_is_refused():
    for text in ("user:\nx\n</turn>\n", "### user\nx\n</turn>\n", "### u:\nx</turn>\n"):
        with pytest.raises(ValueError):
            list(chat_format.Parser().feed(text))


def test_conversations(spark):
    rows = [
        (1, 1, "assistant", "b ### </turn>"),
        (1, 0, "user", "a"),
        (1, 1, "assistant", None),
        (2, 0, None, ""),
        (2, None, "assistant", "first"),
        (2, 0, "user", "x"),
        (2, 0, "user", "x"),
        (None, 0, "assistant", "n"),
        (None, 1, "user", "\\" * 3 + "###"),
        (3, 0, "assistant", "long " * 50_000),
    ]
    rows += [(4, k, random.Random(k).choice(["user", "assistant"]), cases.prose(k, 5)) for k in range(2000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, n_turns string")
    pieces = chat_format.formatted(df)
    got = {r.conv_id: tuple(r)[1:] for r in chat_format.read_back(pieces).collect()}
    by_id = defaultdict(list)
    for i, turn, role, text in rows:
        by_id[i].append((turn is not None, turn or 0, role or "", text or ""))
    formatted = Counter()
    for r in pieces.collect():
        formatted[r.conv_id] += len(r.piece)
        if r.loss_start is not None:
            assert r.piece.startswith("### assistant:\n") and r.piece[r.loss_end :] == "\n</turn>\n"
    assert got == {i: (*brute.conversation([t[2:] for t in sorted(turns)]), formatted[i]) for i, turns in by_id.items()}
    assert chat_format.read_back(chat_format.formatted(df.limit(0))).count() == 0


def _letters():
    return lambda texts: [[ord(c) for c in t] for t in texts]


@pytest.mark.parametrize("block_ids", [1, 7, 64, 1 << 18])
def test_token_counts(spark, block_ids):
    docs = cases.frame(spark, [r for r in cases.rows() if r[0] not in (22, 23)]).repartition(3)
    got = token_scan.document_tokens(docs, _letters, 2_000_000, block_ids).collect()
    expected = Counter((i, len(t or "")) for i, t, *_ in cases.rows() if i not in (22, 23))
    assert Counter((r.doc_id, r.n_tokens) for r in got) == expected
    for file in {r.file for r in got}:
        own = sorted((r.first_token, r.n_tokens) for r in got if r.file == file)
        assert own[0][0] == 0 and all(a + n + 1 == b for (a, n), (b, _) in zip(own, own[1:], strict=False))


def test_no_documents_no_tokens(spark):
    assert token_scan.document_tokens(cases.frame(spark, []), _letters, 9).count() == 0


def test_existing_flat_files(spark, tmp_path):
    r, expected = random.Random(3), []
    for name in ("a", "b", "c"):
        ids = [r.choice([5, 5, 6, 9]) for _ in range(r.randrange(50, 90))] if name != "c" else []
        np.array(ids, np.uint32).tofile(tmp_path / f"{name}.bin")
        last = -1
        for at, x in enumerate(ids):
            if x == 9:
                expected.append((name, last + 1, at - last - 1))
                last = at
    files = spark.read.format("binaryFile").load(str(tmp_path / "*.bin"))
    blocks = token_scan.flat_blocks(files, block_ids=8)
    got = token_scan.counts(token_scan.separators(blocks, 9, block_ids=8)).collect()
    assert sorted((x.file.rsplit("/", 1)[1][0], x.first_token, x.n_tokens) for x in got) == sorted(expected)


def page(title, body, ad, extra=""):
    return (
        f'<!DOCTYPE html><html><head><title>{title}</title><style>p{{x:y}}</style><script>var t="</p>";</script></head><body>'
        f'<header class="site">Site</header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- <p>no</p> --><div class="cookie-notice">We use cookies</div>'
        f'<div class="ad">{ad}</div><div class="story"><h1>{title}</h1>{body}{extra}</div>'
        f'<aside>Side {ad}</aside><form>Name <input name="q"> <button>Go</button></form><div id="comments"><p>Nice!</p></div><footer>&copy; host</footer></body></html>'
    )


def test_pages(spark):
    bodies = {i: f"<p>One &amp; {i}\n  two</p><p><b>Three {i}<br>four<p>Five &lt;{i}&gt; < 6" for i in range(12)}
    rows = [(i, f"https://Host.example/{i}", page(f"T{i}", b, f"Buy {i % 3}", "<div class='share'>Share this</div><p>Read more on host</p>")) for i, b in bodies.items()]
    rows += [
        (100, "http://single.example/", "<html><body><nav>m</nav><article><p>Only</p></article><p>outside</p></body></html>"),
        (101, None, "plain <i>text</i> &eacute;"),
        (102, "odd", None),
        (103, "http://two.example/1", page("Same", "<p>copy text</p>", "a")),
        (104, "http://two.example/2", page("Same", "<p>copy text</p>", "a")),
        (104, "http://two.example/2", page("Same", "<p>copy text</p>", "a")),
        (105, "http://x.example", "<div><p>unclosed <b>bold <div>next</p></div>" + "<p>long text</p>" * 3000),
        (106, "http://x.example", ""),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = html_text.extracted(df).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    for i in bodies:
        assert texts[i] == f"T{i}\nOne & {i} two\nThree {i} four\nFive <{i}> < 6"
    assert texts[100] == "Only" and texts[101] == "plain text é" and texts[102] == "" and texts[106] == ""
    assert texts[103] == texts[104] == "Same\ncopy text"
    assert texts[105] == "unclosed bold\nnext" + "\nlong text" * 3000
    assert html_text.extracted(df.limit(0)).count() == 0


def test_template_classes(spark):
    rows = [(i, f"http://h.example/{i}", page(f"T{i}", f"<p>{cases.prose(i, 30)}</p>", "ad", "<p>Read more on host</p>")) for i in range(10)]
    (r,) = html_text.templates(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert r.host == "h.example" and r.main == "html>body>div.story" and len(r.fixed) == 1


def test_pages_that_all_occur_twice(spark):
    """Rows repeated an even number of times: the host keeps its template."""
    rows = [(i, f"http://h.example/{i}", page(f"T{i}", f"<p>{cases.prose(i, 30)}</p>", "ad", "<p>Read more on host</p><p>twice</p><p>twice</p>")) for i in range(10)]
    (r,) = html_text.templates(spark.createDataFrame(rows * 2, "page_id long, url string, html string")).collect()
    assert r.main == "html>body>div.story" and len(r.fixed) == 1


def texts_of(html):
    return [t for _, furniture, t in html_text.blocks(html)[0] if not furniture]


def test_elements_that_are_skipped_close():
    assert texts_of("<body><video src=x><article><p>One</p><object><p>Two</p></article><p>Three</p></body>") == ["One", "Two", "Three"]
    assert texts_of("<article><video><p>no</p><p>One</p></article><p>Two</p><video>no</video>") == ["Two"]
    assert texts_of("<div><video><article><p>One</p></article></div><video>no</video>") == ["One"]
    assert texts_of("<p>a <object>x<object>y</object>z<div>w</div></object>b <svg><svg></svg><text>t</text></svg><math><mi>c</mi></math></p>") == ["a b c"]
    assert texts_of("<p>a<script>'</p>'</script>b</p><p>c</p>") == ["ab", "c"]


def test_furniture_words_of_wrappers():
    for outside in ("<body class='single no-sidebar'>", "<body><form id='aspnetForm'>", "<body><div class='page-with-sidebar'>", "<html class='has-sidebar comments-open'><body>"):
        for article in ("<article class='post related-topic'>", "<main class='no-sidebar'>", "<div>"):
            assert texts_of(f"{outside}<nav>Menu</nav>{article}<p>{'A long story. ' * 9}</p><div class='ad'>Buy</div>") == [("A long story. " * 9).strip()]
    assert texts_of("<body><div class='story'>Short story</div><div id='comments'>Many long comments, and more of them</div>") == ["Short story"]
    assert html_text.main_text("<body><div class='sidebar'>One</div><div class='widget'>Two</div><p hidden>no</p>", None, frozenset()) == "One\nTwo"


def test_comments_are_no_article():
    """A short story under many comments, wherever they stand; wrappers that hold the heading are none of them."""
    story = "<h1>Title</h1><p>A short story of a few words.</p>"
    comments = "".join(f"<article class='comment-body'><h3>User {i}</h3><p>Comment {i}, much longer than the story is.</p><p>And more.</p></article>" for i in range(40))
    want = ["Title", "A short story of a few words."]
    for section in ("<div id='comments'>{}</div>", "<section class='comments'>{}</section>", "<div class='discussion'><form>{}</form></div>"):
        mine = section.format(comments)
        assert texts_of(f"<body><article>{story}{mine}</article></body>") == want
        assert texts_of(f"<body><div class='story'>{story}</div>{mine}</body>") == want
        assert texts_of(f"<body><div class='page with-sidebar comments-open'><nav>Menu</nav>{story}<p>End.</p>{mine}</div></body>") == [*want, "End."]
        assert texts_of(f"<body><form id='aspnetForm'><nav>Menu</nav>{story}<p>End.</p>{mine}</form></body>") == [*want, "End."]
        assert texts_of(f"<body><div class='story'><p>No heading here.</p></div>{mine}</body>") == ["No heading here."]
    assert texts_of(f"<body><header><h1>Site</h1><p>a</p><p>b</p></header><main>{story}</main></body>") == want


def test_long_pages_take_linear_time():
    """What nothing closes: tags, quotes, comments, elements, furniture; each page within seconds."""
    big = 500_000
    pages = {
        "<a": "<a" * (big // 2),
        '<a ">"': "<p>x</p>" + '<a ">"' * (big // 6),
        "<!": "<!" * (big // 2),
        "div": "<div>" * (big // 5) + "deep",
        "div texts": "<div>t " * (big // 7),
        "forms": "<form><nav>" * (big // 11) + "x",
        "ends": "<div>" * (big // 20) + "</p></section>" * (big // 20) + "y",
        "scripts": "<script>" + "</script" * (big // 8),
        "classes": "<div class='" + "k" * 5000 + "'>" * 1 + "<div class='" * 1 + "w " * 2000 + "'>" + "z",
    }
    started = time.perf_counter()
    found = {name: html_text.blocks(page) for name, page in pages.items()}
    assert time.perf_counter() - started < 60
    assert found["<a"][0][0][2] == pages["<a"] and found["div"][0][-1][2] == "deep" and found["ends"][0][-1][2] == "y"
    assert len(found["div texts"][0]) == big // 7
    assert sum(len(p) for _, nodes in found.values() for p in nodes.paths) < 20_000_000


def test_depth_beyond_the_limit_stays_whole():
    inner = "<div>" * (html_text.MOST_DEEP + 50) + "<p>one</p><p>two</p>"
    assert html_text.main_text(f"<article>{inner}</article>", None, frozenset()) == "one\ntwo"


def test_template_texts_on_hosts_of_few_pages(spark):
    """One rule at every size; copies of an article, also nearly equal ones, are no template."""
    notice = "<p>Read more on host</p>"
    story = "".join(f"<p>{cases.prose(k, 20)}</p>" for k in range(5))
    rows = [(i, f"http://few.example/{i}", page(f"T{i}", f"<p>{cases.prose(i, 30)}</p>", "ad", notice)) for i in range(2)]
    rows += [(10 + i, f"http://copies.example/{i}", page(f"T{i}", story, f"ad {i}")) for i in range(3)]
    rows += [(20 + i, f"http://mixed.example/{i}", page("Same", story, f"ad {i}")) for i in range(9)] + [(30, "http://mixed.example/30", page("Other", f"<p>{cases.prose(99, 300)}</p>", "ad"))]
    texts = {r.page_id: r.text for r in html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all("Read more" not in texts[i] and texts[i].startswith(f"T{i}\n") for i in range(2))
    assert all(len(texts[i].split("\n")) == 6 for i in (10, 11, 12, *range(20, 29)))
