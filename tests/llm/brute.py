"""The contracts in plain Python, for small fixtures."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def quality(text):
    words, text = spaced(text), text or ""
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if spaced(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed


def licenses(text):
    words, places, labels = alnum(text), [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def benchmark_hits(text, items):
    """(n_words, n_hit, item ids)."""
    words, hit, found = alnum(text), set(), set()
    for item, body in items:
        own = alnum(body)
        m = min(10, len(own))
        windows = {tuple(own[i : i + m]) for i in range(len(own) - m + 1)} if m and item is not None else set()
        for i in range(len(words) - m + 1):
            if m and tuple(words[i : i + m]) in windows:
                hit |= set(range(i, i + m))
                found.add(str(item))
    return len(words), len(hit), ",".join(sorted(found))


_KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def _valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def personal(text):
    return [(kind, m.start(), m.end()) for kind, pattern in _KINDS for m in re.finditer(pattern, text or "") if _valid(kind, m[0])]


def repeats(texts, length):
    """(n_bytes, n_removed, n_spans, digest of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(b[p : p + length] for b in data for p in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if counts[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), runs, sha(bytes(c for c, g in zip(b, gone, strict=True) if not g))))
    return out


def shingles(text):
    words = spaced((text or "").translate(_LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components(rows):
    """(n_shingles, component id) of each (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[root(i)].append(rows[i][0])
    names = {r: min((m for m in own if m is not None), default=None) for r, own in members.items()}
    return [(len(sets[i]), names[root(i)]) for i in range(len(rows))]


def conversation(turns):
    """Digests of (role, text) turns."""
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)), len(loss), sha(loss)


def fill_middle(doc_id, text, seed=7):
    """(n, form, prefix characters, middle characters, output), by lines."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    hexes = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h1, h2, _, h4 = (int(hexes[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if h4 % 100 < 50 else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(units), "spm" if h4 % 100 < 50 else "psm", len(prefix), len(middle), output


_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return host.translate(_LOWER), path


def url_rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in _RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def url_verdicts(pages, rounds=30):
    """(host, path, rule, verdict) of each (url, html)."""
    parsed = [(*url_parts(u), h) for u, h in pages]
    counts, edges = defaultdict(Counter), set()
    for host, path, html in parsed:
        if host:
            counts[host].update(["all", url_rule(host, path)[1]])
            for target in re.findall(r"""(?i)\shref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)""", html or ""):
                if target.translate(_LOWER) != host:
                    edges.add((host, target.translate(_LOWER)))
    shares = {}
    for kind, links in (("allow", edges), ("block", {(b, a) for a, b in edges})):
        other = {"allow": "block"}.get(kind)
        own = [h for h, c in counts.items() if 2 * c[kind] >= c["all"] and not (other and 2 * c[other] >= c["all"])]
        next_of = defaultdict(list)
        for a, b in links:
            next_of[a].append(b)
        wave = {h: 10**15 // len(own) for h in own}
        rank = Counter(wave)
        for _ in range(rounds):
            passed = Counter()
            for h, mass in wave.items():
                for b in next_of[h]:
                    passed[b] += mass * 85 // (100 * len(next_of[h]))
            wave = {h: m for h, m in passed.items() if m}
            rank.update(wave)
        total = sum(rank.values()) or 1
        shares[kind] = {h: m / total for h, m in rank.items()}
    out = []
    for host, path, _ in parsed:
        rule, verdict = url_rule(host, path)
        bad = shares["block"].get(host, 0) >= 1e-6 and shares["block"].get(host, 0) > shares["allow"].get(host, 0)
        out.append((host, path, rule, verdict or ("block" if bad else "allow")))
    return out


def damaged(rows):
    """Turns (conv_id, turn, role, text) that are left, as the contract damages them."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * {0: 0, 3: 2}.get(draw, 1)
    return out


def cheapest_edits(kinds):
    """Least (cost, audit) by dynamic programming over (turns read, expected state); kinds as (initial, fault)."""
    follow = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    here = {"": (0, "")}

    def filled(labels):
        for _ in range(3):
            for state, (cost, audit) in list(labels.items()):
                for c, to in follow[state].items():
                    if c != "s":
                        labels[to] = min(labels.get(to, (1 << 60, "")), (cost + 3, audit + "I"))
        return labels

    for initial, fault in kinds:
        after = {}
        for state, (cost, audit) in filled(here).items():
            edits = [(state, cost + 4, audit + "D")]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                edits += [(to, cost + more, audit + "K") for c, to in follow[state].items() if c == initial]
                edits += [(to, cost + more + 3, audit + "R") for c, to in follow[state].items() if c != "s"]
            for to, *label in edits:
                after[to] = min(after.get(to, (1 << 60, "")), tuple(label))
        here = after
    return min(label for state, label in filled(here).items() if state in ("", "a"))


def repair(turns):
    """What the contract asks of the (turn, role, text) rows of one conversation after damage."""
    turns = sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    seen, kinds = set(), []
    for _, role, text in turns:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        kinds.append((role[:1], "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None))
        seen.add((role, text))
    numbers = {t for t, _, _ in turns if t is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    faults = Counter(f for _, f in kinds)
    illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(kinds, kinds[1:]))
    cost, audit = cheapest_edits(kinds)
    rest, out = iter(turns), []
    for edit in audit:
        _, role, text = (None, None, "") if edit == "I" else next(rest)
        if edit != "D":
            out.append((role if edit == "K" else "assistant" if out and out[-1][0][0] == "u" else "user", text))
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in out))
