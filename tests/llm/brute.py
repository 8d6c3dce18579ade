"""Plain single-process versions of the operators, for small tables."""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

LOWER = {i: i + 32 for i in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(text, items, n=10):
    cut = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    words, hit, found = cut(text), set(), set()
    for item, value in items:
        own = cut(value)
        for i in range(max(1, len(own) - n + 1) if own else 0):
            w = own[i : i + n]
            for j in range(len(words) - len(w) + 1):
                if words[j : j + len(w)] == w:
                    hit |= set(range(j, j + len(w)))
                    found.add(str(item))
    return len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


def fingerprint(text):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def components(values, bits=2):
    """Index of the first member of each value's group."""
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(values)), 2):
        if (values[a] ^ values[b]).bit_count() <= bits:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out)]


WEAK = {
    "identifier": (re.compile(r"""(?i:access_?key_?id|client_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]+)"""), 3),
    "secret": (re.compile(r"""(?i:pwd|passphrase|auth|credential|private_?key|signature)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 6),
    "endpoint": (re.compile(r"""((?i:https?|jdbc:[a-z0-9]+|postgres|mysql|redis|amqp|s3)://[^\x00-\x20"'<>]+)"""), 1),
}


def all_secrets(text, scope=400):
    """Strong spans and linked weak ones, by start and kind."""
    strong = [s.split(":") for s in base_secrets(text)]
    parts = [({"access": "identifier"}.get(k, "secret"), int(a)) for k, a, _ in strong]
    weak = [(m.start(), kind, m.end()) for kind, (p, least) in WEAK.items() for m in p.finditer(text or "") if len(m[1]) >= least]
    parts += [(kind, a) for a, kind, _ in weak]
    order = ["assign", "access", "hex", "identifier", "secret", "endpoint"]
    out = [(int(a), order.index(k), int(b)) for k, a, b in strong]
    for a, kind, b in weak:
        near = {p for p, at in parts if abs(at - a) <= scope}
        if {"secret": near & {"identifier", "endpoint"}, "identifier": near & {"secret"}, "endpoint": {"identifier", "secret"} <= near}[kind]:
            out.append((a, order.index(kind), b))
    return [f"{order[k]}:{a}:{b}" for a, k, b in sorted(out)]


def repeats(texts, least=200):
    """(n_bytes, n_removed, n_spans, checksum of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + least] for b in data for k in range(len(b) - least + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - least + 1):
            if seen[b[k : k + least]] > 1:
                gone[k : k + least] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return out


def edited(texts):
    """Each text with its last quarter replaced by the start of the next one."""
    texts = [t or "" for t in texts]
    return [t[: len(t) - len(t) // 4] + texts[(i + 1) % len(texts)][: len(t) // 4] for i, t in enumerate(texts)]


def chat_cost(roles, insert=2, relabel=3, same=1, other=4):
    """Least price of a legal conversation from the given roles."""
    end = {None: 0, "system": 2 * insert, "user": insert, "assistant": 0}

    @functools.lru_cache(None)
    def go(i, last):
        if i == len(roles):
            return end[last]
        ways = [(same if roles[i] == last else other) + go(i + 1, last)] if last else []
        for label in ("system", "user", "assistant"):
            price = 0 if label == roles[i] else relabel
            if label == "system" and last is None:
                ways.append(price + go(i + 1, label))
            if label == "user":
                ways.append(price + (insert if last == "user" else 0) + go(i + 1, label))
            if label == "assistant":
                ways.append(price + (0 if last == "user" else insert) + go(i + 1, label))
        return min(ways)

    return go(0, None)


LEGAL = re.compile(r"(?:<\|system\|>\n(?s:.*?)<\|end\|>\n)?(?:<\|user\|>\n(?s:.*?)<\|end\|>\n<\|assistant\|>\n(?s:.*?)<\|end\|>\n)+")


def check_packing(pieces, ids, room=1024):
    """Every id in one piece, checksums right, sequences gapless; gives the share of padding."""
    covered, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        own = ids[p.doc_id]
        part = np.array(own[p.start : p.start + p.length], "<u4").tobytes()
        assert len(part) == 4 * p.length and p.doc_tokens == len(own)
        assert zlib.crc32(part) == p.ids_crc32
        covered[p.doc_id].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    for doc, own in ids.items():
        at = 0
        for start, length in sorted(covered[doc]):
            assert start == at
            at += length
        assert at == len(own)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= room
        padding += 0 if at & (at - 1) == 0 else room - at
    assert sorted(sequences) == list(range(len(sequences)))
    return padding / (room * len(sequences)) if sequences else 0.0


TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(texts, items, k=20):
    """For each item (score, place of the text) of its best texts, equal scores by place."""
    import math

    cut = lambda t: TERM.findall((t or "").translate(LOWER))
    bags = [Counter(cut(t)) for t in texts]
    n, total = sum(map(bool, bags)), sum(b.total() for b in bags)
    df = Counter(w for b in bags for w in b)
    weight = {w: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for w, d in df.items()}
    out = []
    for item in items:
        scores = []
        for place, bag in enumerate(bags):
            m = 75 + (25 * bag.total() * n) // total if total else 0
            s = sum(weight[w] * ((1_000_000_000 * bag[w]) // (1000 * bag[w] + 12 * m)) for w in cut(item) if w in bag)
            if s > 0:
                scores.append((-s, place))
        out.append([(-s, place) for s, place in sorted(scores)[:k]])
    return out


def audit(rows, labels):
    """(part, order, step) to counts, from (doc_id, text, part) and (doc_id, quality, toxic)."""
    first = {}
    for doc, text, _ in rows:
        if doc is not None:
            first[text or ""] = min(doc, first.get(text or "", doc))
    good, bad = ({d for d, *v in labels if d is not None and v[i] == 1} for i in (0, 1))
    docs = []
    for doc, text, part in rows:
        t = text or ""
        words = re.findall("[^\x20\x09-\x0D]+", t)
        fails = [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t)]
        fails += [any(c in "#$%&*|" for c in t), doc is not None and t in first and doc > first[t]]
        docs.append((part or "", {f for f, x in zip("ABCDE", fails) if x}, doc in good, doc in bad))
    out = {}
    for part in {d[0] for d in docs}:
        own, removed_by = [d for d in docs if d[0] == part], Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                before = len(own) - len(left)
                left = [d for d in left if f not in d[1]]
                failing = sum(f in d[1] for d in own)
                removed_by[f] += len(gone)
                out[part, order, step] = (len(left), len(gone), failing - len(gone), sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone))
                assert before + len(gone) + len(left) == len(own)
        for part_, order, step in list(out):
            if part_ == part:
                out[part, order, step] += (removed_by[order[step - 1]],)
    return out


def article(html):
    """Heading and paragraphs of the one article of a page of the test tables."""
    from html import unescape

    blocks = re.split("</?(?:p|h1)>", re.search("<article>(.*)</article>", html, re.S)[1])
    texts = [" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def least_cut(terminal, edges):
    """Price of the cheapest labelling."""
    ways = itertools.product((False, True), repeat=len(terminal))
    return min(cut_price(terminal, edges, s) for s in ways)


def cut_price(terminal, edges, sides):
    own = sum(abs(t) for t, s in zip(terminal, sides) if (t > 0) != s and t)
    return own + sum(c for a, b, c in edges if sides[a] != sides[b])


def word_runs(text):
    """Runs of words of a text, as its tree must have them."""
    out = []
    for line in (text or "").splitlines(keepends=True):
        held = ""
        for word in re.findall(r"\S+\s*|\s+", line):
            for piece in cut_word(word):
                held += piece
                if len(piece) == 64 or zlib.crc32(piece.encode()) % 3 == 0:
                    out.append(held)
                    held = ""
        if held:
            out.append(held)
    return out


def cut_word(word):
    if len(word) <= 32:
        return [word]
    fits = []
    for i in range(len(word) - 3):
        h = 0
        for c in word[i : i + 4]:
            h = (h ^ ord(c)) * 0x9E3779B97F4A7C15 % (1 << 64)
            h ^= h >> 29
        fits.append(h & 7 == 0)
    cuts = [0, *(i + 4 for i, f in enumerate(fits) if f and not any(fits[max(0, i - 3) : i])), len(word)]
    return [word[i : min(i + 64, b)] for a, b in zip(cuts, cuts[1:]) for i in range(a, b, 64)]


def run_likeness(a, b):
    """Share of the word runs that both texts have, repeats counted."""
    left, right = Counter(word_runs(a)), Counter(word_runs(b))
    total = left.total() + right.total()
    return 1.0 if a == b else min(2 * (left & right).total() / total, 0.999999) if total else 0.0
