"""Brute-force versions of the numbered operators, in plain Python."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))


def lettered(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))


def shingles(text):
    w = spaced(text)
    return frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def near(docs):
    """doc_id, n_shingles, component_id, kept; ``docs`` are (doc_id, text), ids may be None or repeat."""
    sets = [shingles(text) for _, text in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in holders[g])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for g in s:
            holders[g].append(i)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        ids[root(i)].append(doc_id)
    low = {r: min((x for x in found if x is not None), default=None) for r, found in ids.items()}
    return sorted(
        ((d, len(sets[i]), low[root(i)], d == low[root(i)]) for i, (d, _) in enumerate(docs)), key=repr
    )


def warc(pages):
    first, out = {}, []
    for page_id, html in sorted(pages, key=lambda p: p[0]):
        payload = (html or "").encode()
        of = first.setdefault(payload, page_id)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        again = of != page_id
        out.append((page_id, len(payload), digest, "revisit" if again else "response", of if again else None))
    return sorted(out, key=repr)


def tokens(docs, path):
    """Rows of one doc_id come in the order of Spark's xxhash64 of the text, then of the text."""
    import xxhash
    from tokenizers import Tokenizer

    def order(doc):
        doc_id, text = doc
        hashed = 42 if text is None else xxhash.xxh64(text.encode(), seed=42).intdigest()
        hashed -= (hashed >> 63) << 64
        return (doc_id is not None, doc_id or 0, hashed, text is not None, text or "")

    coder, start, out = Tokenizer.from_file(path), 0, []
    for doc_id, text in sorted(docs, key=order):
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def exact(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[(text or "").translate(AZ)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = False
        for i in ids:
            out.append((i, keep, len(ids), i == keep and not kept, sha))
            kept |= i == keep
    return sorted(out, key=repr)


def contaminated(docs, items):
    windows = defaultdict(set)
    for item_id, text in items:
        w = lettered(text)
        n = min(10, len(w))
        for j in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[j : j + n])].add(item_id)
    lengths, out = sorted({len(x) for x in windows}), []
    for doc_id, text in docs:
        w, hit, found = lettered(text), set(), set()
        for n in lengths:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(w[j : j + n])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def line_runs(docs, m):
    """doc_id, new text; ``docs`` in the order of doc_id (and row)."""
    split = [None if text is None else text.split("\n") for _, text in docs]
    first, first_cover, later_cover, places = {}, set(), set(), defaultdict(list)
    for i, parts in enumerate(split):
        for j in range(len(parts or []) - m + 1):
            window = tuple(parts[j : j + m])
            first.setdefault(window, (i, j))
            places[window].append((i, j))
    for window, found in places.items():
        for i, j in found:
            if len(found) > 1:
                (first_cover if first[window] == (i, j) else later_cover).update((i, k) for k in range(j, j + m))
    gone = later_cover - first_cover
    return sorted(
        (
            (d, None if parts is None else "\n".join(x for k, x in enumerate(parts) if (i, k) not in gone))
            for i, ((d, _), parts) in enumerate(zip(docs, split))
        ),
        key=repr,
    )


def common(x, y):
    row = [0] * (len(y) + 1)
    for p in x:
        last = 0
        for j, q in enumerate(y, 1):
            last, row[j] = row[j], last + 1 if p == q else max(row[j], row[j - 1])
    return row[-1]


def substrings(docs, length=50):
    """doc_id, n_bytes, n_removed, n_spans, sha256; ``docs`` are (doc_id, text), ids may be None or repeat."""
    last = 1 << 63
    raw = [(last if i is None else i, (t or "").encode()) for i, t in docs]
    first = {}
    for i, data in raw:
        for at in range(len(data) - length + 1):
            string = data[at : at + length]
            first[string] = min(first.get(string, last), i)
    out = []
    for (doc_id, _), (i, data) in zip(docs, raw):
        gone = [False] * len(data)
        for at in range(len(data) - length + 1):
            if first[data[at : at + length]] < i:
                gone[at : at + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def quantised(rows, parts=16, entries=64, rounds=2):
    """vec_id, code, error, label_error, codebooks hash; ``rows`` are (vec_id, vector, label), ids not null."""
    kept = []
    for vec_id, vector, label in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            whole = [math.floor(256 * x) for x in vector]
            width = len(whole) // parts
            kept.append((vec_id, [tuple(whole[p * width : (p + 1) * width]) for p in range(parts)], label))
    if not kept:
        return []
    first = sorted(kept, key=lambda r: (r[0], r[1]))[:entries]
    books = [[r[1][p] for r in first] for p in range(parts)]

    def nearest(p, point):
        return min((sum((a - b) ** 2 for a, b in zip(point, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        held = [defaultdict(list) for _ in range(parts)]
        for _, points, _ in kept:
            for p, point in enumerate(points):
                held[p][nearest(p, point)[1]].append(point)
        for p in range(parts):
            for i, points in held[p].items():
                books[p][i] = tuple(sum(x) // len(points) for x in zip(*points))
    out = []
    for vec_id, points, label in kept:
        found = [nearest(p, point) for p, point in enumerate(points)]
        out.append((vec_id, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), label))
    of_label = Counter()
    for _, _, error, label in out:
        of_label[label] += error
    numbers = ",".join(str(x) for p in range(parts) for e in books[p] for x in e)
    sha = hashlib.sha256(numbers.encode()).hexdigest()
    return sorted(((v, c, e, of_label[label], sha) for v, c, e, label in out), key=repr)


def damaged(rows):
    """Rows (conv_id, turn, role, text) with the faults of op11."""
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def conversations(rows):
    """The columns of op11 for every conv_id: all edits of a row tried in every state, the least (cost, audit) kept."""
    kept = defaultdict(list)
    for conv_id, turn, role, text in damaged(rows):
        sha = hashlib.sha256(text.encode()).digest()
        kept[conv_id].append((turn is not None, turn or 0, role, sha, text))
    out = []
    for conv_id in {r[0] for r in rows}:
        turns = sorted(kept[conv_id])
        known = [t[1] for t in turns if t[0]]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        seen, faults = set(), []
        for _, _, role, _, text in turns:
            solid = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        initials = [t[2][:1] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        # state is "", s, u or a; value is (cost, audit, repaired rows)
        paths = {"": (0, "", ())}
        follows = {"": "su", "s": "u", "u": "a", "a": "u"}
        full = {"s": "system", "u": "user", "a": "assistant"}

        def better(to, state, path):
            if state not in to or path[:2] < to[state][:2]:
                to[state] = path

        def inserting(paths):
            for _ in range(3):
                for state, (cost, audit, done) in list(paths.items()):
                    due = follows[state][-1]
                    better(paths, due, (cost + 2, audit + "I", (*done, f"{full[due]}:")))
            return paths

        for (_, _, role, _, text), fault, initial in zip(turns, faults, initials):
            after = {}
            for state, (cost, audit, done) in inserting(paths).items():
                better(after, state, (cost + 3, audit + "D", done))
                if fault not in ("blank", "duplicate"):
                    cost += fault == "truncated"
                    if initial and initial in follows[state]:
                        better(after, initial, (cost, audit + "K", (*done, f"{role}:{text}")))
                    due = follows[state][-1]
                    better(after, due, (cost + 2, audit + "R", (*done, f"{full[due]}:{text}")))
            paths = after
        cost, audit, done = min(p for s, p in inserting(paths).items() if s in ("", "a"))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv_id, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest()))
    return sorted(out, key=repr)
