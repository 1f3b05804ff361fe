"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SPACES = b" \t\n\x0b\x0c\r"


def words(text):
    return WORD.findall((text or "").encode())


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def kept_lines(rows):
    """(doc_id, n_lines, n_dropped, text) of (doc_id, text)."""
    key = lambda line: line.strip(SPACES).lower()
    order = lambda doc: (doc is None, doc or 0)
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").encode().split(b"\n"):
            if len(key(line).decode()) >= 10:
                holders[key(line)].add(order(doc))
    out = []
    for doc, text in rows:
        lines = (text or "").encode().split(b"\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == order(doc)]
        out.append((doc, len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
    return out


def shingle_set(text, n=5):
    found = words((text or "").encode().lower().decode())
    return frozenset(tuple(found[i:i + n]) for i in range(max(1, len(found) - n + 1))) if found else frozenset()


def near_groups(rows, alike=75):
    """Per row (size, representative index) by comparing all pairs."""
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= alike * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    smallest = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return [(rows[i][0], len(sets[i]), smallest[root(i)] if sets[i] else rows[i][0]) for i in range(len(rows))]


def cut_passages(rows, window=35):
    """(n_words, n_removed, kept) of each row."""
    split = [words(text) for _, text in rows]
    count = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def base_spans(text):
    """The base kinds as the task words them."""
    text = text or ""
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    for at, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 16), (2, "hex", "[0-9a-f]+", 32)):
        found += [(m.start(), at, kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def crc(ids):
    return zlib.crc32(b"".join(int(x).to_bytes(4, "little") for x in ids))


# ---- fingerprints ------------------------------------------------------------------------------

def simhash(text):
    """The fingerprint of a whole text by signed votes of its weighted word pairs."""
    found = [w.decode() for w in words(text)]
    votes = [0] * 128
    for i, word in enumerate(found):
        after = found[i + 1] if i + 1 < len(found) else None
        weight = min(3, 1 + (len(word) + len(after or "")) // 8)
        h = xxhash.xxh64(word.encode(), seed=42).intdigest()
        if after is not None:
            h = xxhash.xxh64(after.encode(), seed=h).intdigest()
        g = xxhash.xxh64(h.to_bytes(8, "little"), seed=42).intdigest()
        for at, x in ((64, h), (0, g)):
            for bit in range(64):
                votes[at + bit] += weight if x >> bit & 1 else -weight
    return f"{sum(1 << i for i, v in enumerate(votes) if v > 0):032x}"


# ---- conversations -----------------------------------------------------------------------------

def damaged(rows):
    """(conv_id, turn, role, text) after the query's faults."""
    said = lambda x: " " if x is None else str(x)
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", said(text)) if fault == 2 else said(text)
        out += [(conv, turn, "user" if fault == 4 else said(role), text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def order_of_turns(row):
    _, turn, role, text = row
    return turn is not None, turn or 0, (role or " ").encode(), hashlib.sha256((" " if text is None else text).encode()).digest()


def repaired(rows):
    """Per conv_id of (conv_id, turn, role, text): gaps, faults, cost, audit and repaired text, by trying all edits."""
    said = lambda x: " " if x is None else x
    convs = defaultdict(list)
    for row in rows:
        convs[row[0]].append(row)
    out = {}
    for conv, own in convs.items():
        own.sort(key=order_of_turns)
        own = [(turn, said(role), said(text)) for _, turn, role, text in own]
        faults, seen = [], set()
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        # Every way to read the rows so far, by the roles' initials that matter: the last one, and whether there are any.
        best = {"": (0, "", ())}

        def insert(best):
            for _ in range(3):
                for state, (cost, audit, kept) in list(best.items()):
                    role = "assistant" if state == "u" else "user"
                    new = (cost + 3, audit + "I", kept + (f"{role}:",))
                    if role[0] not in best or new[:2] < best[role[0]][:2]:
                        best[role[0]] = new
            return best

        for (_, role, text), fault in zip(own, faults):
            after = {}
            for state, (cost, audit, kept) in insert(dict(best)).items():
                options = [("D", None, 4)]
                if fault in ("", "truncated"):
                    more = 3 * (fault == "truncated")
                    options += [("K", role, more), ("R", "user", 3 + more), ("R", "assistant", 3 + more)]
                for edit, name, price in options:
                    if name is None:
                        to, line = state, ()
                    elif name[:1] == "s" and state == "" or name[:1] == "u" and state in ("", "s", "a") or name[:1] == "a" and state == "u":
                        to, line = name[:1], (f"{name}:{text}",)
                    else:
                        continue
                    new = (cost + price, audit + edit, kept + line)
                    if to not in after or new[:2] < after[to][:2]:
                        after[to] = new
            best = after
        cost, audit, kept = min(v for k, v in insert(dict(best)).items() if k in ("", "a"))
        turns = [t for t, _, _ in own if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, "\n".join(kept),
        )
    return out


# ---- hard negatives ----------------------------------------------------------------------------

def hard_negatives(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (vec_id, embedding, label), by all pairs."""
    good = lambda v: v is not None and all(x is not None and math.isfinite(256 * x) for x in v)
    used = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if i is not None and label is not None and good(v)]
    out = []
    for at, (anchor, a, label) in enumerate(used):
        if not is_anchor(anchor):
            continue
        scored = sorted(
            (-max(-(2**63) + 1, min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), i, other)
            for place, (i, b, other) in enumerate(used) if place != at and len(b) == len(a))
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out += [(anchor, i, rank + 1, n[1], -p, -n[0]) for rank, n in enumerate(inside)]
    return out
