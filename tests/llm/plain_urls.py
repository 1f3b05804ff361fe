"""A plain version of the URL filter."""

from __future__ import annotations

import math

import xxhash

from martflow.llm import urls


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[at:]
    end = min((path.index(c) for c in "?#" if c in path), default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at]), path[:end]


def rule_of(host, path, rules):
    fitting = [(len(h) + len(p), verdict, h + p) for verdict, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fitting)[:0:-1] if fitting else (None, None)


def grams(host, path):
    found = []
    for field, text in enumerate((host, path)):
        letters = "<" + "".join("0" if c in "123456789" else c for c in text) + ">"
        for n in urls.GRAMS:
            for i in range(len(letters) - n + 1):
                h = xxhash.xxh64(field.to_bytes(4, "little"), seed=42).intdigest()
                for c in letters[i:i + n]:
                    h = xxhash.xxh64(c.encode(), seed=h).intdigest()
                found.append((h - (1 << 64) if h >= 1 << 63 else h) % urls.BUCKETS)
    return found


def score(host, path, model):
    own = grams(host, path)
    total = model.base + sum(float(f"{model.weights[i]:.7g}") for i in own) / math.sqrt(max(len(own), 1))
    return 1 / (1 + math.exp(-total))
