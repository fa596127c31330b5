"""The contracts in plain Python, straight from their wording, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def contamination(docs, items):
    """docs: (id, text); items: (id, text). Per document: n_words, n_hit, n_items, sha."""
    windows = {}
    for item, text in items:
        w = words(text)
        if item is None or not w:
            continue
        n = min(10, len(w))
        for k in range(len(w) - n + 1):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= own
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return Counter(out)


def simhash(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return 0
    runs = [" ".join(w[k : k + n]) for k in range(len(w) - n + 1)] or [" ".join(w)]
    counts = [0] * 64
    for run in runs:
        h = xxhash.xxh64_intdigest(run.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(runs))


def components(docs, limit=2):
    codes = {}
    for doc, text in docs:
        codes.setdefault(simhash(text), []).append(doc)
    keys, root = list(codes), {k: k for k in codes}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= limit:
                root[find(a)] = find(b)
    least = {}
    for k in keys:
        ids = [d for d in codes[k] if d is not None]
        if ids:
            least[find(k)] = min(min(ids), least.get(find(k), min(ids)))
    return Counter((d, f"{k:016x}", least.get(find(k))) for k in keys for d in codes[k])


PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def phrases(text):
    w = words(text)
    places = [(k, label) for p, label in PHRASES.items() for k in range(len(w) - len(p) + 1) if tuple(w[k : k + len(p)]) == p]
    at = [k for k, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in places}))


def notices(text, templates, stride):
    """Labels of templates whose words are held, to the threshold, by a block; and the largest share."""
    w = words(text)
    labels, score = set(), 0.0
    for start in range(0, max(1, len(w)), stride):
        block = w[start : start + 2 * stride]
        for t in templates:
            own = set(t.words)
            share = len(own & set(block)) / len(own)
            ok = any(tuple(block[k : k + len(t.words)]) == t.words for k in range(len(block))) if t.phrase else share >= t.threshold - 1e-9
            if ok:
                labels.add(t.label)
                score = max(score, share)
    return ",".join(sorted(labels)), score


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    text = text or ""
    digits = lambda v: re.sub("[^0-9]", "", v)
    found = {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15],
    }
    joined = ",".join(f"{kind}:{a}:{b}" for kind, spans in found.items() for a, b in spans)
    return (*(len(s) for s in found.values()), sha(joined)), joined


RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def verdict(url, listed):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = host.translate(LOWER)
    fits = lambda h: host == h or host.endswith("." + h)
    found = [(len(h + p), a, h + p) for a, h, p in RULES if fits(h) and path.startswith(p)]
    if found:
        _, action, rule = max(found)
        return host, path, rule, action
    return host, path, None, "block" if any(fits(h) for h in listed) else "allow"


def edited(docs):
    """(id, n_chars, sha of the edited text) by ascending id; ids are distinct here."""
    rows = sorted((d, t or "") for d, t in docs)
    out = []
    for k, (d, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        out.append((d, len(t), sha(t[: len(t) - half] + after[:half])))
    return Counter(out)


def crc(text):
    return zlib.crc32((text or "").encode())


def shingle_set(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def jaccard_components(docs, percent=90):
    """Per row: id, size of its set, smallest id reachable by links."""
    sets = [shingle_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for a, x in enumerate(sets):
        for b in range(a):
            y = sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) and find(a) != find(b):
                if 100 * len(x & y) >= percent * len(x | y):
                    root[find(a)] = find(b)
    least = {}
    for k, (d, _) in enumerate(docs):
        if d is not None:
            least[find(k)] = min(d, least.get(find(k), d))
    return Counter((d, len(sets[k]), least.get(find(k))) for k, (d, _) in enumerate(docs))


def ranking(docs, items, top=10):
    """Per item row its best documents: (item, rank, id, score)."""
    import math

    terms = [Counter(words(t)) for _, t in docs]
    n_docs, total = sum(bool(c) for c in terms), sum(c.total() for c in terms)
    df = Counter(t for c in terms for t in c)
    out = Counter()
    for item, text in items:
        scored = []
        for (d, _), c in zip(docs, terms, strict=True):
            score = 0
            for t in set(words(text)) & set(c):
                m = 100 - 90 + (90 * c.total() * n_docs) // total
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d))
        for rank, (score, _, d) in enumerate(sorted(scored, key=lambda r: (r[0], r[1], r[2] or 0))[:top], 1):
            out[(item, rank, d, -score)] += 1
    return out


def whitened(vectors):
    """Usable vectors as (id, exact deviation), n, and numpy's eigenvalues (falling), axes and centred rows."""
    import math

    import numpy as np

    kept = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    n = len(kept)
    x = np.array([v for _, v in kept], float)
    sums = [sum(v[k] for _, v in kept) for k in range(len(kept[0][1]))]
    deviation = [(i, sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))) for i, v in kept]
    centred = x - np.array(sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return deviation, n, values[::-1], axes[:, ::-1], centred
