"""Plain versions of the corpus operators, written for clarity."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import xxhash


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def word_repeats(docs: dict[int, str | None], window: int = 20) -> dict[int, tuple]:
    seen, out = set(), {}
    for doc in sorted(docs):
        words = (docs[doc] or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            run = tuple(words[i : i + window])
            if run in seen:
                gone[i : i + window] = [True] * window
            seen.add(run)
        out[doc] = len(words), sum(gone), sha(b" ".join(w for w, g in zip(words, gone) if not g))
    return out


def byte_repeats(docs: dict[int, str | None], window: int = 50) -> dict[int, tuple]:
    seen, out = set(), {}
    for doc in sorted(docs):
        data = (docs[doc] or "").encode()
        gone, own = np.zeros(len(data) + 1, bool), set()
        for i in range(len(data) - window + 1):
            part = data[i : i + window]
            if part in seen:
                gone[i : i + window] = True
            own.add(part)
        seen |= own
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out[doc] = len(data), int(gone.sum()), runs, sha(np.frombuffer(data, np.uint8)[~gone[:-1]].tobytes())
    return out


def roots(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def simhash(text: str | None, width: int = 3) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(docs: dict[int, str | None], radius: int = 2) -> dict[int, tuple]:
    codes = {d: simhash(t) for d, t in docs.items()}
    ids = sorted(codes)
    array = np.array([codes[d] for d in ids], np.uint64)
    links = []
    for i, code in enumerate(array):
        links += [(ids[i], ids[j]) for j in np.flatnonzero(np.bitwise_count(array ^ code) <= radius)]
    root = roots(ids, links)
    return {d: (f"{codes[d]:016x}", root[d]) for d in ids}


KEYWORDS = "(password|passwd|secret|token|api_?key)"
ASSIGN = re.compile(KEYWORDS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_secrets(text: str | None) -> list[tuple[int, str, int, str]]:
    text = text or ""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def base_digest(text: str | None) -> tuple:
    found = base_secrets(text)
    names = ("assign", "access", "hex")
    return (*(sum(k == i for _, k, _, _ in found) for i in range(3)), sha(",".join(f"{names[k]}:{s}:{e}" for s, k, e, _ in found).encode()))


def vector_links(vectors: dict[int, list | None], bound: float = 0.95) -> dict[int, tuple]:
    usable = {}
    for k, v in vectors.items():
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v, np.float64)
            usable[k] = a / np.sqrt((a * a).sum())
    links = [(a, b) for a in usable for b in usable if a < b and len(usable[a]) == len(usable[b]) and float(usable[a] @ usable[b]) >= bound]
    root = roots(vectors, links)
    count = {k: 0 for k in vectors}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return {k: (count[k], root[k], root[k] == k) for k in vectors}


def token_index(docs: dict[int, str | None], tokenizer, end_id: int = 2) -> dict[int, tuple]:
    start, out = 0, {}
    for doc in sorted(docs):
        ids = tokenizer.encode(docs[doc] or "", add_special_tokens=False).ids + [end_id]
        out[doc] = start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    return out


def tokens(text: str | None) -> list[str]:
    return [t for t in re.split(r"[\W_]+", (text or "").lower()) if t]


def overlaps(docs: dict[int, str | None], items: dict[int, str], window: int = 13, least: int = 11) -> set[tuple]:
    """Every aligned pair with enough equal tokens, without any seed."""
    out = set()
    for doc, text in docs.items():
        words = tokens(text)
        for item, other in items.items():
            other = tokens(other)
            for shift in range(-len(other) + 1, len(words)):
                low, high = max(0, -shift), min(len(other), len(words) - shift)
                width = min(window, len(other))
                same = np.array([other[i] == words[i + shift] for i in range(low, high)], int)
                if width and len(same) >= width and np.convolve(same, np.ones(width, int), "valid").max() >= -(-width * least // window):
                    out.add((doc, item))
    return out


def planted(doc: int, text: str | None) -> list[bytes]:
    """The words of a document after the planting of runs."""
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def periodic_runs(words: list, least: int = 6, times: int = 4) -> list[tuple]:
    """Every run (start, length, period), by start, then period, straight from the definition."""
    n, out = len(words), []
    for period in range(1, n // times + 1):
        start = 0
        while start + period < n:
            stop = start
            while stop + period < n and words[stop] == words[stop + period]:
                stop += 1
            length = stop - start + period
            if stop > start and length >= max(least, times * period):
                part = words[start : start + length]
                if not any(part[q:] == part[:-q] for q in range(1, period)):
                    out.append((start, length, period))
            start = stop + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_row(doc: int, text: str | None) -> tuple:
    words = planted(doc, text)
    found = periodic_runs(words)
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found).encode()
    return len(found), *best, best[1] * 1000 // best[2] if found else None, sha(listed), sha(kept)


def best_products(vectors: list[tuple], picked, k: int = 5) -> set[tuple]:
    """(query_id, rank, vec_id, score) over different rows (id, vector); scores end at the ends of a long."""
    import math

    end, rows = (1 << 63) - 1, {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            rows[i, tuple(math.floor(256 * float(x)) for x in v)] = None
    out = set()
    for i, v in rows:
        if picked(i):
            scored = sorted((max(-end, min(end, -sum(a * b for a, b in zip(v, w)))), j) for j, w in rows if j != i and len(w) == len(v))
            out |= {(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)}
    return out


def rebuilt(rows: list[tuple]) -> dict[int, list[tuple]]:
    """Conversations of rows (conv_id, turn, role, text), each with the first turns of the one before it that five divides."""
    own = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(conv, []).append((role or "", text or ""))
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[: h[c]] + turns[h[c] :] for c, turns in own.items()}


def trie(convs: dict[int, list[tuple]]) -> set[tuple]:
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0) + sum(saved[b] for b in below)
    return {
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])), leaves[node], saved[node],
         sha(",".join(map(str, sorted(ends.get(node, [])))).encode()))
        for node, m in members.items()
    }


BARE = re.compile(r"[A-Za-z0-9+/_=-]+")


def secret_rows(docs: dict[int, tuple], copied: int = 3) -> dict[int, tuple]:
    """(n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, n_shared, most_repos) of documents (text, owner)."""
    names = ("assign", "access", "hex", "seen")
    base = {d: base_secrets(t) for d, (t, _) in docs.items()}
    values = {v for found in base.values() for *_, v in found}
    spans = {}
    for d, (text, _) in docs.items():
        seen = [(m.start(), 3, m.end(), m[0]) for m in BARE.finditer(text or "") if len(m[0]) >= 12 and re.search("[0-9]", m[0]) and m[0] in values]
        spans[d] = sorted(base[d] + [s for s in seen if not any(b[0] < s[2] and s[0] < b[2] for b in base[d])])
    owners, repos = {}, {}
    for d, (_, owner) in docs.items():
        for *_, v in spans[d]:
            owners.setdefault(v, set()).add(owner or "")
            repos.setdefault(v, set()).add(d)
    out = {}
    for d in docs:
        verdicts = ["example" if len(owners[v]) >= copied else "live" if len(owners[v]) == 1 else "shared" for *_, v in base[d]]
        out[d] = (
            *base_digest(docs[d][0]), ",".join(f"{names[k]}:{s}:{e}" for s, k, e, _ in spans[d]),
            *(verdicts.count(x) for x in ("live", "example", "shared")), max((len(repos[v]) for *_, v in base[d]), default=0),
        )
    return out


def water_fill(sizes: list[int], weights: list[int], max_epochs: int) -> list:
    """Targets in exact fractions: who is above the cap is clamped to it, the rest is shared anew."""
    from fractions import Fraction

    left, free, target = Fraction(sum(sizes)), list(range(len(sizes))), [Fraction(0)] * len(sizes)
    while free:
        unit = left / sum(weights[i] for i in free)
        over = [i for i in free if unit * weights[i] > max_epochs * sizes[i]]
        for i in over or free:
            target[i] = Fraction(max_epochs * sizes[i]) if over else unit * weights[i]
        if not over:
            break
        left -= sum(target[i] for i in over)
        free = [i for i in free if i not in over]
    return target


def mixture(docs: list[tuple], weights: tuple = (5, 2, 1), max_epochs: int = 3) -> dict:
    """doc → (size, source_size, target, taken) of rows (doc, source, size, u): the first by ``u`` once more, the one at the edge in part."""
    by = {}
    for doc, source, size, u in docs:
        by.setdefault(source, []).append((u, doc, size))
    names = sorted(by, key=lambda s: (s is None, s or ""))
    sizes = [sum(size for *_, size in by[s]) for s in names]
    goals, out = water_fill(sizes, [weights[i % len(weights)] for i in range(len(names))], max_epochs), {}
    for name, total, goal in zip(names, sizes, goals):
        whole = goal // total if total else 0
        left = round(goal) - whole * total
        for _, doc, size in sorted(by[name]):
            part = min(size, left)
            left -= part
            out[doc] = size, total, float(goal), int(whole * size + part)
    return out
