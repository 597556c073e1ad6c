"""The operators' contracts in the plainest form, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def contamination(docs, bench, window=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in bench:
        w = word.findall(lower(text or ""))
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i:i + size])].add(item)
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w = word.findall(lower(text or ""))
        hit, items = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                own = windows.get(tuple(w[i:i + size]))
                if own:
                    hit.update(range(i, i + size))
                    items |= own
        n = len(hit)
        out.append((doc, len(w), n, len(items), sha(",".join(sorted(map(str, items))).encode()), n > 0 and 20 * n >= len(w)))
    return out


def line_dedup(docs, min_docs=10, min_chars=1):
    key = lambda line: lower(re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line))
    where = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            where[key(line)].add(doc)
    gone = {k for k, d in where.items() if len(k) >= min_chars and len(d) >= min_docs}
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    return out


def rules(docs):
    out = []
    for doc, text in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        c = Counter(zip(w, w[1:], w[2:]))
        rep = {i + k for i in range(len(w) - 2) for k in range(3) if c[tuple(w[i:i + 3])] > 1}
        out.append((doc, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(rep),
                    len(w) < 50 or 100 * len(rep) > 50 * len(w)))
    return out


def fingerprint(text) -> int:
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_of(fps: list[int], tau=3) -> list[int]:
    """For each fingerprint the index of the first one that it is connected with."""
    a = np.array(fps, np.uint64)
    parent = list(range(len(a)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= tau) + i + 1:
            x, y = find(i), find(int(j))
            parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(a))]


def simhash(docs):
    fps = [fingerprint(t) for _, t in docs]
    group = groups_of(fps)
    least = {}
    for (doc, _), g in zip(docs, group):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    return [(doc, f"{fp:016x}", least.get(g)) for (doc, _), fp, g in zip(docs, fps, group)]


def packed_ids(text, tokenizer) -> bytes:
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()


def check_packing(docs, rows, tokenizer, capacity=4096) -> float:
    """Asserts the contract for (doc_id, start, length, crc, doc_tokens, sequence, offset); the padded share."""
    ids = defaultdict(list)
    for doc, text in docs:
        ids[doc].append(packed_ids(text, tokenizer))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, total, sequence, offset in rows:
        pieces[doc].append((start, length, crc, total))
        sequences[sequence].append((offset, length))
    assert set(pieces) == set(ids)
    for doc, texts in ids.items():
        want = sorted((s, min(capacity, len(x) // 4 - s), len(x) // 4) for x in texts for s in range(0, len(x) // 4, capacity))
        assert sorted((s, n, t) for s, n, _, t in pieces[doc]) == want
        for s, n, crc, _ in pieces[doc]:
            assert crc in {zlib.crc32(x[4 * s:4 * (s + n)]) for x in texts}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return 1 - sum(len(x) // 4 for t in ids.values() for x in t) / (capacity * len(sequences))


def suffixes(docs, length=400):
    starts = Counter()
    data = [(t or "").encode() for _, t in docs]
    for b in data:
        starts.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for (doc, _), b in zip(docs, data):
        gone = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - length + 1):
            if starts[b[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        hit = np.cumsum(gone)[:len(b)] > 0
        runs = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        out.append((doc, len(b), int(hit.sum()), runs, sha(bytes(np.frombuffer(b, np.uint8)[~hit]))))
    return out


def tokens(docs, tokenizer, over=1024):
    return [(doc, len((t or "").encode()), n := len(tokenizer.encode(t or "", add_special_tokens=False).ids), n > over)
            for doc, t in docs]


def check_shards(docs, rows, shards=16):
    """Asserts the contract for (doc_id, size, crc, law, shard, slot, grown); the largest distance from the mean."""
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter(r[:3] for r in rows) == want
    slots, sizes = defaultdict(list), Counter()
    for _, size, _, law, shard, slot, grown in rows:
        assert law == "bytes" and grown is None and 0 <= shard < shards
        slots[shard].append(slot)
        sizes[shard] += size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(sizes.values()) / shards
    return max(abs(sizes[s] - mean) for s in range(shards))


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def url_rules(pages):
    """(page_id, host, path, rule, verdict or None where no rule fits)."""
    out = []
    for page, url in pages:
        host = path = ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
            host = lower(host)
        fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        out.append((page, host, path, best and best[1], best and best[2]))
    return out


def archive(pages, min_bytes=0):
    import base64
    first = {}
    for page, html in pages:
        b = (html or "").encode()
        first[b] = min(page, first.get(b, page))
    out = []
    for page, html in pages:
        b = (html or "").encode()
        own = len(b) < min_bytes or first[b] == page
        out.append((page, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if own else "revisit",
                    None if own else first[b]))
    return out


def quality_kept(docs, min_docs=200, spread=6):
    """docs: (id, text, lang, source) -> list of booleans, thresholds as the operator defines them."""
    rows = rules([(d, t) for d, t, _, _ in docs])
    lines = [sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in (t or "").split("\n")) for _, t, _, _ in docs]
    metrics = [(2, 1, 2000, True), (3, 1, 100, False), (4, None, 500, False), (5, 1, 450, False)]

    def value(k, m):
        bottom = lines[k] if m[1] is None else rows[k][m[1]]
        return 1000 * rows[k][m[0]] // bottom if bottom else 0

    def limits(members, m):
        buckets = Counter()
        for k in members:
            v = value(k, m)
            drop = max(0, len(bin(v)[2:]) - 10)
            buckets[v >> drop << drop] += 1
        at, upto = {}, 0
        for b in sorted(buckets):
            upto += buckets[b]
            for q in (5, 50, 95):
                if q not in at and 100 * upto >= q * len(members):
                    at[q] = b
        width = max(m[2], spread * min(at[50] - at[5], at[95] - at[50]))
        return at[50] - width if m[3] else -1, at[50] + width

    good = [k for k in range(len(docs)) if not rows[k][6]]
    members = defaultdict(list)
    for k in good:
        for key in ((docs[k][2], docs[k][3]), (docs[k][2],), ()):
            members[key].append(k)
    out = []
    for k in range(len(docs)):
        own = next((members[key] for key in ((docs[k][2], docs[k][3]), (docs[k][2],)) if len(members[key]) >= min_docs), members[()])
        out.append(k in set(good) and all(lo <= value(k, m) <= hi for m in metrics for lo, hi in [limits(own, m)]))
    return out


def drop_lines(docs, min_docs=10):
    key = lambda line: lower(re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line))
    where = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            where[key(line)].add(doc)
    return [(doc, "\n".join(x for x in text.split("\n") if not key(x) or len(where[key(x)]) < min_docs)) for doc, text in docs]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def earlier_windows(docs, length=50):
    """Words of windows that also start in a document with a smaller id go."""
    least = {}
    for doc, text in docs:
        w = words(text)
        for i in range(len(w) - length + 1 if doc is not None else 0):
            key = tuple(w[i:i + length])
            least[key] = min(doc, least.get(key, doc))
    out = []
    for doc, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - length + 1 if doc is not None else 0):
            if least[tuple(w[i:i + length])] < doc:
                gone.update(range(i, i + length))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc, len(w), len(gone), sha(" ".join(kept).encode())))
    return out


def word_runs(w, min_length=24, exponent=3):
    """(start, length, period) of all runs of a list."""
    _, w = np.unique(np.array(w, object), return_inverse=True)
    found = {}
    for q in range(1, len(w) // exponent + 1):
        same = np.concatenate([[0], (w[q:] == w[:-q]).astype(np.int8), [0]])
        for i, j in np.flatnonzero(np.diff(same)).reshape(-1, 2).tolist():
            if j - i + q >= max(min_length, exponent * q):
                found.setdefault((i, j + q), q)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_texts(docs):
    """The contract of ``op11``, for texts of moderate length."""
    from fractions import Fraction
    out = []
    for doc, text in docs:
        w = words(text)
        h = zlib.crc32(str(doc).encode())
        g = h // 10
        if doc is not None and h % 10 == 0 and w:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = word_runs(w)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None
        gone = {i for a, n, q in runs for i in range(a + q, a + n)}
        out.append((doc, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                    sha("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()),
                    sha(" ".join(x for i, x in enumerate(w) if i not in gone).encode())))
    return out


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of (doc_id, source, lang, n_chars, text) rows."""
    def h(*parts):
        return sha("".join(parts).encode())

    def leaf(row, more=0):
        row = [x if i != 3 or x is None else x + more for i, x in enumerate(row)]
        return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])

    def tree(nodes):
        """Levels of digests."""
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
        return levels

    def path(levels, i):
        """(sibling or None, whether it stands on the left) by level."""
        out = []
        for level in levels[:-1]:
            out.append((level[i ^ 1] if i ^ 1 < len(level) else None, i % 2 == 1))
            i //= 2
        return out

    def order(x):
        return (x is not None, x if not isinstance(x, str) else x.encode()) if x is not None else (False, b"")

    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)
    langs = sorted(by_lang, key=order)
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = tree([leaf(r) for r in by_lang[lang]])
    top = tree([trees[x][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, row in enumerate(by_lang[lang]):
            steps = path(trees[lang], i) + path(top, k)
            node = leaf(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0)
            for sibling, left in steps:
                node = h(node) if sibling is None else h(sibling, node) if left else h(node, sibling)
            out.append((row[0], trees[lang][0][i], trees[lang][-1][0], top[-1][0], h(*[s for s, _ in steps if s]), node,
                        node == top[-1][0]))
    return out
