"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash
import zstandard


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def near_duplicates(docs, width=3, share=(90, 100)):
    """docs: [(doc_id, text)], ids unique."""
    sets = {}
    for doc_id, text in docs:
        w = words(ascii_lower(text))
        sets[doc_id] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and share[1] * len(sets[a] & sets[b]) >= share[0] * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def deleted_lines(docs, min_words):
    """docs: [(doc_id, text)], ids unique; by comparing every two places."""
    places = []
    for doc_id, text in sorted(docs):
        seq = [(k, line) for k, line in enumerate(text.split("\n")) if words(line)] if text else []
        places.append((doc_id, seq))
    flat = [(d, j) for d, (_, seq) in enumerate(places) for j in range(len(seq))]
    gone = defaultdict(set)
    for x, (d, j) in enumerate(flat):
        best = 0
        for e, i in flat[:x]:
            n = 0
            while j + n < len(places[d][1]) and i + n < len(places[e][1]) and places[d][1][j + n][1] == places[e][1][i + n][1]:
                n += 1
            best = max(best, n)
        run = places[d][1][j : j + best]
        if sum(len(words(line)) for _, line in run) >= min_words and run:
            gone[places[d][0]] |= {k for k, _ in run}
    return {d: sorted(lines) for d, lines in gone.items()}


def hits(docs, items, width=10):
    pattern = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    norm = lambda t: re.findall(pattern, ascii_lower(t))
    windows = defaultdict(set)
    for item, text in items:
        w = norm(text)
        if w and item is not None:
            size = min(width, len(w))
            for k in range(len(w) - size + 1):
                windows[tuple(w[k : k + size])].add(str(item))
    found = []
    for doc_id, text in docs:
        w = norm(text)
        hit, names = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (own := windows.get(tuple(w[k : k + size]))) is not None:
                    hit |= set(range(k, k + size))
                    names |= own
        found.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return found


def without_hits(text, items, width=10, most_share=0.5):
    """The text without what lies in a window of an item, or None if that is most of it."""
    found = list(re.finditer("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(text)))
    w, hit = [m.group() for m in found], set()
    for _, item in items:
        own = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(item))
        size = min(width, len(own))
        windows = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if size else set()
        for k in range(len(w) - size + 1):
            if tuple(w[k : k + size]) in windows:
                hit |= set(range(k, k + size))
    if len(hit) > most_share * len(w):
        return None
    out, at = "", 0
    for k in sorted(hit):
        if k - 1 not in hit:
            out += text[at : found[k].start()]
        if k + 1 not in hit:
            at = found[k].end()
            at += len(text[at:]) - len(text[at:].lstrip(" \t"))
    return out + text[at:]


def good_text(text):
    """The quality rules with their production parameters."""
    n, _, _, _, repeated = base_counts(text)
    raw = (text or "").encode()
    press = zstandard.ZstdCompressor(level=3, write_content_size=False).compress
    bands = [(200, 0.9, 2.4), (400, 1.0, 2.8), (1_000, 1.1, 3.2), (2_500, 1.2, 3.8), (10_000, 1.3, 5.0)]
    low, high = next(((a, b) for start, a, b in reversed(bands) if len(raw) >= start), (0, math.inf))
    if n < 20 or 100 * repeated > 30 * n or not low <= len(raw) / len(press(raw)) <= high:
        return False
    chunks = [raw[min(k, len(raw) - 4096) :][:4096] for k in range(0, len(raw), 4096)] if len(raw) >= 4096 else []
    return 2 * sum(not 1.15 <= len(c) / len(press(c)) <= 4.5 for c in chunks) <= len(chunks)


def base_counts(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    repeated = {j for k in range(len(w) - 7) if grams[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
    lines = [line for line in text.split("\n") if words(line)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (2 if k % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def personal(text):
    text = text or ""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def transaction_log(records, per_epoch=64):
    """records: [(seq, stream, op, key, value)] in order; (changes {seq: (fate, by)}, states [(n, total)], store)."""
    open_, fates, store, states, commits = defaultdict(lambda: ([], [])), {}, {}, [], 0
    shown = lambda: (len(store), sum(v or 0 for v in store.values()))
    for seq, stream, op, key, value in records:
        pending, marks = open_[stream]
        if op == "change":
            pending.append((seq, key, value))
        elif op == "savepoint":
            marks.append(len(pending))
        elif op == "rollback":
            start = marks.pop() if marks else 0
            fates |= {s: ("rollback", seq) for s, *_ in pending[start:]}
            del pending[start:]
        else:
            fates |= {s: (op, seq) for s, *_ in pending}
            if op == "commit":
                for _, k, v in pending:
                    store.pop(k, None)
                    if v is not None:
                        store[k] = v
                commits += 1
                if commits % per_epoch == 0:
                    states.append(shown())
            del open_[stream]
    for pending, _ in open_.values():
        fates |= {s: ("abort", None) for s, *_ in pending}
    return fates, states + [shown()] * (commits % per_epoch > 0), store


def document_records(docs, labels):
    """docs: [(doc_id, text, source)], labels: {doc_id: toxic}."""
    out = []
    for doc_id, text, source in sorted(docs, key=lambda d: d[0]):
        h = zlib.crc32(str(doc_id).encode())
        op = ["commit"] * 2 + ["abort"] + ["savepoint"] * 2 + ["rollback"] * 2
        kind, key = h % 17, h // 100 % 30000
        gone = text is None or labels.get(doc_id) == 1
        out.append((doc_id, source, op[kind] if kind < 7 else "change", key, None if gone else zlib.crc32(f"{key}:{text}".encode())))
    return out


def fingerprint(text, width=3):
    w = words(ascii_lower(text))
    grams = [" ".join(w[k : k + width]) for k in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64)) if hashes else 0


def close_fingerprints(prints, radius=2):
    """prints: [(id, int)]; {(place): least id reachable}."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for k, (name, _) in enumerate(prints):
        least[find(k)] = min(least.get(find(k), name), name)
    return [least[find(k)] for k in range(len(prints))]


def digest_of(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def document_leaf(row):
    return digest_of(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def merkle(rows):
    """rows: [(doc_id, source, lang, n_chars, text)] -> [(doc_id, leaf, subroot, root, proof, folded, verified)]."""

    def tree(nodes):
        """The root, and each node's run and slot, level by level."""
        ways, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            runs = [nodes[k : k + 2] for k in range(0, len(nodes), 2)]
            for k, p in enumerate(at):
                ways[k].append((runs[p // 2], p % 2))
            at, nodes = [p // 2 for p in at], [digest_of(*r) for r in runs]
        return nodes[0], ways

    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append(r)
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for v in langs:
        by_lang[v].sort(key=lambda r: (r[0] is not None, r[0] or 0, document_leaf(r)))
        trees[v] = tree([document_leaf(r) for r in by_lang[v]])
    root, tops = tree([trees[v][0] for v in langs])
    out = []
    for v, top in zip(langs, tops, strict=True):
        for r, way in zip(by_lang[v], trees[v][1], strict=True):
            way = way + top
            wrong = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            acc = document_leaf((*r[:3], r[3] + 1, r[4]) if wrong else r)
            for run, slot in way:
                acc = digest_of(*(acc if k == slot else h for k, h in enumerate(run)))
            out.append((r[0], document_leaf(r), trees[v][0], root, digest_of(*(h for run, slot in way for k, h in enumerate(run) if k != slot)), acc, acc == root))
    return out
