"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import defaultdict

SPACE = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return SPACE.findall(text or "")


def components(links, nodes):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}


def shingles(text, size):
    own = words(lower(text))
    if len(own) < size:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}


def near_duplicates(docs, size=4, percent=80):
    sets = {i: shingles(t, size) for i, t in docs}
    having = defaultdict(list)
    for i, own in sets.items():
        for s in own:
            having[s].append(i)
    common = defaultdict(int)
    for ids in having.values():
        for x, a in enumerate(ids):
            for b in ids[:x]:
                common[min(a, b), max(a, b)] += 1
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    found = components(links, sets)
    return {i: (len(sets[i]), found[i], found[i] == i) for i in sets}


def rule_statistics(text):
    own = words(text)
    windows = defaultdict(list)
    for i in range(len(own) - 4):
        windows[tuple(own[i : i + 5])].append(i)
    repeated = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if SPACE.search(line):
            dup += line in seen
            seen.add(line)
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated)


_TOKEN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contamination(docs, items, n=13):
    item_words = [(name, _TOKEN.findall(lower(t))) for name, t in items]
    windows = defaultdict(set)
    for name, own in item_words:
        size = min(n, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows[tuple(own[i : i + size])].add(name)
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in docs:
        own = _TOKEN.findall(lower(text))
        hit, found = set(), set()
        for size in sizes:
            for j in range(len(own) - size + 1):
                if tuple(own[j : j + size]) in windows:
                    hit |= set(range(j, j + size))
                    found |= windows[tuple(own[j : j + size])]
        names = sorted(str(f) for f in found)
        out[i] = (len(own), len(hit), len(names), sha(",".join(names)), bool(hit) and 20 * len(hit) >= len(own))
    return out


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def repeated_bytes(docs, length=100):
    seen, out = set(), {}
    for i, text in sorted(docs, key=lambda d: d[0]):
        own = (text or "").encode()
        covered = bytearray(len(own))
        for p in range(len(own) - length + 1):
            part = own[p : p + length]
            if part in seen:
                covered[p : p + length] = b"\1" * length
            seen.add(part)
        runs = sum(covered[k] and (k == 0 or not covered[k - 1]) for k in range(len(own)))
        out[i] = (len(own), sum(covered), int(runs), sha(bytes(x for x, c in zip(own, covered, strict=True) if not c)))
    return out


_LETTERS = re.compile("[A-Za-z\u00c0-\u00ff]+")


def variants(docs, dropped=199):
    counts = defaultdict(int)
    for i, text in docs:
        for run in _LETTERS.findall(text or ""):
            word = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if dropped and h % dropped == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return group_variants({w: n for w, n in counts.items() if len(w) >= 6 and n >= 5})


def group_variants(counts):
    letters = {c for w in counts for c in w}
    forms, out = {}, {}
    for word, n in counts.items():
        edits = {word[:i] + word[i + 1 :] for i in range(len(word))}
        edits |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
        edits |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
        near = sorted((edits - {word}) & counts.keys(), key=lambda w: (-counts[w], w))
        form = near[0] if near and counts[near[0]] >= 5 * n else None
        forms[word] = form
        out[word] = [form, None, n, len(near), counts[form] if form else None]
    for word, row in out.items():
        root = word
        while forms[root]:
            root = forms[root]
        row[1] = root
    return {w: tuple(r) for w, r in out.items()}


def merkle(rows, fan_out=16):
    """Rows of (doc_id, source, lang, n_chars, text) to sorted rows of the audit."""

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tree(leaves):
        """Root, and for each leaf its siblings (left, right) at each level."""
        steps = [[] for _ in leaves]
        nodes, below = list(leaves), [[i] for i in range(len(leaves))]
        while len(nodes) > 1:
            higher, wider = [], []
            for a in range(0, len(nodes), fan_out):
                run = nodes[a : a + fan_out]
                for j in range(len(run)):
                    for i in below[a + j]:
                        steps[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
                higher.append(sha("".join(run)))
                wider.append([i for own in below[a : a + fan_out] for i in own])
            nodes, below = higher, wider
        return nodes[0], steps

    first = lambda v: (v is not None, v if v is not None else 0)
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (own := sorted(groups[s], key=lambda r: (first(r[0]), leaf(r))), *tree([leaf(r) for r in own])) for s in names}
    if not names:
        return []
    root, above = tree([trees[s][1] for s in names])
    out = []
    for s, higher in zip(names, above, strict=True):
        own, subroot, steps = trees[s]
        for row, step in zip(own, steps, strict=True):
            path = step + higher
            node = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                node = (*row[:4], lower(row[4]))
            node = leaf(node)
            for left, right in path:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in path))
            out.append((row[0], leaf(row), subroot, root, proof, node, node == root))
    return out
