"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(text)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components(docs, percent=75):
    """doc_id -> smallest id reachable by links, from all pairs."""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 4 * len(x) >= 3 * len(y) and 4 * len(y) >= 3 * len(x):
                common = len(x & y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
    return {d: (len(sets[d]), find(d)) for d in ids}


def personal(text):
    found = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        check = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and check % 10 == 0:
            found.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end(), "phone"))
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words, places, covered = WORD.findall(text), defaultdict(list), set()
    for i in range(len(words) - 2):
        places[tuple(words[i : i + 3])].append(i)
    for at in places.values():
        if len(at) > 1:
            covered.update(k for i in at for k in (i, i + 1, i + 2))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def without_boilerplate(docs, max_ratio, min_pages, same=lambda row: object()):
    """[(id, text, host)] without lines that too many of a host's pages have; rows that are the ``same`` are one page."""
    pages, seen = defaultdict(set), defaultdict(set)
    for k, (d, text, host) in enumerate(docs):
        page = same(d)
        pages[host].add(page)
        for line in (text or "").split("\n"):
            if WORD.search(line):
                seen[host, line].add(page)
    return [
        (d, text and "\n".join(
            line for line in text.split("\n")
            if len(seen[host, line]) < min_pages or len(seen[host, line]) <= max_ratio * len(pages[host])
        ), host)
        for d, text, host in docs
    ]


def check_pieces(pieces, ids_of, window=2048):
    """Pieces of packed documents: every id once, sequences full and without gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(ids_of)
    for d, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids_of[d])
            assert p["ids_crc32"] == crc(ids_of[d][at : at + p["length"]])
            at += p["length"]
        assert at == len(ids_of[d])
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, own in by_sequence.items():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == window or (s == len(by_sequence) - 1 and at < window)
    shares = [Counter() for _ in by_sequence]
    for p in pieces:
        shares[p["sequence_id"]][p["queue"]] += p["length"]
    return shares


def whitened(vectors, components=8):
    """(n, deviations, whitened up to signs, explained) of a list of vectors, by the whole covariance matrix."""
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[float(n * c - s) for c, s in zip(row, sums)] for row in x]) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    return n, deviations, centred @ directions[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def tree(digests):
    """The root of digests, and each one's (left, right) siblings from the lowest level up."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for d, k in enumerate(at):
            first = k // 16 * 16
            paths[d].append(("".join(digests[first:k]), "".join(digests[k + 1 : first + 16])))
        at = [k // 16 for k in at]
        digests = [sha("".join(digests[k : k + 16])) for k in range(0, len(digests), 16)]
    return digests[0] if digests else None, paths


def manifest(rows):
    """(leaf, subroot, root, path) of each of the rows (doc_id, source, lang, n_chars, text), in their order."""
    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaf(rows[k])))
    groups = defaultdict(list)
    for k in order:
        groups[rows[k][1]].append(k)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf(rows[k]) for k in groups[s]]) for s in names}
    root, over = tree([trees[s][0] for s in names])
    out = {}
    for s, above in zip(names, over):
        for k, path in zip(groups[s], trees[s][1]):
            out[k] = (leaf(rows[k]), trees[s][0], root, path + above)
    return [out[k] for k in range(len(rows))]


def targets(sizes, weights, share, most):
    """Targets of sources (in order): shares by weight, none above ``most`` times its size."""
    free, left, out = set(range(len(sizes))), share * sum(sizes), [0.0] * len(sizes)
    while free:
        level = left / sum(weights[k % len(weights)] for k in free)
        over = {k for k in free if most * sizes[k] < level * weights[k % len(weights)]}
        for k in over or free:
            out[k] = most * sizes[k] if over else level * weights[k % len(weights)]
        if not over:
            break
        left -= sum(out[k] for k in over)
        free -= over
    return out
