"""Plain single-process versions of the operators, for small inputs."""

import hashlib
import re

import xxhash

BLANK = " \t\n\x0b\x0c\r"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def line_dedup(rows, min_chars=40, min_docs=5):
    key = lambda line: line.strip(BLANK).translate(LOWER)
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or doc == max(holders[key(x)])]
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def fingerprint(text):
    words = WORDS.findall((text or "").translate(LOWER))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(rows, radius=2):
    fps = [fingerprint(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, f"{fps[i]:016x}", least.get(find(i))) for i, (doc, _) in enumerate(rows)]


def substring_dedup(rows, window=35):
    seen, words = {}, [WORDS.findall(text or "") for _, text in rows]
    for w in words:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            seen[k] = seen.get(k, 0) + 1
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out
