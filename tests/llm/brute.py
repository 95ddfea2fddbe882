"""Plain versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def substring_bytes(docs, size=400):
    """docs: (doc_id, text) rows; result per row in order."""
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(x[i : i + size] for x in texts for i in range(len(x) - size + 1))
    out = []
    for (doc, _), x in zip(docs, texts):
        gone = [False] * len(x)
        reach = 0
        for i in range(len(x) - size + 1):
            if seen[x[i : i + size]] > 1:
                for j in range(max(i, reach), i + size):
                    gone[j] = True
                reach = i + size
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        kept = bytes(b for b, g in zip(x, gone) if not g)
        out.append((doc, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def substring_words(docs, size=50):
    words = [WORDS.findall(t or "") for _, t in docs]
    lowest = {}
    for (doc, _), w in zip(docs, words):
        for i in range(len(w) - size + 1):
            k = tuple(w[i : i + size])
            if doc is not None:
                lowest[k] = min(lowest.get(k, doc), doc)
    out = []
    for (doc, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - size + 1):
            k = tuple(w[i : i + size])
            if doc is not None and lowest[k] < doc:
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def near(docs, words=3, percent=85):
    sets = []
    for _, t in docs:
        w = WORDS.findall(ascii_lower(t))
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and None not in (docs[i][0], docs[j][0]):
                n = len(a & sets[j])
                if 100 * n >= percent * (len(a) + len(sets[j]) - n):
                    x, y = root(docs[i][0]), root(docs[j][0])
                    parent[max(x, y)] = min(x, y)
    return [
        (d, len(s), None if d is None else root(d), d is None or root(d) == d) for (d, _), s in zip(docs, sets)
    ]


def quality_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    repeat = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dups += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(repeat),
    )


def token_rows(docs, tokenizer, end_id):
    out, start = [], 0
    for doc, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((doc, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out
