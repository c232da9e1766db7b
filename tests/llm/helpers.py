"""Small inputs with every awkward case, and plain models."""

import collections
import re

LONG = "very long word " * 4000
BASE_TEXT = "the quick brown fox jumps over the lazy dog and runs far away into the deep dark forest where nobody lives at all today"
PASSAGE = " ".join(f"shared{i} passage{i * 7} words{i * 13}" for i in range(30))


def documents(spark):
    """Null and empty texts, copies, near copies, repeated rows, a null id, shared passages, and clashing columns."""
    near = BASE_TEXT.replace("lazy", "sleepy")
    rows = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two"), (6, "One TWO"), (7, BASE_TEXT), (8, BASE_TEXT),
        (9, BASE_TEXT.upper()), (10, near), (11, near + " x"), (12, "a " + PASSAGE + " b"), (13, PASSAGE[5:]), (14, "é" * 150),
        (15, "é" * 99), (16, LONG), (16, LONG), (17, "🙂 " * 300), (18, "tail " + PASSAGE + " tail"), (19, "x" * 450), (None, "no id at all"),
        (None, BASE_TEXT), (20, "mail ann@x.org or +1 555 123 4567, 10.0.0.1 and 4111 1111 1111 1111"), (21, "one"),
    ]
    clash = ["id", "body", "spans", "key", "score", "family", "rank", "name", "component_id"]
    frame = spark.createDataFrame([(i, t, *["clash"] * len(clash)) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{c} string" for c in clash))
    return frame, rows


def shingles(text, size):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def groups(rows, size, percent):
    """{row number: smallest id of its component} by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[find(i)].append(doc)
    return [min((d for d in ids[find(i)] if d is not None), default=None) for i in range(len(rows))], [len(s) for s in sets]


def without_repeats(texts, length):
    """What is left of each text's bytes, and how many went."""
    bodies = [(t or "").encode() for t in texts]
    count = collections.Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append((bytes(c for c, g in zip(b, gone) if not g), sum(gone)))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)
