"""Small corpora, and plain Python forms of what the operators compute."""

import random
import re

ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LINE = "This work is licensed under the GNU General Public License, version 3 or any later one, see the file of terms."
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(n=120, seed=1):
    """(doc_id, text) with copies, near copies, shared lines, blank, null, short and non-ASCII texts."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        text = " ".join(r.choice(words) for _ in range(r.choice([0, 1, 2, 3, 30, 60, 90])))
        if i % 5 == 4:
            text = r.choice([LINE, LINE[:70]]) + "\n" + text + r.choice(["", "\n" + LINE])
        if i % 7 == 3 and rows:
            text = r.choice(rows)[1]
        if i % 11 == 5 and rows:
            parts = (r.choice(rows)[1] or "").split(" ")
            parts[r.randrange(len(parts))] = r.choice(words)
            text = " ".join(parts)
        rows.append((i * 37 % 1009, None if i % 40 == 9 else text))
    return rows + [(5000, ""), (5001, " \n\t "), (5002, "z" * 3000), (5003, "ab cd " * 900), (5004, LINE.upper())]


def frame(spark, rows):
    """Documents with columns whose names clash with those that operators use inside."""
    whole = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    docs = spark.createDataFrame(whole, SCHEMA)
    for name in ("_id", "component_id", "kept", "score", "size", "start", "key", "spans", "shard"):
        docs = docs.selectExpr("*", f"'clash' as {name}")
    return docs.repartition(5)


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def near_components(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    label[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def repeats(rows, length=100):
    """doc_id -> removed runs and kept bytes."""
    seen, found = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(data[p : p + length])
        runs = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        found[i] = (runs, bytes(c for c, g in zip(data, gone) if not g))
    return found


def contamination(rows, items, window=13):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    split = lambda t: re.findall(pattern, (t or "").translate(ASCII_LOWER))
    windows = {}
    for item, text in items:
        w = split(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = {len(w) for w in windows}
    found = {}
    for i, text in rows:
        w = split(text)
        hit, having = set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
                    having |= windows[tuple(w[p : p + n])]
        found[i] = (len(w), len(hit), sorted(str(x) for x in having if x is not None))
    return found
