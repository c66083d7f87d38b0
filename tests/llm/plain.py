"""Plain, brute-force versions of what the operators compute."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def components(rows):
    """[(doc_id, text)] -> [(doc_id, set size, component)] by all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                up[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        known = [d for d in (least.get(r), doc) if d is not None]
        least[r] = min(known) if known else None
    return [(doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)]


def word_lines(text):
    """(line number, line, words) of each line with words."""
    return [(k, s, len(WORD.findall(s))) for k, x in enumerate((text or "").split("\n"))
            if (s := x.strip(" \t\n\r\x0b\x0c"))]


def line_windows(text, min_words):
    """{(first line, last line)}: as few lines as hold the words, from each line on and back."""
    lines, out = word_lines(text), set()
    for i in range(len(lines)):
        on = [e for e in range(i, len(lines)) if sum(n for *_, n in lines[i:e + 1]) >= min_words]
        back = [b for b in range(i + 1) if sum(n for *_, n in lines[b:i + 1]) >= min_words]
        out |= {(lines[i][0], lines[on[0]][0])} if on else set()
        out |= {(lines[back[-1]][0], lines[i][0])} if back else set()
    return out


def dedup_lines(rows, min_words):
    """{(doc_id, text): text left}. Each line is set against every earlier equal one; such
    pairs that follow each other in both places are a run. First places are by (doc_id, line)."""
    rows = sorted(set(rows), key=lambda r: (r[0] is not None, r[0]))
    places, at, out = {}, 0, {}
    for doc, text in rows:
        lines, gone, going = word_lines(text), set(), {}
        for i in range(len(lines) + 1):
            met = places.get(lines[i][1], []) if i < len(lines) else []
            now = {p: going.get(p - 1, i) for p in met}
            for p, first in going.items():
                if p + 1 not in now and sum(n for *_, n in lines[first:i]) >= min_words:
                    gone.update(range(lines[first][0], lines[i - 1][0] + 1))
            going = now
            if i < len(lines):
                places.setdefault(lines[i][1], []).append(at)
            at += 1  # one more behind a document: no run goes on into the next
        out[doc, text] = text if not gone else "\n".join(
            x for k, x in enumerate(text.split("\n")) if k not in gone)
    return out


def top_k(rows, is_query, k):
    """[(id, vector)] -> sorted [(query, rank, id, score)]; every row counts, those of one query
    id are ranked together."""
    out = []
    for q in {i for i, _ in rows if is_query(i)}:
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i)
                        for of, x in rows if of == q
                        for i, y in rows if i != q and len(y) == len(x))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def ids_of(text, tokenizer):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def edited(rows):
    """[(doc_id, text)] in descending order -> edited texts."""
    out = []
    for k, (_, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1] or ""
        t = t or ""
        cut = len(t) // 3
        out.append(t[:len(t) - cut] + nxt[:cut])
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check_packing(pieces, capacity):
    """Pieces as dicts: no gaps, nothing too long, all of a document in order."""
    by_sequence, by_doc = {}, {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        by_doc.setdefault(p["doc_id"], []).append((p["piece"], p["start"], p["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return Counter(len(v) for v in by_sequence.values())


def poisson_copies(rows, seed=42, alpha=0.5):
    """[(doc_id, source)] -> number of copies of each row, by the inverse distribution."""
    n = Counter(s for _, s in rows)
    total = sum(k ** alpha for k in n.values())
    rate = {s: k ** alpha / total * len(rows) / k for s, k in n.items()}
    out = []
    for doc, source in rows:
        parts = max(1, math.ceil(rate[source] / 16))
        mean, copies = rate[source] / parts, 0
        for j in range(1, parts + 1):
            text = f"{seed}:{'' if doc is None else doc}:{j}"
            u = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2 ** 52
            p = cdf = math.exp(-mean)
            k = 0
            while cdf <= u and k < 95:
                k += 1
                p *= mean / k
                cdf += p
                copies += 1
        out.append(copies)
    return out


# ---------------------------------------------------------------- language

def letter_vector(code, dimensions):
    """+1 and -1 by the bits of mixed 64-bit words, one word at a time."""
    out, mask = [], (1 << 64) - 1
    for word in range(1, dimensions // 64 + 1):
        x = (code * (dimensions // 64) + word) * 0x9E3779B97F4A7C15 & mask
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
        x ^= x >> 31
        for byte in x.to_bytes(8, "little"):
            out += [1 if byte >> (7 - bit) & 1 else -1 for bit in range(8)]
    return out


def trigram_profile(text, dimensions):
    """Sum over all letters of the bound vectors of the letter and its neighbours."""
    codes = [ord(c) if c.isalpha() else 0 for c in text.lower()]
    known = {c: np.array(letter_vector(c, dimensions)) for c in {0, *codes}}
    out = np.zeros(dimensions)
    for k, code in enumerate(codes):
        if code:
            before, behind = codes[k - 1] if k else 0, codes[k + 1] if k + 1 < len(codes) else 0
            out += np.roll(known[before], 2) * np.roll(known[code], 1) * known[behind]
    return out


def languages(rows, dimensions):
    """rows: (doc_id, lang, text) -> [(doc_id as text, held out, language, score)]."""
    held = [d is None or zlib.crc32(str(d).encode()) % 5 == 0 for d, _, _ in rows]
    found = [trigram_profile(t or "", dimensions) for _, _, t in rows]
    names = sorted({g for (_, g, _), h in zip(rows, held, strict=True) if g and not h})
    sums = [sum(f for f, (_, g, _), h in zip(found, rows, held, strict=True) if g == name and not h)
            for name in names]
    unit = [s / np.linalg.norm(s) for s in sums]
    mean = sum(unit) / len(unit)
    out = []
    for (d, _, _), h, f in zip(rows, held, found, strict=True):
        if not f.any():
            out.append((str(d), h, "und", 0.0))
            continue
        f = f / np.linalg.norm(f)
        near = [round(float((f - mean) @ (u - mean)) / max(float(np.linalg.norm(u - mean)), 1e-30), 9)
                for u in unit]
        best = near.index(max(near))
        out.append((str(d), h, names[best], min(1.0, max(0.0, float(f @ unit[best])))))
    return out
