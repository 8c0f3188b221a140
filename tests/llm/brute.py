"""Plain versions of what the corpus operators compute, for small fixtures."""

from __future__ import annotations

import hashlib
import math
import re

def thue_morse(length, letters="ab"):
    """A word and its complement: polynomial hashes modulo 2 ** 64 take the long ones for the same word."""
    ones = [bin(i).count("1") % 2 for i in range(length)]
    return "".join(letters[b] for b in ones), "".join(letters[1 - b] for b in ones)


UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: null, empty, blank, tiny and repeated texts, characters of one to four bytes, a text of one letter, a very long one
ODD_TEXTS = [None, "", " ", "\n\t ", "a", "É", "漢字 and 𝄞", "same text here", "same text here", "x" * 700, "word " * 30_000,
             "it's we'll I'Mx 12 3.5!? \u00a0 end", "'s 's", "\x00 nul \x00", "tab\tand  two  spaces \n"]


def odd_docs(spark):
    """Odd texts with a null id, a repeated row, and extra columns whose names the operators use inside."""
    rows = [(i, t, "en", None if i % 3 else "h.example.org", i, "x") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[7], (None, "no id at all", "fr", "h", 0, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long, id string")


def no_docs(spark):
    return odd_docs(spark).where("false")


def components(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in pairs:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def jaccard_components(docs: dict, width=3, percent=90):
    sets = {i: shingle_set(t, width) for i, t in docs.items()}
    ids = sorted(i for i, s in sets.items() if s)
    links = []
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    links.append((a, b))
    return {i: len(s) for i, s in sets.items()}, components(links, docs)


def removed(docs: dict, length=100):
    """id -> list of booleans: bytes covered by a string of that length that starts earlier."""
    seen, out = set(), {}
    for i in sorted(docs):
        text = (docs[i] or "").encode()
        mask = [False] * len(text)
        for p in range(len(text) - length + 1):
            window = text[p:p + length]
            if window in seen:
                mask[p:p + length] = [True] * length
            seen.add(window)
        out[i] = text, mask
    return out


def removal_row(text: bytes, mask: list[bool]):
    runs = sum(m and not before for m, before in zip(mask, [False, *mask]))
    kept = bytes(b for b, m in zip(text, mask) if not m)
    return len(text), sum(mask), runs, hashlib.sha256(kept).hexdigest()


def base_secrets(text):
    text = text or ""
    assign = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def entropy(window: str) -> float:
    return -sum(c / len(window) * math.log2(c / len(window)) for c in map(window.count, set(window)))
