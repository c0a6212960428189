"""Plain versions of what the operators compute, for small tables."""

import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, width):
    words = WORD.findall(lower(text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def components(docs, width, numerator, denominator):
    """``doc_id -> (size, component)`` by comparing all pairs."""
    sets = {doc_id: shingles(text, width) for doc_id, text in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for place, a in enumerate(ids):
        for b in ids[place + 1 :]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small and small * denominator >= large * numerator:
                common = len(sets[a] & sets[b])
                if common * denominator >= numerator * (len(sets[a] | sets[b])):
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
    return {d: (len(sets[d]), find(d)) for d in sets}


def statistics(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {p for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for p in range(i, i + 8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)
