"""Plain versions of what the stages decide."""

import re


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_groups(rows, k):
    sets = []
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        sets.append((i, {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()))
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in root}


def brute_cut(rows, width=100):
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - width + 1):
            window = data[at : at + width]
            if window in seen:
                gone[at : at + width] = b"\1" * width
            seen.add(window)
        out[i] = bytes(b for b, g in zip(data, gone, strict=True) if not g)
    return out


def brute_hits(rows, items, width=13):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))

    windows = set()
    for _, text in items:
        w = words(text)
        size = min(width, len(w))
        windows |= {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if size else set()
    sizes = {len(w) for w in windows}
    for doc, text in rows:
        w, hit = words(text), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
        yield doc, len(w), len(hit)
