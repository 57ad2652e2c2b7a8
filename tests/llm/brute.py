"""Brute-force versions of the operators, for small tables."""

import hashlib
import re


def near_duplicates(rows, width=5, percent=80):
    """{doc_id: (set size, component)} by comparing all pairs."""
    sets = {}
    for doc, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        sets[doc] = {tuple(words[i: i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[:i]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if 100 * small >= percent * large and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def remove_repeats(rows, window=50):
    """{doc_id: (words, removed, sha256)} with every window looked up in one dictionary."""
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i: i + window]), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i: i + window])] < d:
                gone[i: i + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out[d] = (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def tokens(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def overlaps(docs, items, overlap=12, least=5):
    """{(doc_id, item_id)} that agree along some alignment in a window of ``overlap`` tokens but for a sixth."""
    out = set()
    for d, text in docs:
        a = tokens(text)
        for i, item in items:
            b = tokens(item)
            width = min(len(b), overlap)
            if len(b) < least:
                continue
            for shift in range(-len(b) + 1, len(a)):
                same = [a[shift + k] == b[k] for k in range(max(0, -shift), min(len(b), len(a) - shift))]
                if any(sum(same[k: k + width]) >= width - width // 6 for k in range(len(same) - width + 1)):
                    out.add((d, i))
                    break
    return out


def personal_data(text):
    """Base spans straight from the patterns."""
    digits = lambda m: re.sub("[^0-9]", "", m)

    def luhn(s):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(s))) % 10 == 0
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)]
    return [(k, m.start(), m.end()) for k, p, ok in kinds for m in re.finditer(p, text or "") if ok(m[0])]
