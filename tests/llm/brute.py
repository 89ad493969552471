"""Plain Python versions of what the operators compute."""

import random
from itertools import combinations

LONG = " ".join(f"word{i % 9973}" for i in range(60_000))


def documents(n=300, seed=3):
    """(doc_id, text): groups of exact and near copies, chains of them, shared lines, short and empty texts."""
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    shared = [" ".join(pick.choices(words, k=12)) for _ in range(6)]
    out, bases = [], []
    for i in range(n):
        kind = pick.random()
        if kind < 0.3 or not bases:
            text = pick.choices(words, k=pick.choice([3, 8, 60, 150, 300]))
            bases.append(text)
        elif kind < 0.4:
            text = pick.choice(bases)
        else:
            text = list(pick.choice(bases))
            for _ in range(max(1, int(len(text) * pick.choice([0.005, 0.01, 0.015, 0.02, 0.03])))):
                text[pick.randrange(len(text))] = pick.choice(words)
            if kind > 0.8:
                bases.append(text)
        lines = [" ".join(text[j : j + 20]) for j in range(0, len(text), 20)]
        if pick.random() < 0.4:
            lines.insert(pick.randrange(len(lines) + 1), pick.choice(shared))
        out.append((i * 7 % 1009, "\n".join(lines)))
    return out + [(2001, ""), (2002, None), (2003, " \t"), (2004, "one"), (2005, "ONE")]


def blank_split(text):
    return [w for w in (text or "").translate(dict.fromkeys(b"\t\n\x0b\x0c\r", " ")).split(" ") if w]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text):
    found = [lower(w) for w in blank_split(text)]
    if not found:
        return set()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))}


def near_components(rows, percent=85):
    """doc_id -> smallest doc_id reachable."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in combinations(sets, 2):
        both = len(sets[x] & sets[y])
        if both and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
            a, b = find(x), find(y)
            root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def without_common_lines(rows):
    """doc_id -> (lines before, lines kept)."""
    strip = " \t\n\x0b\x0c\r"
    keep, holders = {}, {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = lower(line.strip(strip))
            if len(key) >= 20:
                holders.setdefault(key, set()).add(i)
    for i, text in rows:
        lines = (text or "").split("\n")
        rest = []
        for line in lines:
            held = holders.get(lower(line.strip(strip)), ())
            if len(held) < 3 or max(held) == i:
                rest.append(line)
        keep[i] = len(lines), rest
    return keep
