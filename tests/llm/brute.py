"""Plain re-computations of the operators, for small inputs."""
import hashlib
import re
from itertools import combinations

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NONBLANK = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def windows(words, width):
    return [tuple(words[i: i + width]) for i in range(max(1, len(words) - width + 1))] if words else []


def contamination(text, items, width=10):
    """(n_words, n_hit, n_items, sha) of one text; items are (id, text)."""
    words = ALNUM.findall(fold(text))
    hit, found = set(), set()
    for item, body in items:
        for w in set(windows(ALNUM.findall(fold(body)), width)):
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i: i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found.add("null" if item is None else str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def shingles(text, k):
    words = NONBLANK.findall(fold(text))
    return {tuple(words[i: i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def groups(texts, k, percent):
    """{id: smallest id reachable} for {id: text}."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                a, b = sorted((find(a), find(b)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in texts}


def best_fit(sizes, sources, clusters, capacity):
    bins, out = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        fits = [(b[0], i) for i, b in enumerate(bins) if b[0] >= size and (source is None or source not in b[1])
                and (cluster is None or cluster not in b[2])]
        if not fits:
            bins.append([capacity, set(), set()])
        i = min(fits)[1] if fits else len(bins) - 1
        out.append((i, capacity - bins[i][0]))
        bins[i][0] -= size
        bins[i][1].add(source)
        bins[i][2].add(cluster)
    return out
