import re
from collections import Counter

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, row string"


def docs_table(spark, rows):
    """(doc_id, text[, source]) rows with columns whose names clash with common ones."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None, "x", "y") for r in rows]
    return spark.createDataFrame(full, DOCS)


def word_list(text):
    return [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]


def shingle_list(text):
    w = word_list(text)
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def shingle_set(text):
    w = word_list(text)
    return frozenset(shingle_list(text)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_classes(rows):
    """(class, links) of each row of (doc_id, text), all pairs compared."""
    n = len(rows)
    sets = [shingle_set(t) for _, t in rows]
    root, links = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i + 1, n):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            both = len(sets[i] & sets[j])
            if same or both and both >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(rows):
        r = find(i)
        keys = [k for k in (least.get(r), key) if k is not None]
        least[r] = min(keys) if keys else None
    return [(key, least[find(i)], links[i]) for i, (key, _) in enumerate(rows)]


def brute_leaks(rows, items):
    """(doc_id, item, start, similarity), all windows of the size of an item compared."""
    out = {}
    for key, text in rows:
        mine = shingle_list(text)
        known = set(mine)
        for item, passage in items:
            b = Counter(shingle_list(passage))
            n = sum(b.values())
            if not known & set(b):
                continue
            for start in range(len(mine)):
                window = mine[start : start + n]
                if sum(x in b for x in window) < 0.8 * n:  # too few for any similarity of 0.8
                    continue
                both = sum((Counter(window) & b).values())
                similarity = both / (len(window) + n - both)
                if similarity >= 0.8:
                    best = out.get((key, item), (0, 0))
                    out[key, item] = max(best, (similarity, -start))
    return {(k, i, -s, round(x, 9)) for (k, i), (x, s) in out.items()}
