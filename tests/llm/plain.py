"""Plain versions of rules, for tests."""

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def groups(texts):
    """A number per text: equal for those that links connect; empty sets are alone."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)) and \
                    100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(texts))], sets


def one_of_each_group(rows):
    """Rows (doc_id, text, ...) that stay: of a group that of the smallest id; rows without words all stay."""
    number, sets = groups([r[1] for r in rows])
    best, out = {}, []
    for r, g, s in zip(rows, number, sets):
        if not s:
            out.append(r)
        elif g not in best or (r[0] is None, r[0] or 0) < (best[g][0] is None, best[g][0] or 0):
            best[g] = r
    return out + list(best.values())


def contaminated(text, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))

    own = " " + " ".join(words(text)) + " "
    for _, t in items:
        w = words(t)
        n = min(10, len(w))
        if n and any(" " + " ".join(w[s:s + n]) + " " in own for s in range(len(w) - n + 1)):
            return True
    return False


def base_spans(text):
    return re.findall(r"@[A-Za-z0-9-]+\.|[0-9]\.[0-9]|[0-9][ -]?[0-9]{3}|\+[0-9]", text)
