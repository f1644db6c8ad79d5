"""Groups of near duplicates by comparing all pairs."""

import itertools


def plain_groups(rows, percent):
    """Smallest id of each row's group, by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            root[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    return [(rows[i][0], len(sets[i]), min((d for d in groups[find(i)] if d is not None), default=None)) for i in range(len(rows))]
