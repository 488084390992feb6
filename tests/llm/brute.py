"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

from collections import defaultdict


def shingle_set(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def jaccard_classes(rows: list[tuple], threshold: float = 0.8) -> list[tuple]:
    """(id, class_id, n_links, n_linked_texts, n_copies) for each (id, text)."""
    sets = [shingle_set(t) for _, t in rows]
    where = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            where[x].add(i)
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    links = [0] * len(rows)
    others = [set() for _ in rows]
    copies = [1] * len(rows)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in where[x]:
                common[j] += 1
        for j, c in common.items():
            if j != i and c / (len(s) + len(sets[j]) - c) >= threshold:
                links[i] += 1
                if rows[i][1] == rows[j][1]:
                    copies[i] += 1
                else:
                    others[i].add(rows[j][1])
                label[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        ids[root(i)].append(k)
    return [(k, min((x for x in ids[root(i)] if x is not None), default=None), links[i], len(others[i]), copies[i]) for i, (k, _) in enumerate(rows)]
