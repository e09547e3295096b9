"""The definitions, spelled out over plain Python lists for small inputs.

Posts are tuples (id, type, owner, parent, accepted).
"""

from __future__ import annotations

from collections import Counter, defaultdict


def closed(posts):
    return {p[0]: p[4] for p in posts if p[1] == 1 and p[4]}


def weights(posts):
    accepted, result = closed(posts), Counter()
    for pid, kind, owner, parent, _ in posts:
        if kind == 1:
            result[pid, owner] += 4
        elif kind == 2:
            result[parent, owner] += 3 if accepted.get(parent) == pid else 2
    return result


def links(posts):
    people, result = defaultdict(dict), Counter()
    for (q, u), w in weights(posts).items():
        people[q][u] = w
    for members in people.values():
        for u, wu in members.items():
            for v, wv in members.items():
                if u != v:
                    result[u, v] += wu + wv
    return result


def bags(posts):
    result = defaultdict(list)
    for pid, kind, owner, parent, _ in posts:
        if kind in (1, 2):
            result[owner].append(pid if kind == 1 else parent)
    return result


def lists(posts):
    """user -> [(question, neighbour, weight)] in list order; linked users only."""
    accepted, bag, result = closed(posts), bags(posts), {}
    for (u, v), w in links(posts).items():
        found = result.setdefault(u, [])
        found += [(q, v, w) for q in bag[v] if q not in accepted]
    return {u: sorted(f, key=lambda e: (-e[2], e[0], e[1])) for u, f in result.items()}
