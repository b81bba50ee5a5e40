"""Plain versions that the tests hold the operators against."""

import collections
import re


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def plain_components(rows, n, num):
    sets = {}
    for key, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets[key] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}
    parent = {k: k for k in sets}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a in sets:
        for b in sets:
            i = len(sets[a] & sets[b])
            if a < b and i and 100 * i >= num * (len(sets[a]) + len(sets[b]) - i):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in sets}
