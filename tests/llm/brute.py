"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict


def components(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def shingles(text, k):
    w = (text or "").encode().lower().split()
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(zip(*(w[i:] for i in range(k))))


def near_duplicates(texts, k, percent=80):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    links = []
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    links.append((a, b))
    return components(sets, links), {i: len(s) for i, s in sets.items()}


def boilerplate(rows, ratio, least):
    """rows: (host, text); the lines that go, by host."""
    pages, counts = Counter(h for h, _ in rows), defaultdict(Counter)
    for host, text in rows:
        for line in {x.strip(" \t\n\x0b\x0c\r") for x in (text or "").split("\n")} - {""}:
            counts[host][line] += 1
    return {h: {x for x, n in c.items() if n >= least and n > ratio * pages[h]} for h, c in counts.items()}


def template(text, units):
    """For every word: its form with typed names, numbers and units, that without names, and the word itself."""
    s = re.sub(r"(?<=[0-9])[.,](?=[0-9])", "_", text or "")
    out = []
    for word in re.findall(r"\w+", s):
        low = word.lower()
        if re.fullmatch(r"[0-9][0-9_]*", low):
            kind = "<number>"
        elif low in units and out and out[-1][1] == "<number>":
            kind = "<unit>"
        else:
            kind = low
        named = kind == low and len(word) > 1 and word[0].isupper() and word[1].islower()
        out.append(("<name>" if named else kind, kind, low))
    return out


def contaminated(docs, items, units, window=8, least=4):
    """(document, item) -> (windows that count, those with equal values), by comparing all windows of both."""
    marks = {"<name>", "<number>", "<unit>"}

    def forms(words, floor):
        """(hashed form, slots by place, places of plain words, whether it may be asked) of a window, with its names as slots and as words."""
        for kind in {0, 1} if any(x[0] == "<name>" for x in words) else {0}:
            form = tuple(x[kind] for x in words)
            plain = [j for j, k in enumerate(form) if k not in marks]
            if len(plain) >= floor:
                yield form, {j: (form[j], words[j][2]) for j in range(len(words)) if j not in plain}, plain, True
            else:
                yield (form, tuple(x[2] for x in words)), {}, plain, "<name>" in form

    sizes, at = {}, defaultdict(list)
    for i, item in items.items():
        u = template(item, units)
        size = sizes[i] = min(window, len(u))
        for b in range(len(u) - size + 1 if size else 0):
            for form, slots, plain, may in forms(u[b : b + size], 1 if size == window else min(least, (size + 1) // 2)):
                if may or size == window:
                    at[size, form].append((i, b, slots, plain))
    found = {}
    for d, text in docs.items():
        t = template(text, units)
        shifts = defaultdict(list)
        for size in set(sizes.values()) - {0}:
            for a in range(len(t) - size + 1):
                for form, own, _, _ in forms(t[a : a + size], 1 if size == window else min(least, (size + 1) // 2)):
                    for i, b, slots, plain in at.get((size, form), ()):
                        shifts[i, a - b].append((a, slots == own, {(b + j, *slots[j], own[j][1]) for j in slots}, {b + j for j in plain}))
        for (i, _), wins in shifts.items():
            held = set().union(*(w[2] for w in wins))
            pairs = {(k, v, o) for _, k, v, o in held}
            consistent = len(pairs) == len({p[:2] for p in pairs}) == len({(p[0], p[2]) for p in pairs})
            evidence = len(set().union(*(w[3] for w in wins))) + len({j for j, _, v, o in held if v == o}) + len({j for j, k, _, _ in held if k == "<number>"}) / 2
            whole = consistent and evidence >= min(least, (sizes[i] + 1) // 2)
            exact = len({a for a, same, _, _ in wins if same})
            if whole or exact:
                n, e = found.get((d, i), (0, 0))
                found[d, i] = n + (len({w[0] for w in wins}) if whole else exact), e + exact
    return found


def repeated(texts, sentences, words, ends_sentence):
    """Word numbers covered by runs that are not the first of their kind."""
    places = defaultdict(list)
    for i in sorted(texts):
        w = texts[i].split()
        low = [x.lower() for x in w]
        stops = [k + 1 for k in range(len(w)) if k == len(w) - 1 or ends_sentence(w[k])]
        starts = [0, *stops[:-1]]
        for n, s in enumerate(starts):
            e = next((x for m, x in enumerate(stops) if m >= n + sentences - 1 and x - s >= words), None)
            if e is not None:
                places[tuple(low[s:e])].append((i, s, e))
    covered = defaultdict(set)
    for found in places.values():
        for i, s, e in sorted(found)[1:]:
            covered[i] |= set(range(s, e))
    return {i: v for i, v in covered.items() if v}
