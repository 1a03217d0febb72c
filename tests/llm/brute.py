"""Plain Python versions of the operators, for small tables."""

import re
from collections import Counter
from math import log, sqrt

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = words(lowered)
    shingles = [" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, edges):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(x) for x in range(n)]


def near_groups(texts, radius=3):
    fps = [fingerprint(t) for t in texts]
    n = len(fps)
    return fps, components(n, [(i, j) for i in range(n) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= radius])


def without_repeats(texts, window=35):
    """(words, kept words) of each text."""
    split = [words(t) for t in texts]
    times = Counter(tuple(ws[i : i + window]) for ws in split for i in range(len(ws) - window + 1))
    out = []
    for ws in split:
        gone = np.zeros(len(ws), dtype=bool)
        for i in range(len(ws) - window + 1):
            if times[tuple(ws[i : i + window])] > 1:
                gone[i : i + window] = True
        out.append((ws, [w for w, g in zip(ws, gone) if not g]))
    return out


def base_rules(text):
    text = text or ""
    ws = words(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 3)}
    return {
        "n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "base_failed": len(ws) < 50 or 100 * len(covered) > 50 * len(ws),
    }


def bucket(*words, buckets):
    """XXH64, each word's hash the seed of the next one's, as a signed number modulo ``buckets``."""
    h = 42
    for word in words:
        h = xxhash.xxh64_intdigest(word.encode(), seed=h)
    return (h - (1 << 64) if h >> 63 else h) % buckets


def grams(text, buckets):
    ws = words(text)
    return [bucket(w, buckets=buckets) for w in ws] + [bucket(*pair, buckets=buckets) for pair in zip(ws, ws[1:])]


def log_ratios(rows, trusted, buckets=1 << 14, smoothing=20.0):
    """For each (id, text): the sum of the logarithms of target share over raw share of its n-grams, and their number."""
    per_row = [grams(text, buckets) for _, text in rows]
    raw, target = Counter(), Counter()
    for (id, _), found in zip(rows, per_row):
        raw.update(found)
        if id in trusted:
            target.update(found)
    scale = target.total() / raw.total()
    weight = {k: log(target[k] + smoothing) - log(n * scale + smoothing) for k, n in raw.items()}
    return [(sum(weight[k] for k in found), len(found)) for found in per_row]


def share(counts):
    _, labelled, good = counts
    return (good + 1) / (labelled + 2)


def total(counts):
    return tuple(map(sum, zip(*counts)))


def stands_out(counts, among, distance):
    middle = share(among)
    return abs(share(counts) - middle) > distance * sqrt(middle * (1 - middle) / (counts[1] + 2))


def branches(children, least_rows, distance):
    """The branch of each child of one node, from its (rows, labelled, good)."""
    if len(children) == 1:
        return {name: name for name in children}
    whole = total(children.values())
    out = {n for n, c in children.items() if c[0] >= least_rows and stands_out(c, whole, distance)}
    better = {n for n in out if share(children[n]) > share(whole)}
    chosen = dict.fromkeys(children, "*")
    for mark, side in (("*+", better), ("*-", out - better)):
        for name in side:
            own = len(side) == 1 or stands_out(children[name], total(children[n] for n in side), distance)
            chosen[name] = name if own else mark
    return chosen


def url_templates(pages, good, depth=8, least_rows=20, distance=2.0, strength=10.0):
    """For each (id, host, path): its template and the template's purity; ``good`` has the labelled ids."""
    def parts_of(path):
        return tuple(re.sub(r"[0-9a-fA-F-]{16,}|[0-9]+", "*", part) for part in path.split("/") if part)

    def counts(ids):
        return len(ids), sum(i in good for i in ids), sum(good.get(i, False) for i in ids)

    keys = [(host, parts_of(path)) for _, host, path in pages]
    at = {key: (key[0], "") for key in keys}
    members = {key: [] for key in keys}
    for (i, _, _), key in zip(pages, keys):
        members[key].append(i)
    for level in range(depth):
        nodes = {}
        for key, node in at.items():
            if len(key[1]) > level:
                nodes.setdefault(node, {}).setdefault(key[1][level], []).extend(members[key])
        chosen = {node: branches({n: counts(ids) for n, ids in c.items()}, least_rows, distance) for node, c in nodes.items()}
        for key, node in at.items():
            if len(key[1]) > level:
                at[key] = node[0], f"{node[1]}/{chosen[node][key[1][level]]}"
    template = {key: node[1] + "/**" * (len(key[1]) > depth) for key, node in at.items()}

    def smoothed(ids, towards):
        _, labelled, of_good = counts(ids)
        return (of_good + strength * towards) / (labelled + strength)

    _, labelled, of_good = counts([i for i, _, _ in pages])
    by_host, by_template = {}, {}
    for key, ids in members.items():
        by_host.setdefault(key[0], []).extend(ids)
        by_template.setdefault((key[0], template[key]), []).extend(ids)
    hosts = {host: smoothed(ids, of_good / labelled if labelled else 1.0) for host, ids in by_host.items()}
    purity = {node: smoothed(ids, hosts[node[0]]) for node, ids in by_template.items()}
    return [(template[key], purity[key[0], template[key]]) for key in keys]
