"""Plain Python versions of the contracts, one text at a time."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = words(text)
    n = len(w)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    times = Counter(tuple(w[i : i + 5]) for i in range(n - 4))
    covered = set()
    for i in range(n - 4):
        if times[tuple(w[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def secrets(text):
    """n_assign, n_access, n_hex, base_sha256, base spans."""
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    spans = [f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found)]
    n = Counter(kind for *_, kind in found)
    return n["assign"], n["access"], n["hex"], hashlib.sha256(",".join(spans).encode()).hexdigest(), spans


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


def licenses(text):
    """n_words, n_base, first_word, last_word, base_labels."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def shingles(text, size):
    w = [x.translate(LOWER) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def components(texts, size, percent=80):
    """Smallest reachable id of every id of ``texts`` (id -> text), over all pairs that can be similar."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    seen = set()
    for ids in holders.values():
        for a in ids:
            for b in ids:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    common = len(sets[a] & sets[b])
                    if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                        x, y = root(a), root(b)
                        label[max(x, y)] = min(x, y)
    return {i: root(i) for i in texts}
