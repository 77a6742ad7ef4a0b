"""Plain Python versions of what the operators compute, for small inputs."""

import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def overlap(text, items, window=10):
    """(n_words, n_hit, sorted items) of one text against [(item, text)]."""
    w = words(text)
    hit, found = set(), set()
    for item, other in items:
        o = words(other)
        n = min(window, len(o))
        if not n:
            continue
        wanted = {tuple(o[s : s + n]) for s in range(len(o) - n + 1)}
        for s in range(len(w) - n + 1):
            if tuple(w[s : s + n]) in wanted:
                hit.update(range(s, s + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)
