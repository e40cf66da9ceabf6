"""Plain single-process versions that the operators are held against."""

import hashlib
import re


def line_dedup(docs, min_words):
    """doc_id -> (text, removed lines, emptied), by trying every run of lines; docs are (doc_id, text) in order of place."""
    sequences = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        sequences.append([(i, line, len(re.findall(r"[^\x20\x09-\x0D]+", line))) for i, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line)])
    seen, gone = {}, [set() for _ in docs]
    for d, seq in enumerate(sequences):
        for start in range(len(seq)):
            words = 0
            for stop in range(start, len(seq)):
                words += seq[stop][2]
                if words >= min_words:
                    content = tuple(line for _, line, _ in seq[start : stop + 1])
                    if seen.setdefault(content, (d, start)) != (d, start):
                        gone[d].update(i for i, _, _ in seq[start : stop + 1])
    result = {}
    for d, (doc_id, text) in enumerate(docs):
        if not gone[d]:
            result[doc_id] = (text, 0, False)
            continue
        rest = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone[d])
        bare = not re.search(r"[^\x20\x09-\x0D]", rest)
        result[doc_id] = ("" if bare else rest, len(gone[d]), bare)
    return result


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def groups(ids, linked):
    """id -> smallest id reachable, `linked` deciding on each pair."""
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = list(ids)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            if linked(a, b):
                i, j = root(a), root(b)
                parent[max(i, j)] = min(i, j)
    return {i: root(i) for i in ids}


def near_duplicates(docs, percent=85):
    """doc_id -> component over all pairs; docs as doc_id -> text."""
    sets = {i: shingle_set(t) for i, t in docs.items()}

    def linked(a, b):
        common = len(sets[a] & sets[b])
        return bool(sets[a] and sets[b]) and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common)

    return groups(sorted(docs), linked)


def base_spans(text):
    kinds = (
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18),
        ("hex", re.compile("[0-9a-f]+"), 0, 16),
    )
    found = [(m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(kinds) for m in p.finditer(text or "") if len(m[g]) >= n]
    return [(kinds[k][0], start, end) for start, k, end in sorted(found)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
