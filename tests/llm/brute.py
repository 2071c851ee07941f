"""Plain versions of the operators, document by document, for small tables."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text: str | None, size: int) -> set[tuple[str, ...]]:
    words = WORD.findall((text or "").translate(LOW))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def jaccard_components(rows: list[tuple], size: int, percent: int) -> list[tuple]:
    """(doc_id, set size, component) of rows (doc_id, text); a null id takes its component's."""
    sets = [shingle_set(text, size) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            shared = len(x & sets[j])
            if x and sets[j] and 100 * shared >= percent * (len(x) + len(sets[j]) - shared):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), least.get(find(i))) for i, (doc_id, _) in enumerate(rows)]


def contained_items(docs: list[tuple], items: list[tuple]) -> set[tuple]:
    """(doc_id, item_id, shared, item size) at a containment of 80 % of five-word shingles."""
    cut = lambda text: {s for s in shingle_set((text or "").lower(), 5) if len(s) == 5}
    out = set()
    for doc_id, text in docs:
        own = cut(text)
        for item_id, item in items:
            wanted = cut(item)
            shared = len(own & wanted)
            if wanted and 100 * shared >= 80 * len(wanted):
                out.add((doc_id, item_id, shared, len(wanted)))
    return out


def base_counts(text: str | None) -> tuple:
    words = WORD.findall(text or "")
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered), failed


def without_repeats(rows: list[tuple], window: int = 50) -> list[tuple]:
    """(doc_id, bytes, removed, spans, sha256 of the rest); a null id is greater than all."""
    key = lambda i: float("inf") if i is None else i
    first: dict[bytes, float] = {}
    for doc_id, text in sorted(rows, key=lambda r: key(r[0])):
        data = (text or "").encode()
        for k in range(len(data) - window + 1):
            first.setdefault(data[k : k + window], key(doc_id))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for k in range(len(data) - window + 1):
            if first[data[k : k + window]] < key(doc_id):
                gone[k : k + window] = [True] * window
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def payload_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()
