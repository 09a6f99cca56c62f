"""Plain restatements of the operators, for small tables: (doc_id, text) rows in, one tuple for each row out."""

import hashlib
import re
from collections import Counter

import xxhash

_LATE = float("inf")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def fingerprint(text: str) -> int:
    w = words(ascii_lower(text))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(rows):
    """doc_id, fingerprint, component_id."""
    prints = [fingerprint(t or "") for _, t in rows]
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[find(p)] = min(least.get(find(p), i), i)
    return [(i, f"{p:016x}", least.get(find(p))) for (i, _), p in zip(rows, prints)]


def _order(rows):
    """Rows by doc_id, null last; rows that repeat doc_id and text share a place in the order."""
    return sorted(set(rows), key=lambda r: (_LATE if r[0] is None else r[0], xxhash.xxh64_intdigest(r[1] or "")))


def phrases(rows, window=13):
    """doc_id, n_words, n_removed, kept_sha256; without null doc_ids."""
    first = {}
    for i, t in _order(rows):
        w = words(t or "")
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k:k + window]), i)
    out = []
    for i, t in rows:
        w = words(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def substrings(rows, window=100):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; without null doc_ids."""
    first = {}
    for i, t in _order(rows):
        b = (t or "").encode()
        for k in range(len(b) - window + 1):
            first[b[k:k + window]] = min(first.get(b[k:k + window], (i, k)), (i, k))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if first[b[k:k + window]] < (i, k):
                gone[k:k + window] = b"\1" * window
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def exact(rows):
    """doc_id, keep_id, group_size, text_sha256."""
    texts = [ascii_lower(t or "") for _, t in rows]
    size, keep = Counter(texts), {}
    for (i, _), t in zip(rows, texts):
        if i is not None:
            keep[t] = max(keep.get(t, i), i)
    return [(i, keep.get(t), size[t], sha(t)) for (i, _), t in zip(rows, texts)]


_SECRETS = (
    ("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", r"(AKIA[A-Z0-9]+)"), ("hex", r"([0-9a-f]+)"))


def secrets(rows):
    """doc_id, n_assign, n_access, n_hex, base_sha256."""
    out = []
    for i, t in rows:
        spans = []
        for number, ((kind, pattern), least) in enumerate(zip(_SECRETS, (6, 20, 24))):
            flags = re.I | re.A if kind == "assign" else 0
            spans += [(m.start(), number, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, t or "", flags)
                      if len(m[1]) >= least]
        counts = Counter(n for _, n, _ in spans)
        out.append((i, counts[0], counts[1], counts[2], sha(",".join(s for _, _, s in sorted(spans)))))
    return out
