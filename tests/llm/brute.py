"""Plain, slow versions of what the operators compute, to hold results against."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d)
        if i % 2:
            v = v * 2
            v = v - 9 if v > 9 else v
        total += v
    return total % 10 == 0


def pii(text):
    text = text or ""
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def secrets(text):
    text, spans = text or "", []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            spans.append((m.start(), 0, m.end(), "assign"))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            spans.append((m.start(), 1, m.end(), "access"))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 24:
            spans.append((m.start(), 2, m.end(), "hex"))
    return [(kind, a, b) for a, _, b, kind in sorted(spans)]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def targets(sizes):
    """sizes: source to size, of all sources."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, total = {}, 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in target]
        left = total - sum(target.values())
        if not open_:
            return target
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = [s for s in open_ if share[s] >= 2 * sizes[s]]
        if not above:
            return target | share
        target |= {s: 2.0 * sizes[s] for s in above}


def duplicates(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), sha(text)) for i in ids]
    return out


def edited(rows):
    """(doc_id, n_chars, edited text); ids are distinct."""
    rows = sorted(((i, t or "") for i, t in rows), reverse=True)
    out = []
    for k, (doc_id, text) in enumerate(rows):
        following, third = rows[(k + 1) % len(rows)][1], len(text) // 3
        out.append((doc_id, len(text), text[: len(text) - third] + following[:third]))
    return out


def removed(rows, size=50):
    """doc_id: (n_bytes, n_removed, n_spans, sha of what is left)."""
    seen, out = set(), {}
    by_id = defaultdict(list)
    for doc_id, text in rows:
        by_id[doc_id].append((text or "").encode())
    for doc_id in sorted(by_id, key=lambda i: (i is None, i)):
        fresh = set()
        for data in by_id[doc_id]:
            windows = [data[i : i + size] for i in range(len(data) - size + 1)]
            gone = np.zeros(len(data), bool)
            for i, w in enumerate(windows):
                if w in seen:
                    gone[i : i + size] = True
            runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
            left = bytes(np.frombuffer(data, np.uint8)[~gone])
            out.setdefault(doc_id, []).append((len(data), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
            fresh |= set(windows)
        if doc_id is not None:
            seen |= fresh
    return out


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components(rows):
    """doc_id to (fingerprint, component) over all pairs."""
    fps = [(i, fingerprint(t)) for i, t in rows]
    parent = {f: f for _, f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    distinct = list(parent)
    for k, a in enumerate(distinct):
        for b in distinct[:k]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    least = {}
    for i, f in fps:
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return [(i, f"{f:016x}", least.get(root(f))) for i, f in fps]


def token_pieces(rows, capacity=2048):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for number, start in enumerate(range(0, len(ids), capacity)):
            cut = ids[start : start + capacity]
            out.append((doc_id, number, start, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    return out


def search(rows, items, k=10):
    """(item_id, rank, doc_id, score); equal scores by doc_id, rows without an id last."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(lower))
    docs = [(i, Counter(terms(t))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    holders = Counter(t for _, c in docs for t in c)
    length, out = sum(sum(c.values()) for _, c in docs), []
    for item_id, text in sorted(set(items), key=repr):
        scores = []
        for doc_id, counts in docs:
            m = 25 + (75 * sum(counts.values()) * len(docs)) // length
            score = 0
            for t in terms(text):
                if tf := counts[t]:
                    w = math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * holders[t] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        out += [(item_id, n, doc_id, -s) for n, (s, _, doc_id) in enumerate(sorted(scores, key=lambda r: (r[0], r[1], r[2] or 0))[:k], 1)]
    return out


def failed(text):
    words = WORD.findall(text)
    found = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words)}
    found["C"] = 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)
    found["D"] = any(c in "#$%&*|" for c in text)
    return {k for k, v in found.items() if v}


def audit(rows, good, toxic):
    """rows: (doc_id, text, part). Every order is run over every document."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    fails = [(p, failed(t or "") | ({"E"} if i is not None and i > first[t or ""] else set()), i) for i, t, p in rows]
    out, shares = [], Counter()
    for part in {p for _, _, p in rows}:
        own = [(f, i) for p, f, i in fails if p == part]
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone, kept = [d for d in left if name in d[0]], [d for d in left if name not in d[0]]
                every = sum(name in f for f, _ in own)
                counts = len(kept), len(gone), every - len(gone), sum(f == {name} for f, _ in own)
                out.append((part, "".join(order), step, *counts, sum(i in good for _, i in gone), sum(i in toxic for _, i in gone)))
                shares[part, name] += len(gone)
                left = kept
    return [(*r, shares[r[0], r[1][r[2] - 1]]) for r in out]
