"""Spans that the scans add to the base kinds, and texts of very many matches."""

import random
import re
import time

import brute
import numpy as np
from rows import ROWS

from cratewise.llm import pii, secrets
from cratewise.llm.queries import QUERIES

KEYS = "ghp_" + "aB3" * 12 + " x AIza" + "Q_-4567" * 5 + " xoxb-1234567890-abc https://user:pass@host eyJabcdefgh.eyJabcdefgh.sig -----BEGIN RSA PRIVATE KEY-----"


def every_secret(text):
    """All spans of all rules by start, then rule."""
    found = [(a, ("assign", "access", "hex").index(k), b, k) for k, a, b in brute.secrets(text)]
    for n, rule in enumerate(secrets.MORE, 3):
        found += [(*(m.start(), n, m.end()), rule.kind) for m in re.finditer(rule.expression, text or "")]
    return brute.listed([(k, a, b) for a, _, b, k in sorted(found)])


def test_all_spans_of_the_secret_scan(spark, tmp_path):
    many = " ".join(f"{i * 7919:024x}" + (" é \U0001f600 token=abcdefg" if i % 3 == 0 else "") for i in range(10_000))
    sizes = [" ".join(f"{i:030x}" for i in range(n)) for n in (1, 63, 64, 65, 128, 129)]
    rows = [(n, t) for n, t in enumerate([many, KEYS, "é" + KEYS * 30, None, "", *sizes, *[t for _, t, _ in ROWS]])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op10_secrets"](spark, str(tmp_path)).select("doc_id", "spans").collect()
    assert dict(map(tuple, found)) == {n: every_secret(t) for n, t in rows}


def plain_added(base, found, chance, above):
    taken, out = [(a, b) for _, a, b in base], []
    for i in sorted(np.flatnonzero(above), key=lambda i: (-chance[i], found[i])):
        number, a, b = found[i]
        if all(b <= c or d <= a for c, d in taken):
            taken.append((a, b))
            out.append((pii.GENERATORS[number][0], a, b))
    return out


def test_added_spans_touch_nothing():
    rng = np.random.default_rng(4)
    for _ in range(200):
        starts = rng.integers(0, 300, 40)
        found = [(int(rng.integers(0, 4)), int(a), int(a + rng.integers(1, 20))) for a in starts]
        base = [("ip", int(a), int(a + 5)) for a in rng.integers(0, 300, 6)]
        chance, above = rng.random(40).round(1), rng.random(40) < 0.7
        assert pii.added("x" * 330, base, found, chance, above) == plain_added(base, found, chance, above)
    many = [(1, 10 * i, 10 * i + 8) for i in range(100_000)]
    start = time.time()
    assert len(pii.added("x" * 1_000_000, [], many, np.ones(100_000), np.ones(100_000, bool))) == 100_000
    assert time.time() - start < 10


def account(rnd, valid):
    body = "".join(rnd.choice("0123456789") for _ in range(18))
    check = 98 - int("".join(str(int(c, 36)) for c in body + "DE00")) % 97
    return f"DE{check if valid else (check + 1) % 97:02d}{body}"


def test_account_numbers_are_learned_from_their_check_digits(spark):
    assert pii.account_checks("GB82 WEST 1234 5698 7654 32") and not pii.account_checks("GB83 WEST 1234 5698 7654 32")
    rnd = random.Random(5)
    texts = [f"Please pay to account IBAN {account(rnd, True)} soon" if i % 2 else f"Spare part {account(rnd, False)} of the pump" for i in range(1200)]
    # Common kinds fill the sample by hash; the few with an account number are drawn by their shape.
    rows = [(i, t) for i, t in enumerate(texts)] + [(i, f"write to user{i}@mail.example.com or {i % 256}.1.2.3") for i in range(2000, 12_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    selector = pii.fitted(docs, documents=500)
    found = pii.found_spans(docs.filter("doc_id < 1200"), selector).collect()
    hit = {r["doc_id"]: [s for s in r["added"] if s["kind"] == "account"] for r in found}
    good, wrong = sum(bool(hit[i]) for i in range(1, 1200, 2)), sum(bool(hit[i]) for i in range(0, 1200, 2))
    assert good >= 570 and wrong <= 30
    assert all(texts[i][s["start"] : s["end"]].startswith("DE") for i, spans in hit.items() for s in spans)
