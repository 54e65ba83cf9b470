"""Every query against a plain version, over rows of every odd kind and over an empty table."""

from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import ROWS

from cratewise.llm import exact_dedup, licenses, mixing, packing, pii, quality, simhash, substrings, trigrams
from cratewise.llm.queries import QUERIES
from cratewise.llm.suffixes import suffix_array

TWO = [(i, t) for i, t, _ in ROWS]


def same(found, expected):
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, map(tuple, expected)))


def run(spark, folder, name, *columns):
    return QUERIES[name](spark, str(folder / "full")).select(*columns).collect()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_table(spark, folder, name):
    assert QUERIES[name](spark, str(folder / "empty")).count() == 0


def test_pii(spark, folder):
    found = run(spark, folder, "op1_pii", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    spans = [(i, brute.pii(t)) for i, t in TWO]
    kinds = ("email", "ip", "card", "phone")
    same(found, [(i, *[sum(s[0] == k for s in v) for k in kinds], brute.sha(brute.listed(v))) for i, v in spans])


def test_trees_and_thresholds_learn_a_shape():
    rng = np.random.default_rng(0)
    x = np.concatenate([np.zeros((3000, 1)), rng.integers(0, 20, (3000, 3))], axis=1).astype(float)
    y = (x[:, 1] > 9).astype(float)
    chosen = pii.Selector(x, y).chosen(x)[1]
    assert (chosen == (y == 1)).mean() > 0.99
    assert pii.Selector(x, np.zeros(3000)).trees is None


def test_licenses(spark):
    mit = "The MIT Licence\n\nCopyright (c) 2020 Somebody\n\n" + licenses.LICENSES["MIT"].split("\n", 2)[2].upper()
    rows = [(1, mit), (2, mit + " more"), (3, None), (4, licenses.LICENSES["Zlib"].replace("acknowledgment", "acknowledgement"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.scanned(docs, licenses.known_digests(spark)).select("doc_id", "license").collect()
    same(found, [(1, "MIT"), (2, None), (3, None), (4, "Zlib")])


def test_mixing(spark, folder):
    found = run(spark, folder, "op3_mixing", "doc_id", "size", "source_size", "target", "taken")
    source, sizes = {}, defaultdict(int)
    for i, t, s in ROWS:
        source[i] = s
        sizes[s] += len(brute.WORD.findall(t or ""))
    targets, taken = brute.targets(sizes), defaultdict(int)
    assert len(found) == len(ROWS)
    for row in found:
        s = source[row["doc_id"]]
        assert row["source_size"] == sizes[s] and row["target"] == pytest.approx(targets[s])
        assert 0 <= row["taken"] <= 2 * row["size"]
        taken[s] += row["taken"]
    assert all(abs(taken[s] - targets[s]) < 1 for s in targets)


def test_mix_is_in_training_order_and_cut_by_words(spark, folder):
    docs = spark.read.parquet(str(folder / "full" / "documents.parquet"))
    mix = mixing.training_mix(spark, docs)
    assert mix.columns == docs.columns
    words = mix.agg(F.sum(mixing.words_of())).first()[0]
    assert words == QUERIES["op3_mixing"](spark, str(folder / "full")).agg(F.sum("taken")).first()[0]


def test_exact_dedup(spark, folder):
    same(run(spark, folder, "op4_exact_dedup", "doc_id", "keep_id", "group_size", "text_sha256"), brute.duplicates(TWO))
    kept = run(spark, folder, "op4_exact_dedup", "kept")
    assert sum(r["kept"] for r in kept) == len({r[3] for r in brute.duplicates(TWO)})


def test_exact_dedup_keeps_state_between_batches(spark, folder):
    docs = spark.read.parquet(str(folder / "full" / "documents.parquet"))
    found = exact_dedup.exact_dedup(spark, docs, files_per_batch=1)
    same(found.select("doc_id", "keep_id", "group_size", "text_sha256").collect(), brute.duplicates(TWO))
    assert exact_dedup.keep_first_copies(spark, docs).columns == docs.columns


def test_imatch(spark, folder):
    found = run(spark, folder, "op5_imatch", "doc_id", "n_chars", "edited_sha256", "fingerprint", "near_edited", "near_next")
    plain = {}
    for i, n, text in brute.edited([r for r in dict(TWO).items() if r[0] is not None]):
        plain[i] = (n, brute.sha(text))
    texts, prints = dict(TWO), defaultdict(set)
    for row in found:
        prints[texts[row["doc_id"]] or ""].add(row["fingerprint"])
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        # Rows without an id, or that share one, and those before them, have no one successor.
        if row["doc_id"] not in (None, 1, 2, 3):
            assert (row["n_chars"], row["edited_sha256"]) == plain[row["doc_id"]]
    assert all(len(p) == 1 for p in prints.values())


def test_suffix_array():
    rng = np.random.default_rng(1)
    for _ in range(500):
        s = rng.integers(0, rng.integers(1, 5), rng.integers(0, 30))
        assert suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i, s=s: s[i:].tolist())


@pytest.mark.parametrize("many", [substrings.MANY, 0])
def test_substrings(spark, folder, many):
    docs = spark.read.parquet(str(folder / "full" / "documents.parquet"))
    found = substrings.without_repeats(docs, bucket_bytes=50_000, many=many)
    removed = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["high"] - r["low"])
    found = found.select("doc_id", "n_bytes", removed, F.size("runs"), F.sha2("kept", 256)).collect()
    same(found, [(i, *v) for i, rows in brute.removed(TWO).items() for v in rows])


def covered(data, doc, size):
    """For each string, which bytes a window covers that starts in an earlier document."""
    first = {}
    windows = [[t[i : i + size] for i in range(len(t) - size + 1)] for t in data]
    for d, some in zip(doc, windows, strict=True):
        for w in some:
            first[w] = min(first.get(w, d), d)
    return [{i + j for i, w in enumerate(some) if first[w] < d for j in range(size)} for d, some in zip(doc, windows, strict=True)]


def test_rounds_and_slices(monkeypatch):
    monkeypatch.setattr(substrings, "SLICE", 100)
    monkeypatch.setattr(substrings, "AT_ONCE", 2000)
    rng = np.random.default_rng(3)
    base = bytes(rng.choice(list(b"ab cd"), 400).tolist())
    for _ in range(3):
        cuts = rng.integers(0, 300, 150).tolist()
        data = [base[a : a + 60 + a % 89] if i % 3 else b"a" * (50 + a % 150) for i, a in enumerate(cuts)]
        doc = np.sort(rng.integers(0, 60, 150))
        for found in (substrings.settled_in_rounds(data, doc, 50), substrings.settled_names(np.zeros(150, np.int64), doc, data, 50)):
            got = [set() for _ in data]
            for n, a, b in found:
                got[n].update(range(a, b))
            assert got == covered(data, doc.tolist(), 50)
    hasher, text = substrings.Hasher(), rng.bytes(1000)
    sums, at = hasher.sums(np.frombuffer(text, np.uint8)), np.arange(3, 851)
    names = hasher.of(sums, at, at + 50).astype(np.int64).tolist()
    assert list(substrings.windows_of(hasher, text, 3, 900, 50)) == list(zip(names, at.tolist(), strict=True))


def test_quality_separates_and_never_sees_labels(spark, tmp_path):
    rows = [(i, "All of the words in this plain line are ordinary ones. " * (1 + i % 5) if i % 2 else "JUNK!! ### $$$ " * (3 + i % 7), i % 2) for i in range(200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int"))
    found = quality.scored(docs, model).collect()
    assert all(r["_predicted"] == r["doc_id"] % 2 for r in found)


def test_quality_of_every_row(spark, folder):
    found = run(spark, folder, "op7_quality", "doc_id", "held_out", "score", "predicted")
    assert len(found) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)


def test_simhash(spark, folder):
    same(run(spark, folder, "op8_simhash", "doc_id", "fingerprint", "component_id"), brute.components(TWO))


@pytest.mark.parametrize("segments", [2, 3, 5])
def test_links_miss_no_pair(spark, segments):
    rng = np.random.default_rng(2)
    base = [int(x) for x in rng.integers(-(2**62), 2**62, 20)]
    fps = {b ^ sum(1 << int(p) for p in set(rng.integers(0, 63, rng.integers(0, 6)))) for b in base for _ in range(8)}
    found = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), segments=segments).collect()
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4
    assert {tuple(r) for r in found} == {(a, b) for a in fps for b in fps if a < b and near(a, b)}


def test_packing(spark, folder):
    found = QUERIES["op9_packing"](spark, str(folder / "full")).collect()
    same([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found], brute.token_pieces(TWO))
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert len(bins) == -(-sum(r["length"] for r in found) // packing.CAPACITY)


def test_bin_completion_beats_best_fit():
    # Best fit takes the three 3s apart: 6+3, 6+3, 4+3+... in four bins of ten; three are enough.
    counts = {6: 2, 4: 2, 5: 2}
    packing_found = packing.pack(counts, 10)
    assert sum(times for _, times in packing_found) == 3
    used = defaultdict(int)
    for filling, times in packing_found:
        assert sum(filling) <= 10
        for k in filling:
            used[k] += times
    assert used == counts


def test_secrets(spark, folder):
    found = run(spark, folder, "op10_secrets", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    kinds = ("assign", "access", "hex")
    spans = [(i, brute.secrets(t)) for i, t in TWO]
    same(found, [(i, *[sum(s[0] == k for s in v) for k in kinds], brute.sha(brute.listed(v))) for i, v in spans])


def test_trigram_queries():
    assert trigrams.query("AKIA[A-Z]+") == frozenset({frozenset({"aki", "kia"})})
    assert trigrams.query("(abcd|xyz)[0-9]") is not None
    assert trigrams.query("[0-9a-f]{24,}") is None and trigrams.query("(ab|xyz)") is None
    assert trigrams.query("ab?cd") == frozenset({frozenset({"abc", "bcd"}), frozenset({"acd"})})
