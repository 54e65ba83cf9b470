"""Removal of long byte strings that also start in an earlier document.

1. Every window of ``size`` bytes is named after the smallest hash among its grams
   of ``gram`` bytes; neighbouring windows of one name form a fragment, and equal
   windows have equal names wherever they stand. Fragments are dealt out by name.
2. Of equal fragments, all but those of the earliest document go. A name whose
   fragments differ is looked at in bytes: its fragments are cut out of the texts.
3. There, windows that no other document can have are dropped by hash, and a
   suffix array of what is left, built by linear grouping, puts equal windows
   next to each other: all but those of the earliest document go.
4. The covered bytes of each document are removed.

A batch of documents settles its own equal fragments before anything is dealt out,
so a passage that a third of all documents share arrives once per batch. A name
with very many different fragments is dealt out again by single windows, of which
a batch settles the equal ones too. Long texts are hashed in slices of SLICE windows,
and a name too large for one suffix array is settled in rounds: what a round finds
covered by earlier documents leaves, the rest meets again.

Equal fragments are told by one 64-bit figure of name and rolling hash, windows by
their bytes. Cases: null and empty texts have no windows; rows with one doc_id don't
remove from each other; a null doc_id is later than all others; rows that repeat
are treated alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.llm.common import file_backed, located, saved, text_of
from cratewise.llm.suffixes import equal_runs, suffix_array

SIZE, GRAM = 50, 20
#: Bytes of text to a bucket of fragments, different fragments of a name from which on single
#: windows are dealt out, and symbols to one suffix array (a bucket's share, never cutting a name).
BUCKET_BYTES, MANY, AT_ONCE = 4_000_000, 500, 1 << 16
#: Windows of a long text that are hashed at once, and windows or fragments handed on at once.
SLICE, HAND_ON = 1 << 18, 20_000
#: Bytes of text that are hashed and settled together in a task (one text at least).
BATCH_BYTES = 4_000_000
LAST = np.iinfo(np.int64).max
#: An odd base of the rolling hash and its inverse modulo 2**64, and a mixer's multipliers.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
#: What is known of a fragment, one array each.
FIELDS = (("name", "u8"), ("hash", "u8"), ("doc", "i8"), ("file", "i8"), ("row", "i8"), ("low", "i8"), ("high", "i8"))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(MIX[0])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX[1])
    return h ^ (h >> np.uint64(31))


class Hasher:
    """Hashes of all substrings of a text from one running sum."""

    def __init__(self):
        self.powers = self.inverses = np.ones(1, np.uint64)

    def reach(self, size: int) -> None:
        if len(self.powers) >= size:
            return
        for name, base in (("powers", BASE), ("inverses", INVERSE)):
            table = np.full(2 * size, base, np.uint64)
            table[0] = 1
            setattr(self, name, np.multiply.accumulate(table))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self.reach(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mixed((sums[high] - sums[low]) * self.inverses[low])


def least_of(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    span = 1
    out = h
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def fragments(hasher: Hasher, data: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, hash, first byte, end) of a text's fragments."""
    sums = hasher.sums(data)
    grams = mixed((sums[gram:] - sums[:-gram]) * hasher.inverses[: len(data) - gram + 1])
    names = least_of(grams, size - gram + 1)
    low = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    high = np.append(low[1:], len(names)) - 1 + size
    return names[low], hasher.of(sums, low, high), low, high


def joined_runs(doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges put together where they touch; sorted by ``doc`` (any row number), then ``low``."""
    if not len(doc):
        return doc, low, high
    order = np.lexsort((low, doc))
    doc, low, high = doc[order], low[order], high[order]
    reach = np.maximum.accumulate(high + doc * (1 << 40)) - doc * (1 << 40)
    fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (low[1:] > reach[:-1])])
    starts = np.flatnonzero(fresh)
    ends = np.append(starts[1:], len(doc)) - 1
    return doc[starts], low[starts], reach[ends]


def earliest(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the smallest ``doc`` among those of equal key, and whether it is the first such entry."""
    order = np.lexsort((doc, key))
    fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]]) if len(key) else np.zeros(0, bool)
    low, first = np.empty(len(key), np.int64), np.zeros(len(key), bool)
    low[order] = doc[order][np.flatnonzero(fresh)][np.cumsum(fresh) - 1] if len(key) else 0
    first[order[fresh]] = True
    return low, first


def marks_of(file, row, low, high) -> pd.DataFrame:
    return pd.DataFrame({"file": file, "row": row, "low": low, "high": high})


def rows_with_bytes(docs: DataFrame) -> DataFrame:
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST)))
    rows = located(docs.select("doc_id", "text"))
    return rows.select("doc_id", place.alias("doc"), F.col("_file").alias("file"), F.col("_row").alias("row"), F.encode(text_of(), "UTF-8").alias("data"))


def slices(parts: Iterator[pd.DataFrame], most: int, size: int) -> Iterator[tuple[list[np.ndarray], list[bytes], np.ndarray]]:
    """Batches of about ``most`` bytes: (doc, file, row) arrays, slices of texts, and where in its text each begins.

    Slices of a text share ``size`` - 1 bytes, so that every window is in just one.
    """
    for part in parts:
        columns = [part[c].to_numpy(np.int64) for c in ("doc", "file", "row")]
        at, data, begins, held = [], [], [], 0
        for number, text in enumerate(part["data"]):
            for begin in range(0, len(text) - size + 1, SLICE):
                piece = text[begin : begin + SLICE + size - 1]
                at.append(number)
                data.append(piece)
                begins.append(begin)
                held += len(piece)
                if held >= most:
                    yield [c[at] for c in columns], data, np.array(begins)
                    at, data, begins, held = [], [], [], 0
        if at:
            yield [c[at] for c in columns], data, np.array(begins)


def dealt_fragments(rows: DataFrame, buckets: int, size: int, gram: int) -> DataFrame:
    """(bucket, entries): packed arrays of fragments by bucket of name, or of settled ranges in buckets by row."""

    def of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for (doc, file, row), pieces, begins in slices(parts, BATCH_BYTES, size):
            found = []
            for number, data in enumerate(pieces):
                name, digest, low, high = fragments(hasher, np.frombuffer(data, np.uint8), size, gram)
                begin = begins[number]
                found.append((name, digest, np.full(len(name), number), low + begin, high + begin))
            name, digest, number, low, high = (np.concatenate(x) for x in zip(*found, strict=True))
            del found
            least, _ = earliest(name ^ digest * np.uint64(BASE), doc[number])
            # Later copies within the batch are settled here.
            gone = doc[number] > least
            n, a, b = joined_runs(number[gone], low[gone], high[gone])
            settled = (np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64), doc[n], file[n], row[n], a, b)
            kept = np.flatnonzero(~gone)
            n = number[kept]
            claims = (name[kept], digest[kept], doc[n], file[n], row[n], low[kept], high[kept])
            bucket = np.concatenate([claims[0] % np.uint64(buckets), mixed(settled[4].astype(np.uint64)) % np.uint64(buckets)]).astype(np.int64)
            table = [np.concatenate([c, s]) for c, s in zip(claims, settled, strict=True)]
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            table = [t[order].astype(kind) for t, (_, kind) in zip(table, FIELDS, strict=True)]
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            ends = np.append(cuts[1:], len(bucket))
            entries = [b"".join(t[a:b].tobytes() for t in table) for a, b in zip(cuts, ends, strict=True)]
            yield pd.DataFrame({"bucket": bucket[cuts], "entries": entries})

    return rows.drop("doc_id").mapInPandas(of, "bucket long, entries binary")


def unpacked(blobs: list[bytes]) -> list[np.ndarray]:
    """The arrays of FIELDS out of packed entries."""
    counts = [len(b) // (8 * len(FIELDS)) for b in blobs]
    return [
        np.concatenate([np.frombuffer(b, kind, n, 8 * n * i) for b, n in zip(blobs, counts, strict=True)])
        for i, (_, kind) in enumerate(FIELDS)
    ]


def compared(dealt: DataFrame, many: int) -> DataFrame:
    """Ranges that go (name null) and fragments to be looked at in bytes: file, row, doc, low, high, name, wide."""
    schema = "file long, row long, doc long, low long, high long, name long, wide boolean"

    def of(key, part: pd.DataFrame) -> pd.DataFrame:
        name, digest, doc, file, row, low, high = unpacked(list(part["entries"]))
        settled = (name == 0) & (digest == 0)
        # A name that came once has nothing to be compared with.
        order = np.argsort(name, kind="stable")
        fresh = np.concatenate([[True], name[order][1:] != name[order][:-1]])
        group = np.empty(len(name), np.int64)
        group[order] = np.cumsum(fresh) - 1
        open_ = np.flatnonzero((np.bincount(group)[group] > 1) & ~settled)
        # Names are few now: each distinct (name, fragment) is a class.
        least, first = earliest(name[open_] ^ digest[open_] * np.uint64(BASE), doc[open_])
        gone = open_[doc[open_] > least]
        classes = open_[first]
        different = np.bincount(group[classes], minlength=int(group.max()) + 1 if len(group) else 0)
        low_doc = np.full(len(different), LAST)
        high_doc = np.full(len(different), np.iinfo(np.int64).min)
        np.minimum.at(low_doc, group[classes], doc[classes])
        np.maximum.at(high_doc, group[classes], doc[classes])
        # Equal fragments of one document are kept apart, so that each is looked at.
        held = open_[doc[open_] == least]
        ask = held[(different[group[held]] > 1) & (low_doc < high_doc)[group[held]]]
        out = np.concatenate([np.flatnonzero(settled), gone, ask])
        frame = pd.DataFrame({"file": file[out], "row": row[out], "doc": doc[out], "low": low[out], "high": high[out]})
        names = pd.array(name[out].astype(np.int64), dtype="Int64")
        names[: len(out) - len(ask)] = pd.NA
        frame["name"] = names
        wide = np.zeros(len(out), bool)
        wide[len(out) - len(ask) :] = different[group[ask]] > many
        frame["wide"] = wide
        return frame

    return dealt.groupBy("bucket").applyInPandas(of, schema)


def windows_of(hasher: Hasher, data: bytes, low: int, high: int, size: int) -> Iterator[tuple[int, int]]:
    """(name, first byte) of the single windows of a range."""
    for begin in range(low, high - size + 1, SLICE):
        end = min(high, begin + SLICE + size - 1)
        sums = hasher.sums(np.frombuffer(data, np.uint8, end - begin, begin))
        at = np.arange(end - begin - size + 1)
        yield from zip(hasher.of(sums, at, at + size).astype(np.int64).tolist(), (at + begin).tolist(), strict=True)


def cut_out(asked: DataFrame, buckets: int, size: int) -> DataFrame:
    """(bucket, name, doc, file, row, low, high, data) of the fragments asked for; those of very common names by single
    windows. Without ``data``: a range that an earlier document of the batch settles."""
    schema = "bucket long, name long, doc long, file long, row long, low long, high long, data binary"
    columns = ["name", "doc", "file", "row", "low", "high", "data"]

    def dealt(out: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=columns)
        frame.insert(0, "bucket", (mixed(frame["name"].to_numpy(np.int64).astype(np.uint64)) % np.uint64(buckets)).astype(np.int64))
        return frame

    def narrowed(singles: list[tuple]) -> Iterator[pd.DataFrame]:
        """Of equal windows in later documents only their ranges are left."""
        least: dict[bytes, int] = {}
        for _, doc, *_, data in singles:
            least[data] = min(doc, least.get(data, doc))
        yield dealt([s for s in singles if s[1] == least[s[-1]]])
        gone = [s[2:6] for s in singles if s[1] > least[s[-1]]]
        if gone:
            frame = pd.DataFrame(gone, columns=["file", "row", "low", "high"])
            number = frame.groupby(["file", "row"], sort=False).ngroup().to_numpy()
            _, first = np.unique(number, return_index=True)
            n, low, high = joined_runs(number, frame["low"].to_numpy(), frame["high"].to_numpy())
            file, row = (frame[c].to_numpy()[first][n] for c in ("file", "row"))
            # Dealt by row, under a name of its own: nothing is compared with it.
            yield dealt([(r, 0, f, r, a, b, None) for f, r, a, b in zip(file.tolist(), row.tolist(), low.tolist(), high.tolist(), strict=True)])

    def of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for part in parts:
            whole: list[tuple] = []
            singles: list[tuple] = []
            rows = zip(*(part[c] for c in ("doc", "file", "row", "data", "names", "lows", "highs", "wides")), strict=True)
            for doc, file, row, data, names, lows, highs, wides in rows:
                for name, low, high, wide in zip(names.tolist(), lows.tolist(), highs.tolist(), wides.tolist(), strict=True):
                    if wide:
                        singles += [(w, doc, file, row, i, i + size, data[i : i + size]) for w, i in windows_of(hasher, data, low, high, size)]
                    else:
                        whole.append((name, doc, file, row, low, high, data[low:high]))
                if len(whole) >= HAND_ON:
                    yield dealt(whole)
                    whole = []
                if len(singles) >= 5 * HAND_ON:
                    yield from narrowed(singles)
                    singles = []
            if whole:
                yield dealt(whole)
            if singles:
                yield from narrowed(singles)

    return asked.mapInPandas(of, schema)


def settled_by_suffixes(data: list[bytes], doc: np.ndarray, size: int) -> tuple[list[tuple[int, int, int]], set[int]]:
    """(entry, first byte, end) of the ranges of these strings that an earlier document has too, and the entries
    of which it has every window."""
    lengths = np.array([len(d) for d in data])
    # A symbol below all bytes ends each string, so that no window runs on.
    raw = np.frombuffer(b"".join(d + b"\0" for d in data), np.uint8)
    text = raw.astype(np.int64) + 1
    starts = np.cumsum(lengths + 1) - lengths - 1
    text[starts + lengths] = 0
    entry = np.repeat(np.arange(len(data)), lengths + 1)
    offset = np.arange(len(text)) - starts[entry]
    whole = offset + size <= lengths[entry]
    order = suffix_array(text)
    order = order[whole[order]]
    run = equal_runs(raw, order, size)
    least, _ = earliest(run, doc[entry[order]])
    gone = order[doc[entry[order]] > least]
    windows = np.bincount(entry[gone], minlength=len(data))
    n, a, b = joined_runs(entry[gone], offset[gone], offset[gone] + size)
    whole_gone = np.flatnonzero(windows == lengths - size + 1)
    return list(zip(n.tolist(), a.tolist(), b.tolist(), strict=True)), set(whole_gone.tolist())


def possible(hasher: Hasher, name: np.ndarray, data: list[bytes], doc: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(entry, first byte, end) of the runs of windows whose hash another document has under the same name."""
    lengths = np.array([len(d) for d in data])
    ends = np.cumsum(lengths)
    sums = hasher.sums(np.frombuffer(b"".join(data), np.uint8))
    counts = np.maximum(lengths - size + 1, 0)
    entry = np.repeat(np.arange(len(data)), counts)
    offset = np.arange(len(entry)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (ends - lengths)[entry] + offset
    key = hasher.of(sums, at, at + size) ^ mixed(name.astype(np.uint64))[entry]
    order = np.lexsort((doc[entry], key))
    fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]]) if len(key) else np.zeros(0, bool)
    starts = np.flatnonzero(fresh)
    stops = np.append(starts[1:], len(order)) - 1
    shared = (doc[entry[order[stops]]] > doc[entry[order[starts]]]) if len(order) else np.zeros(0, bool)
    kept = order[shared[np.cumsum(fresh) - 1]] if len(order) else order
    n, a, b = joined_runs(entry[kept], offset[kept], offset[kept] + size)
    return list(zip(n.tolist(), a.tolist(), b.tolist(), strict=True))


def settled_in_rounds(data: list[bytes], doc: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """As settled_by_suffixes, for a name of any size: arrays of about AT_ONCE symbols settle their strings, and
    those that lose every window leave before the rest meets. The earliest document with a window keeps that window, so it stays."""
    alive, found = list(range(len(data))), []
    while alive:
        ends = np.cumsum([len(data[n]) + 1 for n in alive]) // AT_ONCE
        cuts = [*np.flatnonzero(np.diff(ends, prepend=-1)).tolist(), len(alive)]
        stay: list[int] = []
        for low, high in zip(cuts, cuts[1:], strict=False):
            some = alive[low:high]
            ranges, gone = settled_by_suffixes([data[n] for n in some], doc[some], size)
            found += [(some[n], a, b) for n, a, b in ranges]
            stay += [n for i, n in enumerate(some) if i not in gone]
        if len(cuts) == 2:
            break
        if 10 * len(stay) > 9 * len(alive):
            ranges, _ = settled_by_suffixes([data[n] for n in stay], doc[stay], size)
            found += [(stay[n], a, b) for n, a, b in ranges]
            break
        alive = stay
    return found


def in_names(name: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of entries, sorted by name: whole names, up to ``most`` of ``sizes`` or one name."""
    starts = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]])) if len(name) else np.zeros(0, np.int64)
    begin, held = 0, 0
    for low, more in zip(starts.tolist(), np.add.reduceat(sizes, starts).tolist() if len(starts) else [], strict=True):
        if held and held + more > most:
            yield begin, low
            begin, held = low, 0
        held += more
    if held:
        yield begin, len(name)


def settled_names(name: np.ndarray, doc: np.ndarray, data: list[bytes], size: int) -> Iterator[tuple[int, int, int]]:
    """(entry, first byte, end) of the ranges that an earlier document has too, of strings sorted by name."""
    hasher = Hasher()
    for low, high in in_names(name, np.array([len(d) for d in data], np.int64), SLICE):
        left = possible(hasher, name[low:high], data[low:high], doc[low:high], size)
        entry = np.array([n + low for n, _, _ in left], np.int64)
        for begin, end in in_names(name[entry], np.array([b - a + 1 for _, a, b in left], np.int64), AT_ONCE):
            strings = [data[low + n][a:b] for n, a, b in left[begin:end]]
            for n, a, b in settled_in_rounds(strings, doc[entry[begin:end]], size):
                shift = left[begin + n][1]
                yield low + left[begin + n][0], shift + a, shift + b


def place_of(file: np.ndarray, row: np.ndarray, places: int) -> np.ndarray:
    """The place of a text, of ``places``; as PLACE has it."""
    return (file % places + row) % places


#: The same as an expression: files are hashes and rows count up, so texts spread evenly.
PLACE = "pmod(pmod(file, {0}) + row, {0})"


def packed_ranges(frame: pd.DataFrame, places: int) -> pd.DataFrame:
    """One row for each place with the ranges (file, row, low, high) of its texts as bytes."""
    table = frame[["file", "row", "low", "high"]].to_numpy(np.int64)
    at = place_of(table[:, 0], table[:, 1], places)
    order = np.lexsort((table[:, 2], table[:, 1], table[:, 0], at))
    at, table = at[order], table[order]
    cuts = np.flatnonzero(np.diff(at, prepend=-1))
    blobs = [table[a:b].tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(at)), strict=False)]
    return pd.DataFrame({"at": at[cuts], "hits": blobs})


def looked_at(cut: DataFrame, size: int, places: int) -> DataFrame:
    """Ranges that go, packed by place of their text: at, hits."""

    def of(key, part: pd.DataFrame) -> pd.DataFrame:
        known = part["data"].isna()
        done = part.loc[known, ["file", "row", "low", "high"]]
        part = part[~known].sort_values(["name", "doc"])
        if not len(part):
            return packed_ranges(done, places)
        # What a document has several times is compared once.
        same = part.groupby(["name", "doc", "data"], sort=False).ngroup().to_numpy()
        _, first = np.unique(same, return_index=True)
        name, doc = (part[c].to_numpy(np.int64)[first] for c in ("name", "doc"))
        data = part["data"].to_numpy()[first].tolist()
        found = list(settled_names(name, doc, data, size))
        entry, a, b = np.array(found, np.int64).reshape(-1, 3).T
        ranges = pd.DataFrame({"same": entry, "a": a, "b": b})
        copies = pd.DataFrame({"same": same, **{c: part[c].to_numpy() for c in ("file", "row", "low")}})
        hit = ranges.merge(copies, on="same")
        found = marks_of(hit["file"], hit["row"], hit["low"] + hit["a"], hit["low"] + hit["b"])
        return packed_ranges(pd.concat([done, found]), places)

    return cut.groupBy("bucket").applyInPandas(of, "at long, hits binary")


def without_ranges(texts: pd.DataFrame, gone: pd.DataFrame) -> pd.DataFrame:
    """The texts of one place without the ranges that go: some rows hold one, some many packed."""
    packed = gone["hits"].notna().to_numpy()
    blobs = b"".join(gone["hits"][packed])
    single = gone.loc[~packed, ["file", "row", "low", "high"]].to_numpy(np.int64)
    table = np.concatenate([single, np.frombuffer(blobs, np.int64).reshape(-1, 4)])
    table = table[np.lexsort((table[:, 2], table[:, 1], table[:, 0]))]
    fresh = np.flatnonzero((np.diff(table[:, :2], axis=0, prepend=table[:1, :2] - 1) != 0).any(axis=1))
    ends = [*fresh[1:].tolist(), len(table)]
    of_text = {tuple(table[a, :2].tolist()): table[a:b, 2:] for a, b in zip(fresh.tolist(), ends, strict=False)}
    none, out = np.zeros((0, 2), np.int64), []
    for file, row, data in zip(texts["file"].tolist(), texts["row"].tolist(), texts["data"], strict=True):
        ranges = of_text.get((file, row), none)
        runs = []
        if len(ranges):
            _, a, b = joined_runs(np.zeros(len(ranges), np.int64), ranges[:, 0], ranges[:, 1])
            runs = list(zip(a.tolist(), b.tolist(), strict=True))
        stays = [0, *[x for r in runs for x in r], len(data)]
        kept = b"".join(data[a:b] for a, b in zip(stays[::2], stays[1::2], strict=True))
        out.append((len(data), [{"low": a, "high": b} for a, b in runs], kept))
    done = pd.DataFrame(out, columns=["n_bytes", "runs", "kept"])
    done.insert(0, "doc_id", texts["doc_id"].array)
    return done


def without_repeats(docs: DataFrame, size: int = SIZE, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES, many: int = MANY) -> DataFrame:
    """One row per document: doc_id, n_bytes, the removed ``runs`` (first byte, end) and ``kept`` bytes."""
    docs = file_backed(docs)
    rows = rows_with_bytes(docs)
    total = docs.agg(F.sum(F.octet_length(text_of()))).first()[0] or 0
    buckets = int(total // bucket_bytes) + 1
    found = saved(compared(dealt_fragments(rows, buckets, size, gram), many), "repeats")
    # Arrays of numbers reach Python as numpy arrays, a list of structs as dictionaries.
    asks = found.filter("name is not null").groupBy("file", "row").agg(F.collect_list(F.struct("name", "low", "high", "wide")).alias("a"))
    asks = asks.select("file", "row", *[F.col(f"a.{c}").alias(f"{c}s") for c in ("name", "low", "high", "wide")])
    cut = cut_out(rows.drop("doc_id").join(asks, ["file", "row"]), 4 * buckets, size)
    seen = saved(looked_at(cut, size, buckets), "repeats-seen")
    at = F.expr(PLACE.format(buckets)).alias("at")
    settled = found.filter("name is null").select(at, "file", "row", "low", "high")
    # Columns of whole numbers with nulls would reach Python as floats.
    none = [F.lit(0).cast("long").alias(c) for c in ("file", "row", "low", "high")]
    gone = settled.withColumn("hits", F.lit(None).cast("binary")).unionByName(seen.select("at", *none, "hits"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, runs array<struct<low: long, high: long>>, kept binary"
    texts = rows.select(at, "doc_id", "file", "row", "data")
    # A place holds about ``bucket_bytes`` of text.
    return texts.groupBy("at").cogroup(gone.groupBy("at")).applyInPandas(without_ranges, schema)
