"""Packing pieces of documents into as few sequences as possible by bin completion.

What matters for a packing is how many pieces there are of each length, and there
are no more lengths than a sequence has tokens. So the search runs on that table
alone: a depth-first branch and bound takes, around the largest piece left, the
fillings that no other one dominates, goes back to every choice, prunes by the
waste a better solution may have, and starts from the best-fit packing. It ends
when nothing better is possible or its budget of steps is spent. Spark then deals
the pieces of each length, by their number within the length, to the places that
the fillings leave for it.

Cases: null and empty texts are one token, the separator; repeated rows are
documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cratewise.llm.common import bits_for, running_total, saved, text_of

CAPACITY = 2048
SEPARATOR = 0
#: Steps of the walk through fillings after which the fullest found are tried, and steps of a whole search.
LOOK, BUDGET = 400, 1_000_000
#: Words whose ids a worker keeps, and words that are handed to the tokenizer at once.
WORDS_KEPT, LEARNED_AT_ONCE = 300_000, 1 << 15
#: The ASCII marks but for the apostrophe, as a class of an expression.
MARKS = r"!-&(-/:-@\[-`{-~"
#: Characters whose words are looked up together (one text at least).
CHARS_AT_ONCE = 6_000_000


def spaced(texts: pa.LargeStringArray) -> pa.LargeStringArray:
    """Texts with the same ids and fewer different words: ASCII letters lower-cased, and a space wherever the
    tokenizer cuts at ASCII anyway: round digits and between letters and marks, except before what may be a
    contraction. Combining marks join with the letter before them and special tokens are spelled with marks, so
    texts with either stay as they are."""
    found = pc.ascii_lower(texts)
    found = pc.replace_substring_regex(found, rf"([a-z])([{MARKS}'])", r"\1 \2")
    found = pc.replace_substring_regex(found, rf"([{MARKS}])([a-z])", r"\1 \2")
    found = pc.replace_substring_regex(found, "[0-9]", r" \0 ")
    return pc.if_else(pc.match_substring_regex(texts, r"\p{M}|<\|"), texts, found)


class WordIds:
    """Ids of texts by way of their words.

    The tokenizer never joins anything across white space, so ids are kept by word
    from text to text. Each different word of a batch is looked up once; the ids of
    its texts are then gathered by number. The memory for words is bounded: the half
    that was not used last is dropped when it is full, which costs time and changes
    nothing.
    """

    def __init__(self, path: str, kept: int = WORDS_KEPT):
        self.tokenizer, self.kept = Tokenizer.from_file(path), kept
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def of_worker(path: str) -> WordIds:
        """The one of this process, which a worker keeps from task to task."""
        known = sys.__dict__.setdefault("_word_ids", {})
        if path not in known:
            known[path] = WordIds(path)
        return known[path]

    def learned(self, words: list[str]) -> Iterator[bytes]:
        for low in range(0, len(words), LEARNED_AT_ONCE):
            some = words[low : low + LEARNED_AT_ONCE]
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            at = np.array(found.word_ids, np.int64)
            ends = (4 * np.searchsorted(at, np.arange(len(some) + 1))).tolist()
            raw = np.array(found.ids, "<u4").tobytes()
            yield from [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def of(self, words: list[str]) -> list[bytes]:
        """Ids of different words."""
        if len(self.recent) > self.kept // 2:
            self.older, self.recent = self.recent, {}
        found, new = [], []
        for word in words:
            ids = self.recent.get(word)
            if ids is None:
                ids = self.older.get(word)
                if ids is None:
                    new.append(word)
                else:
                    self.recent[word] = ids
            found.append(ids)
        made = self.learned(new)
        found = [next(made) if ids is None else ids for ids in found]
        room = max(0, self.kept // 2 - len(self.recent))
        fresh = set(new[:room])
        self.recent.update((w, ids) for w, ids in zip(words, found, strict=True) if w in fresh)
        return found

    def encode(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin, with the end after the last."""
        split = pc.split_pattern(pc.replace_substring(spaced(texts), "\n", " "), " ")
        flat = split.flatten().dictionary_encode()
        ids = self.of(flat.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        every, first = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        number = flat.indices.to_numpy()
        each = sizes[number]
        stops = np.concatenate([[0], np.cumsum(each)])
        at = np.arange(stops[-1]) + np.repeat(first[number] - stops[:-1], each)
        offsets = split.offsets.to_numpy()
        return every[at], stops[offsets - offsets[0]]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's pieces of at most ``capacity`` tokens."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = WordIds.of_worker(path), np.array([SEPARATOR], "<u4")
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            place = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False)) // CHARS_AT_ONCE
            cuts = [*np.flatnonzero(np.diff(place, prepend=-1)).tolist(), len(texts)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                ids, bounds = words.encode(texts.slice(low, high - low))
                rows = []
                for at, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist(), strict=False), low):
                    own = np.concatenate([ids[a:b], end])
                    for number, start in enumerate(range(0, len(own), capacity)):
                        cut = own[start : start + capacity]
                        rows.append((at, number, start, len(cut), zlib.crc32(cut)))
                at, number, start, length, crc = zip(*rows, strict=True)
                longs = [pa.array(x, pa.int64()) for x in (start, length, crc)]
                columns = [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(number, pa.int32()), *longs]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(of, schema)


def fillings(room: int, lengths: list[int], counts: dict[int, int]) -> Iterator[tuple[tuple[int, int], ...] | None]:
    """Fillings of ``room`` as (length, copies), long pieces first, with pieces of the given lengths (ascending).

    Equal lengths are one step of the walk, whose stack is a list: a filling may
    hold any number of pieces. A filling is left out if a longer piece could stand
    in for one of its own or another piece would still fit: such a filling is
    dominated. None is a step without a filling, so that the caller can count.
    """

    def dominated(used: list[tuple[int, int]], rest: int) -> bool:
        taken = dict(used)
        for short in (0, *taken):
            at = bisect_right(lengths, rest + short) - 1
            while at >= 0 and lengths[at] > short and counts[lengths[at]] == taken.get(lengths[at], 0):
                at -= 1
            if at >= 0 and lengths[at] > short:
                return True
        return False

    def choices(rest: int, below: int) -> Iterator[tuple[int, int, int]]:
        for at in range(min(bisect_right(lengths, rest), below) - 1, -1, -1):
            length = lengths[at]
            for copies in range(min(counts[length], rest // length), 0, -1):
                yield at, copies, rest - copies * length

    used: list[tuple[int, int]] = []
    stack = [choices(room, len(lengths))]
    if next(choices(room, len(lengths)), None) is None:
        yield ()
        return
    while stack:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if used:
                used.pop()
            continue
        at, copies, rest = step
        used.append((lengths[at], copies))
        if next(choices(rest, at), None) is None:
            yield None if dominated(used, rest) else tuple(used)
            used.pop()
        else:
            yield None
            stack.append(choices(rest, at))


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The first filling around the largest piece left, as often as the counts allow, until none is left."""
    counts, packing = {k: v for k, v in counts.items() if v}, []
    lengths = sorted(counts)
    while lengths:
        largest, used = lengths[-1], {lengths[-1]: 1}
        rest = capacity - largest
        counts[largest] -= 1
        for length in reversed(lengths):
            copies = min(counts[length], rest // length)
            if copies:
                used[length] = used.get(length, 0) + copies
                rest -= copies * length
        counts[largest] += 1
        times = min(counts[k] // n for k, n in used.items())
        packing.append((tuple(k for k, n in used.items() for _ in range(n)), times))
        for k, n in used.items():
            counts[k] -= times * n
        lengths = [k for k in lengths if counts[k]]
    return packing


class Search:
    """Depth-first branch and bound over the table of counts.

    A node is a filling around the largest piece left and the number of its uses.
    All undominated fillings are tried in the end, the fullest of every ``look``
    first; as many uses as the counts allow come before a single one, from which
    any number follows. A branch ends where its waste exceeds what a packing of
    one sequence fewer may waste. ``budget`` counts the steps of the whole search;
    ``proven`` tells whether it ended by itself or at the lower bound.
    """

    def __init__(self, counts: dict[int, int], capacity: int, size: int, least: int, look: int, budget: int):
        self.counts = {k: v for k, v in counts.items() if v}
        self.capacity, self.size, self.least, self.look, self.budget = capacity, size, least, look, budget
        self.total = sum(k * v for k, v in counts.items())
        self.best: list[tuple[tuple[tuple[int, int], ...], int]] | None = None
        self.proven = size <= least

    def slack(self) -> int:
        """What a packing better by one sequence may waste."""
        return (self.size - 1) * self.capacity - self.total

    def options(self, waste: int) -> Iterator[tuple[tuple[tuple[int, int], ...], int, int]]:
        """(filling, uses, its waste) around the largest piece left; the counts must be as they were at each step."""
        counts = dict(self.counts)
        lengths = sorted(k for k, v in counts.items() if v)
        largest, single = lengths[-1], []
        counts[largest] -= 1
        room = self.capacity - largest

        def ready(some: list[tuple[int, tuple[tuple[int, int], ...]]]):
            for empty, used in sorted(some):
                times = min(self.counts[k] // n for k, n in used)
                if times > 1:
                    single.append((used, 1, empty))
                yield used, times, empty * times

        batch, steps = [], 0
        for found in fillings(room, lengths, counts):
            self.budget -= 1
            if self.budget < 0:
                break
            steps += 1
            if found is not None:
                empty = room - sum(k * n for k, n in found)
                used = dict(found)
                used[largest] = used.get(largest, 0) + 1
                pair = (empty, tuple(sorted(used.items(), reverse=True)))
                if empty == 0:
                    yield from ready([pair])
                elif waste + empty <= self.slack():
                    batch.append(pair)
            if steps >= self.look:
                yield from ready(batch)
                batch, steps = [], 0
        yield from ready(batch)
        yield from single

    def run(self) -> Search:
        """Goes on until nothing better is possible or the budget is spent."""
        if self.proven or not self.counts:
            return self
        waste, path, stack = 0, [], [self.options(0)]
        while stack:
            option = next(stack[-1], None)
            if option is None:
                stack.pop()
                if path:
                    used, times, lost = path.pop()
                    waste -= lost
                    for k, n in used:
                        self.counts[k] += times * n
                continue
            used, times, lost = option
            if waste + lost > self.slack():
                continue
            path.append(option)
            waste += lost
            for k, n in used:
                self.counts[k] -= times * n
            if any(self.counts.values()):
                stack.append(self.options(waste))
                continue
            self.best, self.size = [(used, times) for used, times, _ in path], sum(times for _, times, _ in path)
            if self.size <= self.least:
                self.proven = True
                return self
            path.pop()
            waste -= lost
            for k, n in used:
                self.counts[k] += times * n
        self.proven = self.budget >= 0
        return self


def lower_bound(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """Sequences that any packing needs."""
    total = sum(k * v for k, v in counts.items())
    return max(-(-total // capacity), sum(v for k, v in counts.items() if 2 * k > capacity))


def pack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """The best packing found of ``counts`` (length to number of pieces)."""
    least = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    size = sum(times for _, times in best)
    for look, budget in ((LOOK // 20, BUDGET // 4), (LOOK, BUDGET)):
        found = Search(counts, capacity, size, least, look, budget).run()
        if found.best is not None:
            best = [(tuple(k for k, n in used for _ in range(n)), times) for used, times in found.best]
            size = found.size
        if found.proven:
            break
    return best


def places(packing: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, last, sequence, copies, offset): the pieces of a length numbered
    first..last fill the sequences from ``sequence`` on, ``copies`` in each, from ``offset``."""
    given: dict[int, int] = {}
    rows, sequence = [], 0
    for used, times in packing:
        offset = 0
        for length in sorted(set(used), reverse=True):
            copies = used.count(length)
            first = given.get(length, 0)
            given[length] = first + copies * times
            rows.append((length, first, given[length] - 1, sequence, copies, offset))
            offset += copies * length
        sequence += times
    return rows


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    spark = docs.sparkSession
    cut = saved(pieces(docs, path, capacity), "pieces")
    # At most ``capacity`` rows, whatever the number of pieces.
    counts = {row[0]: row[1] for row in cut.groupBy("length").count().collect()}
    bits = bits_for(sum(counts.values()))
    order = ["doc_id", "piece", "start", "ids_crc32"]
    one = cut.withColumn("_one", F.lit(1).cast("long"))
    numbered = running_total(one, ["length"], order, "_one", "_number", bits).drop("_one")
    kind = "_l long, _first long, _last long, _sequence long, _copies long, _offset long"
    table = spark.createDataFrame(places(pack(counts, capacity)), kind)
    here = (F.col("length") == F.col("_l")) & F.col("_number").between(F.col("_first"), F.col("_last"))
    # A few fillings for each length at most: a table of bounded size.
    found = numbered.join(F.broadcast(table), here)
    within = F.col("_number") - F.col("_first")
    sequence = (F.col("_sequence") + F.floor(within / F.col("_copies"))).cast("long")
    offset = (F.col("_offset") + within % F.col("_copies") * F.col("length")).cast("long")
    return found.select(*cut.columns, sequence.alias("sequence_id"), offset.alias("offset"))
