"""Toxicity scores from a convolutional text classifier trained in numpy.

A word's vector is the sum of hashed embeddings of the word and of its beginnings.
Filters of several widths run over the words; the text is cut into stretches of
64 words, and each filter's largest response is taken in every stretch. A
document's features are, for each filter, the largest and the mean of these, so
that both one sure sign and a steady rate of weak ones can tell. A logistic layer
makes them a score, which a part of the labelled documents kept out of training
then calibrates. The same part gives each language its own threshold, which is
beside the score: language is no input of it.

All labelled documents outside the held-out fold count, in whole texts. They are
dealt into parts of about PART_CHARS characters by hash. Up to that size one task
goes over them several times; where there are more parts, each row is learned from once,
in one of ROUNDS rounds: each part trains the same network on its own rows of the
round and the networks are averaged. The
calibrating documents are scored and counted by Spark. Only the network and the
counts by rounded score reach the driver. Training and scoring take long texts in
slabs of bounded size.

Cases: null and empty texts have no words, a stretch of padding, and a score like
any other; repeated rows are scored alike; of several labels of a document a 1
wins; without labels of both classes every score is the share of the one there is
(0.5 without any); an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratewise.llm.common import file_backed, located, saved, text_of

WORD = re.compile(r"[^\W\d_]+")
#: Width of each filter in words, filters of each width, embedding size and rows of the hashed table.
WIDTHS, FILTERS, SIZE, ROWS = (1, 2, 3), 12, 12, 1 << 16
#: Letters of the beginnings that are hashed beside the word.
BEGINNINGS = (3, 4, 5, 6, 7)
PIECES = 1 + len(BEGINNINGS)
#: Padding after a text: no window reaches the next one.
GAP = max(WIDTHS)
STRETCH = 64
#: Words of a slab while scoring, and words whose projections a worker remembers.
SLAB, REMEMBERED = 1 << 15, 1 << 17
#: Characters of a part (about), rounds that several parts take, and characters to be learned from where there is one.
PART_CHARS, ROUNDS, LEARNED_CHARS = 48_000_000, 2, 168_000_000
#: Characters of a part that a task holds at once: a part is larger only where an id repeats very often.
HELD_CHARS = 2 * PART_CHARS
#: Rows of a file that share a bitmap (as many as Spark's bitmaps have bits), and bytes of bitmaps that each executor may hold.
BLOCK, SENT = 1 << 15, 1 << 28
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: One of so many labelled documents calibrates; examples of each class that a language's own threshold needs.
CALIBRATES, LEAST_EXAMPLES = 5, 8
#: Weight of recall beside precision in the F measure of a cut (beta squared): clean documents are to be left alone.
RECALL_WEIGHT = 0.25
PASSES, BATCH, RATE, DECAY, SEED = 14, 32, 0.06, 1e-4, 7
#: Log odds are counted up to so large, by steps of a thousandth.
FAR, STEPS = 30.0, 1000
#: The network's arrays; of the first, a part changes some rows.
PARAMETERS = ("table", "filters", "bias", "out", "offset")


def fold_of(column: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % FOLDS


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def pieces_of(word: str) -> list[int]:
    """Rows of the hashed table that make up a word."""
    parts = [word, *[f"{word[:n]}-" for n in BEGINNINGS]]
    return [zlib.crc32(p.encode("utf-8", "replace")) % ROWS for p in parts]


def stretches(sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Layout of texts of ``sizes`` words laid end to end with padding between:
    starts of all segments, which of them are stretches, and the first stretch of each text."""
    starts, real, first, at, count = [], [], [], 0, 0
    for size in sizes:
        size = max(1, size)
        own = range(at, at + size, STRETCH)
        first.append(count)
        count += len(own)
        at += size
        # A window that starts in the padding belongs to no text.
        starts.extend([*own, at])
        real.extend([True] * len(own) + [False])
        at += GAP
    return np.array(starts), np.array(real, bool), np.array(first)


def laid_out(texts: list[np.ndarray]) -> np.ndarray:
    """Word numbers of several texts end to end, as ``stretches`` places them; 0 is padding."""
    gap, lone = np.zeros(GAP, np.int64), np.zeros(1, np.int64)
    return np.concatenate([p for ids in texts for p in (ids if len(ids) else lone, gap)])


class Network:
    """Embeddings, filters and the logistic layer."""

    def __init__(self):
        rng = np.random.default_rng(SEED)
        self.table = rng.normal(0, 0.02, (ROWS, SIZE)).astype(np.float32)
        # The filters of one width after the other; of each, one block per word of the window.
        self.blocks = [(w, k) for w in WIDTHS for k in range(w)]
        self.filters = rng.normal(0, 0.3, (SIZE, len(self.blocks) * FILTERS)).astype(np.float32)
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, 2 * len(WIDTHS) * FILTERS).astype(np.float32)
        self.offset = np.zeros(1, np.float32)

    def projected(self, pieces: np.ndarray) -> np.ndarray:
        """For each word, given by its pieces, what it adds to every filter at every place of the window."""
        return self.table[pieces].sum(axis=1) @ self.filters

    def responses(self, projected: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Response of every filter (columns) at every word (rows); row 0 of ``projected`` is padding."""
        rows = projected[np.concatenate([ids, np.zeros(GAP, ids.dtype)])]
        found, block = [], 0
        for width in WIDTHS:
            total = 0
            for k in range(width):
                total = total + rows[k : k + len(ids), block * FILTERS : (block + 1) * FILTERS]
                block += 1
            found.append(total)
        return np.concatenate(found, axis=1)

    def logits(self, largest: np.ndarray, mean: np.ndarray) -> np.ndarray:
        return np.concatenate([largest, mean], axis=1) @ self.out + self.offset[0]

    def peaks(self, projected: np.ndarray, ids: np.ndarray, starts: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Responses, and the largest of each stretch."""
        found = self.responses(projected, ids)
        return found, np.maximum.reduceat(found, starts, axis=0)[real]


def fresh_state(network: Network) -> dict[str, np.ndarray]:
    """What Adagrad has seen of each parameter."""
    return {name: np.full_like(getattr(network, name), 1e-3) for name in PARAMETERS}


class Numbered:
    """Texts as numbers of their words, with the rows of the hashed table that each word has."""

    def __init__(self):
        self.names: dict[str, int] = {}
        self.pieces: list[np.ndarray] = [np.zeros((1, PIECES), np.uint16)]
        self.texts: list[np.ndarray] = []
        self.labels: list[float] = []
        self.chars = 0

    def add(self, words: list[str], label: float) -> None:
        new = sorted(set(words).difference(self.names))
        if new:
            self.names.update(zip(new, range(len(self.names) + 1, len(self.names) + len(new) + 1), strict=True))
            self.pieces.append(np.array([pieces_of(w) for w in new], np.uint16))
        self.texts.append(np.fromiter(map(self.names.__getitem__, words), np.int32, len(words)))
        self.labels.append(label)

    def learn(self, network: Network, state: dict, share: float, passes: int, rng: np.random.Generator) -> np.ndarray:
        """Goes over the texts; tells which rows of the table their words have. ``share``: of toxic ones among all."""
        pieces, labels = np.concatenate(self.pieces), np.array(self.labels, np.float32)
        self.names = {}
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        # Texts of like length share a batch, so that no batch is much larger than the others.
        by_size = np.argsort([len(t) for t in self.texts], kind="stable")
        for _ in range(passes):
            batches = [b for b in np.split(by_size, range(int(rng.integers(1, BATCH)), len(by_size), BATCH)) if len(b)]
            for number in rng.permutation(len(batches)):
                chosen = batches[number]
                step(network, state, pieces, [self.texts[i] for i in chosen], labels[chosen], weight[chosen])
        used = np.zeros(ROWS, bool)
        used[pieces[1:].ravel()] = True
        return used


def trained(texts: list[list[str]], labels: np.ndarray) -> Network:
    """A network fitted to word lists; each class weighs the same."""
    network, numbered = Network(), Numbered()
    for words, label in zip(texts, labels.tolist(), strict=True):
        numbered.add(words, label)
    used = numbered.learn(network, fresh_state(network), float(labels.mean()), PASSES, np.random.default_rng(SEED))
    # Rows that no word uses say nothing.
    network.table[~used] = 0
    return network


def descend(network: Network, state: dict, name: str, gradient: np.ndarray, rows: np.ndarray | None = None) -> None:
    """One step of Adagrad on a parameter, or on some of its rows."""
    value, seen = getattr(network, name), state[name]
    if rows is None:
        seen += gradient**2
        value -= RATE * (gradient + DECAY * value) / np.sqrt(seen)
    else:
        seen[rows] += gradient**2
        value[rows] -= RATE * gradient / np.sqrt(seen[rows])


def step(network: Network, state: dict, pieces: np.ndarray, texts: list[np.ndarray], labels: np.ndarray, weight: np.ndarray) -> None:
    """Forward and backward over one batch of texts."""
    words, ids = np.unique(laid_out(texts), return_inverse=True)
    starts, real, first = stretches([len(t) for t in texts])
    some = pieces[words]
    vectors = network.table[some].sum(axis=1)
    vectors[words == 0] = 0
    projected = vectors @ network.filters
    # Stretches in slabs of bounded size: their largest responses, and the words where their windows begin.
    ends = np.append(starts[1:], len(ids))
    cuts = [*np.flatnonzero(np.diff(starts // SLAB, prepend=-1)).tolist(), len(starts)]
    peaks, places = [], []
    for low, high in zip(cuts, cuts[1:], strict=False):
        begin, own = int(starts[low]), real[low:high]
        found = network.responses(projected, ids[begin : int(ends[high - 1]) + GAP])
        at = [found[a - begin : b - begin].argmax(axis=0) + a for a, b in zip(starts[low:high][own], ends[low:high][own], strict=True)]
        places += at
        peaks += [found[p - begin, np.arange(found.shape[1])] for p in at]
    peaks, places = np.array(peaks), np.array(places)
    active = np.maximum(peaks + network.bias, 0)
    counts = np.diff(np.append(first, len(active)))[:, None].astype(np.float32)
    largest, mean = np.maximum.reduceat(active, first, axis=0), np.add.reduceat(active, first, axis=0) / counts
    score = 1 / (1 + np.exp(-np.clip(network.logits(largest, mean), -30, 30)))
    back = ((score - labels) * weight / len(labels)).astype(np.float32)
    half = len(network.out) // 2
    of_out = np.concatenate([back @ largest, back @ mean])
    # Backwards: the mean goes to every stretch, the largest to the stretch that has it.
    text_of_stretch = np.repeat(np.arange(len(texts)), counts[:, 0].astype(int))
    at_mean = (back[:, None] * network.out[half:] / counts)[text_of_stretch]
    top = active == largest[text_of_stretch]
    so_far = np.cumsum(top, axis=0)
    top &= so_far - (so_far - top)[first][text_of_stretch] == 1
    at_peak = (at_mean + top * (back[:, None] * network.out[:half])[text_of_stretch]) * (active > 0)
    # And to the words of the window where the stretch has its largest response.
    wide, of_projected, block = np.concatenate([ids, np.zeros(GAP, ids.dtype)]), np.zeros_like(projected), 0
    for number, width in enumerate(WIDTHS):
        columns = slice(number * FILTERS, (number + 1) * FILTERS)
        for k in range(width):
            target = np.arange(block * FILTERS, (block + 1) * FILTERS)
            np.add.at(of_projected, (wide[places[:, columns] + k], target[None]), at_peak[:, columns])
            block += 1
    of_vectors = of_projected @ network.filters.T
    touched = (of_projected != 0).any(axis=1) & (words != 0)
    rows, inverse = np.unique(some[touched], return_inverse=True)
    of_table = np.zeros((len(rows), SIZE), np.float32)
    np.add.at(of_table, inverse.ravel(), np.repeat(of_vectors[touched], PIECES, axis=0))
    descend(network, state, "filters", vectors.T @ of_projected)
    descend(network, state, "bias", at_peak.sum(axis=0))
    descend(network, state, "out", of_out)
    descend(network, state, "offset", np.array([back.sum()], np.float32))
    if len(rows):
        descend(network, state, "table", of_table, rows)


class Model:
    """A network with its calibration and thresholds, or the one score there is without it."""

    def __init__(self, prior: float, network: Network | None = None):
        self.prior, self.network = prior, network
        self.shift = 0.0
        #: Threshold by language; THRESHOLD for the others.
        self.thresholds: dict[str | None, float] = {}
        self.forget()

    def forget(self) -> None:
        self.projections, self.filled = np.zeros((1, 1), np.float32), 1
        self.known: dict[str, int] = {}

    def numbers(self, words: list[str]) -> np.ndarray:
        """Rows of ``projections`` for some words; a worker forgets all of them when there are too many."""
        new = {w for w in words if w not in self.known}
        if new or not self.known:
            if not self.known or len(self.known) + len(new) > REMEMBERED:
                new, self.known = set(words), {}
                self.projections, self.filled = np.zeros((REMEMBERED + SLAB + 1, self.network.filters.shape[1]), np.float32), 1
            listed = sorted(new)
            for i, word in enumerate(listed, self.filled):
                self.known[word] = i
            if listed:
                pieces = np.array([pieces_of(w) for w in listed])
                self.projections[self.filled : self.filled + len(listed)] = self.network.projected(pieces)
                self.filled += len(listed)
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def odds(self, texts: list[str]) -> np.ndarray:
        """Calibrated log odds of whole texts, computed in slabs of words."""
        largest = np.full((len(texts), len(self.network.bias)), -np.inf, np.float32)
        total, count = np.zeros(largest.shape), np.zeros(len(texts))
        slab, size = [], 0
        for i, text in enumerate(texts):
            words = words_of(text)
            # Cut between stretches; a window sees a few words of the next piece.
            for start in range(0, max(1, len(words)), SLAB):
                piece = words[start : start + SLAB + GAP - 1]
                slab.append((i, piece, min(SLAB, len(words) - start)))
                size += len(piece)
                if size >= SLAB:
                    self.pool(slab, largest, total, count)
                    slab, size = [], 0
        if slab:
            self.pool(slab, largest, total, count)
        logits = self.network.logits(largest, (total / count[:, None]).astype(np.float32))
        return logits + self.shift

    def pool(self, slab: list[tuple], largest: np.ndarray, total: np.ndarray, count: np.ndarray) -> None:
        """Adds the stretches of a slab to the pooled figures of their texts."""
        every = self.numbers([w for _, piece, _ in slab for w in piece])
        bounds = list(accumulate((len(piece) for _, piece, _ in slab), initial=0))
        ids = laid_out([every[a:b] for a, b in zip(bounds, bounds[1:], strict=False)])
        starts, real, first = stretches([len(piece) for _, piece, _ in slab])
        _, peaks = self.network.peaks(self.projections, ids, starts, real)
        active = np.maximum(peaks + self.network.bias, 0)
        for (i, _, own), low, high in zip(slab, first, [*first[1:], len(active)], strict=True):
            # Stretches that start beyond the piece's own words are the next piece's.
            mine = active[low : low + max(1, -(-own // STRETCH))]
            largest[i] = np.maximum(largest[i], mine.max(axis=0))
            total[i] += mine.sum(axis=0)
            count[i] += len(mine)

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.network is None or not texts:
            return np.full(len(texts), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.odds(texts), -30, 30)))


def best_cut(values: np.ndarray, hits: np.ndarray, counts: np.ndarray) -> float:
    """Middle of the gap whose cut has the best F measure, the highest of equals; of different values, each with the
    number of its examples and of the toxic ones among them."""
    order = np.argsort(-values)
    ranked, caught = values[order], np.cumsum(hits[order])
    measure = caught / (np.cumsum(counts[order]) + RECALL_WEIGHT * hits.sum())
    at = int(np.argmax(measure))
    return float((ranked[at] + ranked[min(at + 1, len(ranked) - 1)]) / 2)


def calibrate(model: Model, rows: DataFrame) -> None:
    """Moves the log odds so that THRESHOLD is the best cut over all, and finds the cut of each language."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                odds = np.clip(model.odds(batch.column("text").to_pylist()), -FAR, FAR)
                values = pa.array(np.rint(STEPS * odds).astype(np.int64))
                yield pa.RecordBatch.from_arrays([values, batch.column("toxic"), batch.column("lang")], ["value", "toxic", "lang"])

    found = rows.select("text", "toxic", "lang").mapInArrow(of, "value long, toxic int, lang string")
    counted = saved(found.groupBy("lang", "value").agg(F.sum("toxic").alias("hits"), F.count("*").alias("n")), "toxic-scores")
    # At most one row for each step of the log odds.
    every = counted.groupBy("value").agg(F.sum("hits"), F.sum("n")).collect()
    cut = lambda table: best_cut(*np.array(table, np.float64).reshape(-1, 3).T)
    model.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - cut(sorted(every)) / STEPS)

    def of_lang(key, part: pd.DataFrame) -> pd.DataFrame:
        odds = cut(part.sort_values("value")[["value", "hits", "n"]]) / STEPS + model.shift
        return pd.DataFrame({"lang": [key[0]], "threshold": [round(float(1 / (1 + np.exp(-odds))), 6)]})

    toxic, clean = F.sum("hits"), F.sum(F.col("n") - F.col("hits"))
    enough = counted.filter("lang is not null").groupBy("lang").agg(F.least(toxic, clean).alias("_least"))
    enough = enough.filter(F.col("_least") >= LEAST_EXAMPLES).select("lang")
    cuts = counted.join(enough, "lang").groupBy("lang").applyInPandas(of_lang, "lang string, threshold double")
    model.thresholds = {r["lang"]: r["threshold"] for r in cuts.collect()}


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, lang, doc_id, apart) of all labelled documents outside the held-out fold.

    Only ids meet the labels. The rows found come back as two bitmaps for each block of a file, 2 bits a document, so
    that texts are filtered where they are read and none is shuffled.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold_of() != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumnRenamed("doc_id", "_id")
    lang = F.col("lang").cast("string").alias("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang")
    rows = file_backed(docs.select("doc_id", text_of().alias("text"), lang))
    rows = located(rows.filter(F.col("doc_id").isNotNull() & (fold_of() != HELD_OUT)))
    rows = rows.withColumns({"_block": F.expr(f"_row div {BLOCK}"), "_bit": F.col("_row") % BLOCK})
    found = rows.join(known, F.col("doc_id") == F.col("_id")).select("_file", "_block", "_bit", "toxic")
    bits = [F.bitmap_construct_agg("_bit").alias("_known"), F.bitmap_construct_agg(F.expr("if(toxic = 1, _bit, null)")).alias("_toxic")]
    marks = saved(found.groupBy(F.col("_file").alias("_f"), F.col("_block").alias("_b")).agg(*bits), "toxic-marks")
    if marks.count() * BLOCK // 4 <= SENT:
        marks = F.broadcast(marks)
    rows = rows.join(marks, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b"))).filter(marked("_known") == 1)
    return rows.select("text", marked("_toxic").cast("int").alias("toxic"), "lang", "doc_id", (dealt(CALIBRATES, 1) == 0).alias("apart"))


def marked(bitmap: str) -> Column:
    """Whether a row's bit is set in a bitmap of its block."""
    byte = f"cast(conv(hex(substring({bitmap}, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int)"
    return F.expr(f"getbit({byte}, cast(_bit % 8 as int))")


def dealt(count: int, salt: int) -> Column:
    return F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED + salt)), F.lit(count)).cast("int")


def learned_apart(batches: Iterator[pa.RecordBatch], network: Network, state: dict, share: float, passes: int, blocks: int) -> Iterator[pa.RecordBatch]:
    """(block, part, n, change) of the network of each part, trained from ``network`` on; rows come sorted by part.

    ``change`` holds, for a block of the table's rows, those used, their changes and those of ``state``; block -1 holds
    the changes of the other arrays.
    """
    schema = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("n", pa.int64()), ("change", pa.binary())])

    def finished(part: int, own: Network, seen: dict, used: np.ndarray, n: int) -> pa.RecordBatch:
        moved = {name: (getattr(own, name) - getattr(network, name), seen[name] - state[name]) for name in PARAMETERS}
        changes = [(-1, b"".join(x.tobytes() for name in PARAMETERS[1:] for x in moved[name]))]
        for block, rows in enumerate(np.array_split(np.arange(ROWS), blocks)):
            of_table = [x[rows].tobytes() for x in moved["table"]]
            changes.append((block, used[rows].tobytes() + b"".join(of_table)))
        return pa.RecordBatch.from_pylist([{"block": b, "part": part, "n": n, "change": c} for b, c in changes], schema)

    part, own, seen, used, n, numbered, rng = None, None, None, None, 0, Numbered(), None
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part:
                if part is not None:
                    used |= numbered.learn(own, seen, share, passes, rng)
                    yield finished(part, own, seen, used, n)
                part, n, numbered, used = row["part"], 0, Numbered(), np.zeros(ROWS, bool)
                own, seen = cloudpickle.loads(cloudpickle.dumps((network, state)))
                rng = np.random.default_rng([SEED, part])
            if numbered.chars + len(row["text"]) > HELD_CHARS and numbered.texts:
                used |= numbered.learn(own, seen, share, passes, rng)
                numbered = Numbered()
            numbered.add(words_of(row["text"]), row["toxic"])
            numbered.chars += len(row["text"])
            n += 1
    if part is not None:
        used |= numbered.learn(own, seen, share, passes, rng)
        yield finished(part, own, seen, used, n)


def averaged(key, changes: pd.DataFrame) -> pd.DataFrame:
    """Mean change of a block over the parts, by their documents; of a row of the table over the parts that use it."""
    total = weights = 0
    for n, change in changes.sort_values("part")[["n", "change"]].itertuples(index=False):
        if key[0] < 0:
            moved, weight = np.frombuffer(change, np.float32), float(n)
        else:
            size = len(change) // (1 + 8 * SIZE)
            weight = np.frombuffer(change, bool, size).astype(np.float64) * n
            moved = np.frombuffer(change, np.float32, offset=size).reshape(2, size, SIZE)
            weight = np.broadcast_to(weight[None, :, None], (2, size, 1))
        total, weights = total + weight * moved, weights + weight
    mean = (total / np.where(weights > 0, weights, 1)).astype(np.float32)
    used = (weights > 0).astype(np.uint8)[0].tobytes() if key[0] >= 0 else b""
    return pd.DataFrame({"block": [key[0]], "change": [used + mean.tobytes()]})


def train(rows: DataFrame, chars: int, share: float) -> Network:
    """A network fitted to all of ``rows`` (text, toxic, doc_id)."""
    parts = -(-max(1, chars) // PART_CHARS)
    passes = min(PASSES, max(ROUNDS, -(-LEARNED_CHARS // max(1, chars)))) if parts == 1 else 1
    network, used = Network(), np.zeros(ROWS, bool)
    state = fresh_state(network)
    # As many blocks as parts: what meets in averaging has the same size for any number of them.
    blocks = min(parts, ROWS)
    rounds = 1 if parts == 1 else ROUNDS
    spread = F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED)).alias("spread")
    rows = rows.select(dealt(rounds, 3).alias("round"), dealt(parts, 2).alias("part"), spread, "text", "toxic")
    for number in range(rounds):
        before = (network, state)
        own = rows.filter(F.col("round") == number).select("part", "spread", "text", "toxic")
        own = own.repartition(parts, "part").sortWithinPartitions("part", "spread", "text").drop("spread")

        def of(batches: Iterator[pa.RecordBatch], before=before) -> Iterator[pa.RecordBatch]:
            return learned_apart(batches, *before, share, passes, blocks)

        changes = own.mapInArrow(of, "block int, part int, n long, change binary")
        found = saved(changes.groupBy("block").applyInPandas(averaged, "block int, change binary"), "toxic-round").collect()
        network, state = cloudpickle.loads(cloudpickle.dumps(before))
        of_block = np.array_split(np.arange(ROWS), blocks)
        for block, change in found:
            if block < 0:
                at = 0
                for name in PARAMETERS[1:]:
                    for value in (getattr(network, name), state[name]):
                        value += np.frombuffer(change, np.float32, value.size, at).reshape(value.shape)
                        at += value.nbytes
            else:
                here = of_block[block]
                used[here] |= np.frombuffer(change, bool, len(here))
                moved = np.frombuffer(change, np.float32, offset=len(here)).reshape(2, len(here), SIZE)
                network.table[here] += moved[0]
                state["table"][here] += moved[1]
    # Rows that no word uses say nothing.
    network.table[~used] = 0
    return network


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from all labelled documents outside the held-out fold."""
    rows = saved(labelled(docs, labels), "labelled")
    counts = rows.groupBy("apart", "toxic").agg(F.count("*"), F.sum(F.length("text"))).collect()
    number = {(apart, toxic): n for apart, toxic, n, _ in counts}
    toxic, every = sum(n for (_, y), n in number.items() if y), sum(number.values())
    if toxic in (0, every):
        return Model(float(toxic > 0) if every else 0.5)
    # Without three of each class to calibrate by, or without both to learn from, all are learned from.
    apart = min(number.get((True, y), 0) for y in (0, 1)) >= 3 and all((False, y) in number for y in (0, 1))
    share = number[False, 1] / (number[False, 0] + number[False, 1]) if apart else toxic / every
    chars = sum(size for held, _, _, size in counts if not (apart and held))
    model = Model(toxic / every, train(rows.filter("not apart") if apart else rows, chars, share))
    if apart:
        calibrate(model, rows.filter("apart"))
    model.forget()
    return model


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (text, maybe lang, and any other columns) with ``_score``, ``_predicted``,
    ``_lang_threshold`` and ``_flagged`` (by that threshold) in place of the text."""
    rest = [c for c in docs.columns if c != "text"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(np.round(model.scores(batch.column("_text").to_pylist()), 9), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), scores], ["_doc", "_score"])

    packed = docs.select(F.struct(*rest).alias("_doc"), text_of().alias("_text"))
    schema = T.StructType([packed.schema["_doc"], T.StructField("_score", T.DoubleType())])
    found = packed.mapInArrow(of, schema)
    own = F.lit(threshold)
    if "lang" in rest:
        for lang, value in sorted(model.thresholds.items()):
            own = F.when(F.col("_doc.lang") == lang, F.lit(value)).otherwise(own)
    found = found.select("_doc", "_score", (F.col("_score") >= threshold).cast("int").alias("_predicted"), own.alias("_lang_threshold"))
    found = found.withColumn("_flagged", (F.col("_score") >= F.col("_lang_threshold")).cast("int"))
    return found.select("_doc.*", "_score", "_predicted", "_lang_threshold", "_flagged")
