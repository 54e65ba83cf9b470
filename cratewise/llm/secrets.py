"""Secret scan with a trigram inverted index, in DataFrame operations.

Each rule's expression gives a Boolean query over trigrams. The index has, for
every trigram that some query asks for, the rows whose text holds it. Postings
are intersected per row, the rows that satisfy a rule's query are joined with
their texts, and the expression itself decides. Rules without mandatory trigrams
go through every text.

Cases: null and empty texts have no spans; a text of very many matches takes time
in proportion to them; rows alike in id and text share one
entry of the index; a null doc_id is kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.llm.common import saved, text_of
from cratewise.llm.trigrams import query


@dataclass(frozen=True)
class Rule:
    """A kind of secret: what to look for, and what a match must satisfy to count.

    ``least`` is the least length of group ``group`` (0: the whole match) of a match.
    """

    kind: str
    expression: str
    group: int = 0
    least: int = 1


#: The three base kinds, in the order of their columns.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Runs of hex digits are maximal, so the length may stand in the expression.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Public formats of issued keys.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("url", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,100}:[^\s:/@]{1,100}@"),
)


SPANS = "array<struct<start:int,end:int,kind:string>>"
#: Matches that are laid out from one start.
CHUNK = 64


def row_key() -> Column:
    """Rows with equal keys share postings, which at worst makes a text be looked at in vain."""
    return F.xxhash64("doc_id", "text")


def postings(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The index: (trigram, key) for every trigram that a rule's query asks for."""
    asked = sorted({t for r in rules for one in query(r.expression) or () for t in one})
    lowered = F.translate(text_of(), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = docs.select(row_key().alias("key"), lowered.alias("text"))
    held = F.array_compact(F.array(*[F.when(F.contains("text", F.lit(t)), F.lit(t)) for t in asked]))
    return rows.select(F.explode(held).alias("trigram"), "key")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, kinds): the rules whose query a row's postings satisfy."""
    wanted = {r.kind: query(r.expression) for r in rules}
    asked = sorted({t for q in wanted.values() for one in q or () for t in one})
    bit = {t: F.lit(1 << (i % 62)).cast("long") for i, t in enumerate(asked)}
    word = {t: i // 62 for i, t in enumerate(asked)}
    masks = []
    for number in range(len(asked) // 62 + 1):
        own = F.lit(0).cast("long")
        for t in asked:
            if word[t] == number:
                own = F.when(F.col("trigram") == t, bit[t]).otherwise(own)
        masks.append(F.bit_or(own).alias(f"mask{number}"))
    # Each posting is one bit; a row's postings meet in one figure, before and after the shuffle.
    met = index.groupBy("key").agg(*masks)
    kinds = []
    for r in rules:
        holds = F.lit(False)
        for one in wanted[r.kind] or ():
            every = F.lit(True)
            for number in range(len(masks)):
                need = sum(1 << (asked.index(t) % 62) for t in one if word[t] == number)
                every = every & (F.col(f"mask{number}").bitwiseAND(F.lit(need).cast("long")) == need)
            holds = holds | every
        kinds.append(F.when(holds, F.lit(r.kind)))
    return met.select("key", F.array_compact(F.array(*kinds)).alias("kinds")).filter(F.size("kinds") > 0)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value worked out once: what a lambda holds of the outside is worked out anew for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def laid_out(sizes: Column, start: Column, kind: str) -> Column:
    """Spans of a few (gap, size), the first gap at ``start``."""
    begin = F.struct(start.alias("at"), F.array().cast(SPANS).alias("list"))

    def add(state, one):
        low = state["at"] + one["gap"]
        high = low + one["size"]
        span = F.struct(low.alias("start"), high.alias("end"), F.lit(kind).alias("kind"))
        return F.struct(high.alias("at"), F.concat(state["list"], F.array(span)).alias("list"))

    return F.aggregate(sizes, begin, add, lambda state: state["list"])


def chunk_starts(chunks: Column) -> Column:
    """Where each chunk begins: the sum of the sizes of those before it."""
    length = lambda chunk: F.aggregate(chunk, F.lit(0), lambda n, one: n + one["gap"] + one["size"])
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("list"))
    add = lambda state, n: F.struct((state["at"] + n).alias("at"), F.concat(state["list"], F.array(state["at"])).alias("list"))
    return F.aggregate(F.transform(chunks, length), begin, add, lambda state: state["list"])


def spans(rule: Rule, text: Column) -> Column:
    """Array of (start, end, kind) of a rule's matches, in code points.

    The text between matches and the matches follow each other, so a match
    starts where the lengths of all before it end. A list that grows by one is
    copied each time, so matches are laid out in chunks, each from its own start:
    the copies are then CHUNK / 2 to a match, not half of all matches.
    """
    found = F.regexp_extract_all(text, F.lit(rule.expression), F.lit(0))
    between = F.split(text, rule.expression, -1)
    tested = F.regexp_extract_all(text, F.lit(rule.expression), F.lit(rule.group))
    sizes = F.zip_with(between, found, lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("size")))
    sizes = F.filter(sizes, lambda one: one["size"].isNotNull())
    numbers = lambda some: F.sequence(F.lit(0), F.floor((F.size(some) - 1) / CHUNK).cast("int"))
    cut = lambda some: F.transform(numbers(some), lambda n: F.slice(some, n * CHUNK + 1, F.lit(CHUNK)))
    place = lambda chunks: F.flatten(F.zip_with(chunks, chunk_starts(chunks), lambda c, at: laid_out(c, at, rule.kind)))
    many = lambda some: bound(cut(some), place)
    every = bound(sizes, lambda some: F.when(F.size(some) <= CHUNK, laid_out(some, F.lit(0), rule.kind)).otherwise(many(some)))
    long_enough = F.zip_with(every, tested, lambda span, match: F.when(F.length(match) >= rule.least, span))
    return F.array_compact(long_enough)


def scanned(docs: DataFrame, base: tuple[Rule, ...] = BASE, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """doc_id with the spans of each base kind and of the further kinds, as arrays of (start, end, kind)."""
    rules = (*base, *more)
    indexed = tuple(r for r in rules if query(r.expression) is not None)
    docs = docs.select("doc_id", "text")
    index = saved(postings(docs, indexed), "postings")
    asked = saved(candidates(index, indexed), "secret-candidates")
    rows = docs.withColumn("key", row_key()).join(asked.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"), "left")
    rows = rows.select("doc_id", text_of().alias("text"), "kinds")
    none = F.array().cast(SPANS)
    columns = []
    for r in rules:
        if r in indexed:
            look = F.coalesce(F.array_contains("kinds", r.kind), F.lit(False))
        else:
            look = F.regexp_like("text", F.lit(r.expression))
        columns.append(F.when(look, spans(r, F.col("text"))).otherwise(none).alias(r.kind))
    return rows.select("doc_id", *columns)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def in_order(kinds: list[str], columns: list[str]) -> Column:
    """All spans of the columns by start, then by the order of ``kinds``."""
    place = lambda s: F.array_position(F.array(*[F.lit(k) for k in kinds]), s["kind"])
    keyed = F.transform(F.concat(*[F.col(c) for c in columns]), lambda s: F.struct(s["start"].alias("start"), place(s).alias("place"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(keyed)
