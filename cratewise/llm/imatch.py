"""I-Match fingerprints over randomised lexicon subsets, in DataFrame operations.

The lexicon has the terms whose share of distinct texts lies within a band, so
that copies of a text, however many, don't move its terms out of it. A term's hash
puts it into one of several subsets of falling density, or into none; the sorted
distinct terms that a document has of a subset are hashed to one part of its
fingerprint. Dense subsets serve short documents, thin ones long documents. A
document with no term of the lexicon is fingerprinted over the subsets' shares of
all its terms, and one without such terms over all of them.

A band bounds the lexicon: were there more than (mean distinct terms) / (least
share) terms, their texts would add up to more than there are. That is why the
lexicon, and nothing else, is sent to all tasks.

Cases: null and empty texts have the fingerprint of no terms; rows with one
doc_id are ordered by the hash of their texts; rows without doc_id come last; one
row alone follows itself; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cratewise.llm.common import BLANKS, saved, text_of

#: Least and greatest share of distinct texts that a term of the lexicon may have.
BAND = (0.0005, 0.05)
#: Subsets: four of each density, from 1/16 down to 1/2048.
DENSITIES = tuple(1 / 2**level for level in range(4, 12) for _ in range(4))
PART = 6  # hex digits of one subset's hash
#: Characters to a block of neighbouring documents, and cells that ids are counted in.
BLOCK_CHARS, CELLS = 4_000_000, 65_536


def terms(text: Column) -> Column:
    """Distinct lower-case terms, hashed; blanks alone give none."""
    words = F.array_remove(F.array_distinct(F.split(F.lower(text), BLANKS)), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def could(term: Column) -> Column:
    """Whether a term's hash puts it into any subset."""
    return F.shiftrightunsigned(term, 11) < int(sum(DENSITIES) * (1 << 53))


def subset_of(term: Column) -> Column:
    """Number of the subset that a term's hash puts it into; null for none."""
    at = F.shiftrightunsigned(term, 11).cast("double") / float(1 << 53)
    edge, found = 0.0, None
    for number, share in enumerate(DENSITIES):
        edge += share
        found = F.when(at < edge, number) if found is None else found.when(at < edge, number)
    return found


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """``term`` and ``subset`` of the terms within the band that belong to a subset.

    Texts are told apart by two hashes, and the rows of one text meet as one row
    per task: a text that fills a third of the table is no heavier than another.
    """
    own = F.filter(terms(text_of()), could).alias("terms")
    distinct = docs.select(F.xxhash64(text_of()).alias("one"), F.hash(text_of()).alias("two"), own).groupBy("one", "two").agg(F.first("terms").alias("terms"))
    each = distinct.select(F.explode(F.concat(F.array(F.lit(None).cast("long")), "terms")).alias("term"))
    # The row without a term counts the texts; a term of one text says nothing of likeness.
    counted = saved(each.groupBy("term").agg(F.count("*").alias("texts")).filter("term is null or texts > 1"), "term-texts")
    every = counted.filter("term is null").first()
    texts = every["texts"] if every else 0
    kept = counted.filter(F.col("term").isNotNull() & F.col("texts").between(max(2.0, band[0] * texts), max(2.0, band[1] * texts)))
    return kept.select("term", subset_of(F.col("term")).alias("subset"))


def with_print(rows: DataFrame, name: str, found: str, own: str, everything: str) -> DataFrame:
    """Adds fingerprint ``name`` in place of its inputs.

    ``found``: sorted (subset, term) of the lexicon; ``own``: the terms of any
    subset, used where none is of the lexicon; ``everything``: the hash of all.
    """
    drawn = F.array_sort(F.transform(own, lambda t: F.struct(subset_of(t).alias("subset"), t.alias("term"))))
    rows = rows.withColumn("_some", F.when(F.size(found) == 0, drawn).otherwise(F.col(found)))
    # Quarters first, so that a subset's terms are looked for among a few.
    quarter = len(DENSITIES) // 4
    within = lambda n: F.filter("_some", lambda t: F.floor(t["subset"] / quarter) == n)
    rows = rows.select("*", *[within(n).alias(f"_some{n}") for n in range(4)])

    def part(number: int) -> Column:
        of_subset = F.transform(F.filter(f"_some{number // quarter}", lambda t: t["subset"] == number), lambda t: t["term"])
        hashed = F.greatest(F.xxhash64(of_subset).bitwiseAND(F.lit(16**PART - 1).cast("long")), F.lit(1).cast("long"))
        # No part of a subset with terms is all zeros.
        return F.when(F.exists(f"_some{number // quarter}", lambda t: t["subset"] == number), F.lower(F.lpad(F.hex(hashed), PART, "0"))).otherwise("0" * PART)

    whole = F.concat(F.lit("-"), F.lower(F.lpad(F.hex(everything), 16, "0")))
    parts = F.concat(*[part(number) for number in range(len(DENSITIES))])
    rows = rows.withColumn(name, F.when(F.size("_some") == 0, whole).otherwise(parts))
    return rows.drop("_some", *[f"_some{n}" for n in range(4)], found, own, everything)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal parts among the subsets of which either document has terms (0 to 1)."""
    numbers = F.sequence(F.lit(0), F.lit(len(DENSITIES) - 1))
    part = lambda c, n: F.substring(c, n * PART + 1, F.lit(PART))
    none = F.lit("0" * PART)
    some = F.size(F.filter(numbers, lambda n: (part(a, n) != none) | (part(b, n) != none)))
    same = F.size(F.filter(numbers, lambda n: (part(a, n) != none) & (part(a, n) == part(b, n))))
    short = a.startswith("-") | b.startswith("-")
    return F.when(a == b, 1.0).when(short, 0.0).otherwise(F.when(some > 0, same / some).otherwise(0.0))


def blocks(docs: DataFrame, block_chars: int) -> tuple[DataFrame, Column]:
    """Blocks of neighbouring ids (cell, block, the block's largest id, the block before), and a row's cell.

    Ids are counted in CELLS cells of equal width (and one for null), whose number
    is fixed, and cells are put together to blocks of about ``block_chars``.
    """
    ends = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low = ends["low"] or 0
    width = max(1, ((ends["high"] or 0) - low) // CELLS + 1)
    cell = F.coalesce(F.floor((F.col("doc_id") - low) / width), F.lit(-1)).cast("long")
    counted = docs.groupBy(cell.alias("cell")).agg(F.sum(F.length(text_of())).alias("chars"), F.max("doc_id").alias("top"))
    # A table of CELLS + 1 rows at most, in falling order of ids.
    falling = W.orderBy(F.col("cell").desc())
    placed = counted.withColumn("block", F.floor(F.coalesce(F.sum("chars").over(falling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) / block_chars))
    placed = placed.withColumn("block", F.dense_rank().over(W.orderBy("block")) - 1)
    tops = placed.groupBy("block").agg(F.max("top").alias("top"))
    last = F.max("block").over(W.partitionBy())
    tops = tops.withColumn("before", F.when(F.col("block") == 0, last).otherwise(F.col("block") - 1))
    table = placed.select("cell", "block").join(F.broadcast(tops), "block")
    return saved(table.select(F.col("cell").alias("_cell"), "block", "top", "before"), "blocks"), cell


def with_next(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id``, ``text``, ``next`` (the text after it in falling order of doc_id) and ``block``, ``place`` within it.

    A block's first document also goes to the block before it, whose last one it
    follows: texts are dealt out once, by block.
    """
    table, cell = blocks(docs, block_chars)
    rows = docs.select("doc_id", text_of().alias("text"), cell.alias("cell")).join(F.broadcast(table), F.col("cell") == F.col("_cell"))
    home = F.struct(F.col("block").alias("block"), F.lit(False).alias("guest"))
    away = F.struct(F.col("before").alias("block"), F.lit(True).alias("guest"))
    is_top = F.col("doc_id").eqNullSafe(F.col("top"))
    where = F.when(is_top, F.array(home, away)).otherwise(F.array(home))
    dealt = rows.select("doc_id", "text", F.inline(where))
    order = W.partitionBy("block").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    followed = dealt.select("*", F.lead("text").over(order).alias("next"), F.row_number().over(order).alias("place"))
    return followed.filter("not guest").drop("guest")


def edited(text: Column, following: Column) -> Column:
    """``text`` whose last third gives way to as much of the start of the following text."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(following, F.lit(1), third))


def fingerprints(docs: DataFrame, band: tuple[float, float] = BAND, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document: n_chars, edited_sha256, fingerprint, edited_fingerprint, and its block and place."""
    chosen = F.broadcast(saved(lexicon(docs, band), "lexicon").select(F.col("term").alias("_term"), "subset"))
    own = with_next(docs, block_chars).withColumn("edited", edited(F.col("text"), F.col("next")))
    own = own.select(
        "block", "place",
        F.struct("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256")).alias("about"),
        terms(F.col("text")).alias("own"),
        terms(F.col("edited")).alias("changed"),
    )
    own = own.select("block", "place", "about", *[
        F.struct(F.xxhash64(F.array_sort(name)).alias("everything"), F.filter(name, could).alias("terms")).alias(name) for name in ("own", "changed")
    ])
    # Each text's terms after a row of null that alone carries the rest, and keeps texts without terms.
    nothing = F.array(F.lit(None).cast("long"))
    both = F.array(*[
        F.struct(F.lit(side).alias("side"), F.struct("about", F.col(name).alias("of")).alias("rest"), F.concat(nothing, F.col(name)["terms"]).alias("terms"))
        for side, name in enumerate(("own", "changed"))
    ])
    each = own.select("block", "place", F.inline(both)).select("block", "place", "side", "rest", F.explode("terms").alias("term"))
    each = each.withColumn("rest", F.when(F.col("term").isNull(), F.col("rest")))
    found = each.join(chosen, F.col("term") == F.col("_term"), "left").filter("term is null or subset is not null")
    pair = F.when(F.col("subset").isNotNull(), F.struct("subset", "term"))
    of_side = lambda side, value: F.when(F.col("side") == side, value)
    gathered = found.groupBy("block", "place").agg(
        F.max(of_side(0, F.col("rest"))).alias("rest"),
        F.max(of_side(1, F.col("rest.of"))).alias("changed"),
        F.array_sort(F.collect_list(of_side(0, pair))).alias("found"),
        F.array_sort(F.collect_list(of_side(1, pair))).alias("found_edited"),
    )
    gathered = gathered.select(
        "block", "place", "rest.about.*", "found", "found_edited",
        F.col("rest.of.terms").alias("own"), F.col("rest.of.everything").alias("all_own"),
        F.col("changed.terms").alias("changed"), F.col("changed.everything").alias("all_changed"),
    )
    printed = with_print(gathered, "fingerprint", "found", "own", "all_own")
    return with_print(printed, "edited_fingerprint", "found_edited", "changed", "all_changed")


def compared(spark: SparkSession, docs: DataFrame, band: tuple[float, float] = BAND, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Fingerprints with the likeness to the edited text's and to the next document's."""
    docs = docs.select("doc_id", "text")
    found = saved(fingerprints(docs, band, block_chars), "imatch")
    # A block's last row is followed by the first of the next block that has rows, the very last by the first.
    first = found.filter("place = 1").select(F.col("block"), F.col("fingerprint").alias("first"))
    ends = first.agg(F.max("block")).first()[0]
    before = F.when(F.col("block") == 0, F.lit(ends)).otherwise(F.col("block") - 1)
    first = first.select(before.alias("block"), "first")
    within = W.partitionBy("block").orderBy("place")
    followed = found.withColumn("following", F.lead("fingerprint").over(within)).join(first, "block", "left")
    following = F.coalesce("following", "first")
    return followed.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), following).alias("near_next"),
    )
