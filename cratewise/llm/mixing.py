"""Mixing sources to target weights along a time-varying curriculum.

Every source has a share of the mix and a schedule that says when in training
its words are wanted. The integral of the schedule gives the words demanded up to
any time; inverting it gives each document the time at which its words are due.
Sorting by that time is the training order. A source wanted more often than it
has words is gone through a second time.

Cases: a null source is a source of its own, last in order; null and empty texts
have no words and get no position; a null doc_id orders first among equal hashes;
rows that repeat are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.llm.common import WORD, bits_for, ranked, running_total, saved, text_of

WEIGHTS = (3, 1, 2)
#: Relative demand of a source at the start and at the end of training, linear between.
SCHEDULES = ((1.5, 0.5), (0.5, 1.5), (1.0, 1.0))
SHARE, PASSES = 1.5, 2


def words_of(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def cycled(values: tuple, place: str) -> Column:
    """The value at ``place`` in an endless repetition of ``values``."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(place) % len(values) + 1).cast("int"))


def source_targets(sized: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, share=SHARE, passes=PASSES) -> DataFrame:
    """One row per source: its size, target and schedule.

    A target stops at ``passes`` times its source; what is cut off goes to the
    others by weight, again and again until no target is above. Each round is an
    aggregate over the table of sources.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = ranked(sources, [F.col("source").asc_nulls_last()], "place")
    start, end = [cycled(tuple(s[i] for s in schedules), "place") for i in (0, 1)]
    table = placed.withColumns({"weight": cycled(weights, "place").cast("double"), "begin": start, "end": end})
    table = saved(table.withColumn("most", F.col("source_size").cast("double") * passes), "mix-sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        capped = F.col("weight") * level >= F.col("most")
        found = table.agg(
            F.count_if(capped).alias("full"),
            F.sum(F.when(capped, F.col("most"))).alias("given"),
            F.sum(F.when(~capped, F.col("weight"))).alias("weights"),
        ).first()
        if found["full"] == full or not found["weights"]:
            break
        full, level = found["full"], (share * total - (found["given"] or 0.0)) / found["weights"]
    return table.withColumn("target", F.least("most", F.col("weight") * level)).drop("most", "place")


def due_time(words: Column) -> Column:
    """Time (0 to 1) at which ``words`` of the target have been demanded.

    Demand up to t is target * (begin t + (end - begin) t^2 / 2) / ((begin + end) / 2).
    """
    part = words / F.col("target") * (F.col("begin") + F.col("end")) / 2
    slope = F.col("end") - F.col("begin")
    root = F.sqrt(F.greatest(F.lit(0.0), F.col("begin") * F.col("begin") + 2 * slope * part))
    return 2 * part / (F.col("begin") + root)  # the form without cancellation, also for slope 0


def mixed(sized: DataFrame, targets: DataFrame, passes: int = PASSES) -> DataFrame:
    """``sized`` (source, size, doc_id and more) with source_size, target, ``takes`` and ``taken``.

    ``takes`` has, for each pass that reaches the document, the words taken and
    their training position. The words of a source lie one after another in hash
    order of doc_id; its target ends in some document, of which only the words up
    to there are taken, so that a source's taken words are its target rounded down.
    """
    rows = sized.count()
    order = ["doc_id", "size"]
    placed = running_total(sized, ["source"], order, "size", "begins", bits_for(rows))
    few = F.struct(F.col("source").alias("key"), F.struct("source_size", "target", "begin", "end").alias("of"))
    placed = placed.join(targets.select(few.alias("_t")), F.col("source").eqNullSafe(F.col("_t.key")))
    placed = placed.select(*sized.columns, "begins", "_t.of.*")
    takes = []
    for number in range(passes):
        at = F.col("begins") + number * F.col("source_size")
        words = F.least(F.col("size"), F.floor("target") - at)
        take = F.struct(F.lit(number).alias("number"), words.alias("words"), due_time(at).alias("position"))
        takes.append(F.when(words > 0, take))
    placed = placed.withColumn("takes", F.array_compact(F.array(*takes)))
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda a, t: a + t["words"])
    return placed.withColumn("taken", taken).drop("begins", "begin", "end")


def mix_table(docs: DataFrame) -> DataFrame:
    """One row per document with its share of the mix, in training order, what isn't taken last."""
    sized = saved(docs.select("doc_id", "source", words_of().alias("size")), "mix-sizes")
    found = mixed(sized, source_targets(sized))
    first = F.get(F.col("takes"), 0)["position"].alias("position")
    return found.select("*", first).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def training_mix(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents of the mix in training order, one row per pass, all columns as they came.

    A document that its source's target cuts keeps its words up to there.
    """
    rows = docs.select(F.struct("*").alias("_doc"), "doc_id", "source", words_of().alias("size"))
    found = mixed(rows, source_targets(rows))
    copies = found.select("_doc", "doc_id", "size", F.explode("takes").alias("take"))
    copies = copies.select("_doc", "size", "take.*").orderBy("position", "doc_id", "number")
    whole = F.col("words") >= F.col("size")
    pieces = F.regexp_extract_all(F.col("_doc.text").cast("string"), F.lit("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+"), 0)
    cut = F.array_join(F.slice(pieces, 1, F.greatest(F.col("words"), F.lit(1)).cast("int")), "")
    text = F.when(whole, F.col("_doc.text")).otherwise(cut).alias("text")
    return copies.select(*[text if c == "text" else F.col("_doc")[c].alias(c) for c in docs.columns])
