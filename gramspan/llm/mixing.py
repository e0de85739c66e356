"""Mixing sources to target weights by capped water-filling.

Targets are filled like connected vessels: each source gets its share by
weight, a source whose share is more than ``max_epochs`` times its size is
clamped there, and the excess is dealt out again by weight until no share is
too large. A target is then met with whole repetitions of every document and
one fractional repetition: the documents with the least seeded hash, up to the
words that are missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gramspan.llm.common import WORD, stored
from gramspan.plans.ordering import with_row_index

# Bits of a document's hash, and bits that one level of the search settles.
HASH_BITS, LEVEL_BITS, LEVELS = 40, 12, 3


def document_sizes(docs: DataFrame, seed: str) -> DataFrame:
    """``docs`` with ``size, place``: words of each document and its seeded hash, of doc_id and text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    name = F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))
    return docs.select(
        "*",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("long").alias("place"),
    )


def source_weights(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """One row per source, null last, with its size and its weight by code-point order."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    keyed = totals.select(
        F.col("source").isNull().cast("int").alias("last"), F.coalesce("source", F.lit("")).alias("name"), "source_size"
    )
    ranked = with_row_index(keyed, ["last", "name"], "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    return ranked.select(
        F.when(F.col("last") == 0, F.col("name")).alias("source"), "source_size", weight.alias("weight")
    )


def fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to sources: shares by weight that sum to ``total``, none above its cap.

    Every round is one aggregate; it raises the level and clamps what is now
    too large, so the clamped sources only grow in number.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = 0.0, -1
    while True:
        full = cap <= F.lit(level) * F.col("weight")
        r = sources.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.count_if(full).alias("n"),
        ).head()
        if r["n"] == clamped or not r["weight"]:
            break
        clamped, level = r["n"], (total - r["held"]) / r["weight"]
    return sources.withColumn("target", F.when(full, cap).otherwise(F.lit(level) * F.col("weight")))


def fractional_cut(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, cut``: documents with a lesser ``place`` get one more repetition.

    ``targets`` has the missing words as ``missing``. The cut is found by
    histograms of the hash, each within the bin of the one before where the
    running sum reaches what is missing, so no task ever sorts a source.
    """
    state = targets.select(
        F.col("source").alias("of"),
        F.lit(0).cast("long").alias("low"),
        F.col("missing"),
    ).filter("missing > 0")
    shift = HASH_BITS
    for _ in range(LEVELS):
        span, shift = shift, shift - LEVEL_BITS
        inside = sizes.join(
            state,
            sizes.source.eqNullSafe(state.of)
            & (sizes.place >= state.low)
            & (sizes.place < state.low + F.lit(1 << span)),
        )
        bins = inside.groupBy("of", "low", "missing", F.shiftright(F.col("place") - F.col("low"), shift).alias("bin")).agg(
            F.sum("size").alias("held")
        )
        order = Window.partitionBy("of").orderBy("bin")
        run = bins.withColumn("before", F.sum("held").over(order) - F.col("held"))
        state = (
            run.filter("before < missing and before + held >= missing")
            .select(
                "of",
                (F.col("low") + F.shiftleft("bin", shift)).alias("low"),
                (F.col("missing") - F.col("before")).alias("missing"),
                "held",
            )
        )
        state = stored(state, "mix-level")
    # The last bin goes in as a whole if that comes nearer to the target.
    return state.select(
        F.col("of").alias("source"),
        (F.col("low") + F.when(F.col("missing") * 2 >= F.col("held"), 1 << shift).otherwise(0)).alias("cut"),
    )


def mix_rule(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    total_ratio: float = 1.5,
    max_epochs: float = 2.0,
    seed: str = "mix-1",
) -> tuple[DataFrame, DataFrame]:
    """Sizes of the documents, and per source (``of``) its target, whole repetitions and cut."""
    named = docs.select("doc_id", "source", "text")
    sizes = stored(document_sizes(named, seed).select("doc_id", "source", "size", "place"), "mix-sizes")
    sources = source_weights(sizes, weights)
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).head()["n"]
    targets = fill(sources, total_ratio * total, max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.withColumn("whole", F.floor(ratio)).withColumn(
        "missing", F.col("target") - F.col("whole") * F.col("source_size")
    )
    targets = stored(targets.select("source", "source_size", "target", "whole", "missing"), "mix-targets")
    cuts = fractional_cut(sizes, targets)
    rule = targets.join(cuts, targets.source.eqNullSafe(cuts.source), "left").select(
        targets.source.alias("of"), "source_size", "target", "whole", "cut"
    )
    return sizes, rule


def _draw(sized: DataFrame, rule: DataFrame) -> DataFrame:
    repeats = F.col("whole") + F.when(F.col("place") < F.col("cut"), 1).otherwise(0)
    return (
        sized.join(rule, sized.source.eqNullSafe(rule.of))
        .withColumn("repeats", repeats.cast("long"))
        .withColumn("taken", F.col("repeats") * F.col("size"))
        .drop("of", "whole", "cut", "place")
    )


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """What a mix takes of each row of ``docs`` (``doc_id, source, text``).

    Returns ``doc_id, source, size, source_size, target, repeats, taken``.
    Sizes are words; a null or blank text has size 0 and takes nothing. A null
    source is a source of its own, after the others. Rows are drawn by doc_id and
    text, a null doc_id being an empty one; only rows that repeat both are taken
    together. Extra columns are ignored. Without words every target is 0. The draw
    depends on the seed and the row alone, so reruns agree. The options are
    those of ``mix_rule``.
    """
    return _draw(*mix_rule(docs, **options))


def mixed_documents(docs: DataFrame, seed: str = "mix-1", **options) -> DataFrame:
    """The mix itself: a row of ``docs`` for each time that it is taken.

    Adds ``size, source_size, target, repeats`` and ``copy``, from 1 to
    ``repeats``; columns of these names, in any case, are replaced, all others stay as they are.
    A row that is not taken is not in the mix. The text is not moved: only the small
    table of sources is joined.
    """
    _, rule = mix_rule(docs, seed=seed, **options)
    added = ("size", "source_size", "target", "repeats", "copy")
    kept = [c for c in docs.columns if c.lower() not in added]
    whole = F.struct(*[docs[c] for c in kept]).alias("row")
    sized = document_sizes(docs.select("doc_id", "source", "text", whole), seed)
    drawn = _draw(sized.select("row", "source", "size", "place"), rule).filter("repeats > 0")
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))))
    return copies.select(*[F.col("row").getField(c).alias(c) for c in kept], *added)
