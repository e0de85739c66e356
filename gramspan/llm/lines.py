"""Line deduplication by a log-template tree of fixed depth.

A line's place in the tree is its token count and its first ``DEPTH`` tokens,
with variable tokens (those with a digit, ``@`` or ``://``) as one wildcard.
Inside a leaf, a token is constant where at least ``min_docs`` documents have
it at the same position; everything else is a variable field. As values of
fields reach ``min_docs`` too when the input grows, a line is also read with
twice, four times, ... as many: of the sets of tokens that are constant at one
of these bounds and still make up enough of the line, the smallest, by
position, is its template. A template that recurs in ``min_docs`` documents is
boilerplate: its first line stays, the others go. A line without a template,
such as one of mostly numbers, is compared as a whole. A long line that is equal
to the letter is no form with fields but a passage: ``long_docs`` documents are enough.

Unlike a parser that reads lines in order, the leaf is generalised from counts,
so the result does not depend on the order of rows and every step is a
pre-aggregated shuffle on hashes; equal lines are one row from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gramspan.llm.common import stored
from gramspan.llm.hashing import Block, Rolling, blocks, mix, signed

# Leading tokens that a leaf is reached by, after the token count.
DEPTH = 3
# Documents a template recurs in to be dropped.
MIN_DOCS = 10
# Documents that a line of so many words, equal to the letter, recurs in to be dropped.
LONG_DOCS, LONG_WORDS = 3, 50
# Share of the tokens after the leading ones that must be constant.
SIMILARITY = 0.6
# Share of all tokens that must be constant and literal.
LITERAL = 0.5

WILDCARD = np.uint64(0x5BF03635DEFE9AC1)
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
_DIGIT[64] = 1


class Lines:
    """The lines with tokens of a block of texts, and their places in the tree."""

    def __init__(self, body: list[bytes]):
        block = Block(body)
        block.words()
        tokens = block.word_hashes()
        marks = np.zeros(len(block.bytes) + 1, np.int64)
        odd = _DIGIT[block.bytes]
        odd[2:] |= (block.bytes[2:] == 47) & (block.bytes[1:-1] == 47) & (block.bytes[:-2] == 58)
        np.cumsum(odd, out=marks[1:])
        self.variable = marks[block.end] > marks[block.start]
        self.tokens = np.where(self.variable, WILDCARD, tokens)
        breaks = np.zeros(len(block.bytes) + 1, np.int64)
        np.cumsum(block.bytes == 10, out=breaks[1:])
        # Every text ends in one separator, so line numbers never run on.
        line = breaks[block.start]
        self.first = np.flatnonzero(np.diff(line, prepend=-1))
        self.count = np.diff(np.append(self.first, len(line)))
        self.owner = block.owner[self.first]
        self.number = line[self.first] - breaks[block.first][self.owner]
        self.key = Rolling(self.tokens).slices(self.first, self.first + self.count)
        self.same = Rolling(tokens).slices(self.first, self.first + self.count)
        node = mix(self.count.astype(np.uint64) + np.uint64(1))
        for depth in range(DEPTH):
            at = np.minimum(self.first + depth, max(len(self.tokens) - 1, 0))
            lead = self.tokens[at] if len(self.tokens) else node
            node = np.where(depth < self.count, mix(node ^ lead), node)
        self.node = node


def _keyed(docs: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("tid"), body.alias("text"))


def _line_table(docs: DataFrame) -> DataFrame:
    """``doc_id, tid, number, node, key, same, fresh, words``: a row per line with tokens.

    ``same`` is of the tokens without wildcards; ``fresh`` marks the first line
    of a document in its leaf.
    """

    def read(batches) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "tid", "number", "node", "key", "same", "fresh", "words"]
        for batch in batches:
            for part, body in blocks(batch):
                x = Lines(body)
                order = np.lexsort((x.node, x.owner))
                o, h = x.owner[order], x.node[order]
                fresh = np.ones(len(o), bool)
                fresh[order[1:]] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
                at = pa.array(x.owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(at),
                        part.column(1).take(at),
                        pa.array(x.number.astype(np.int32)),
                        signed(x.node),
                        signed(x.key),
                        signed(x.same),
                        pa.array(fresh),
                        pa.array(x.count.astype(np.int32)),
                    ],
                    names,
                )

    schema = "doc_id long, tid long, number int, node long, key long, same long, fresh boolean, words int"
    return _keyed(docs).mapInArrow(read, schema)


def _tokens_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, key, docs, place, token, variable`` of the lines that stand for all equal ones."""
    asked = wanted.groupBy("doc_id", "tid").agg(F.collect_list(F.struct("number", "docs")).alias("asked"))
    known = _keyed(docs)
    found = known.join(
        asked.select(F.col("doc_id").alias("d"), F.col("tid").alias("t"), "asked"),
        known.doc_id.eqNullSafe(F.col("d")) & (known.tid == F.col("t")),
    )

    def read(batches) -> Iterator[pa.RecordBatch]:
        names = ["node", "key", "docs", "place", "token", "variable"]
        for batch in batches:
            for part, body in blocks(batch):
                x = Lines(body)
                asked = part.column(1).to_pylist()
                first = np.searchsorted(x.owner, np.arange(len(body)))
                rows, weight = [], []
                for i, lines in enumerate(asked):
                    last = np.searchsorted(x.owner, i, "right")
                    own = x.number[first[i] : last]
                    for line in lines:
                        rows.append(first[i] + np.searchsorted(own, line["number"]))
                        weight.append(line["docs"])
                rows = np.array(rows, np.int64)
                count = x.count[rows]
                place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                at = np.repeat(x.first[rows], count) + place
                yield pa.RecordBatch.from_arrays(
                    [
                        signed(np.repeat(x.node[rows], count)),
                        signed(np.repeat(x.key[rows], count)),
                        pa.array(np.repeat(np.array(weight, np.int64), count)),
                        pa.array(place.astype(np.int32)),
                        signed(x.tokens[at]),
                        pa.array(x.variable[at]),
                    ],
                    names,
                )

    schema = "node long, key long, docs long, place int, token long, variable boolean"
    return found.dropDuplicates(["doc_id", "tid"]).select("text", "asked").mapInArrow(read, schema)


def _repeated(lines: DataFrame, keys: list[str], min_docs: int) -> DataFrame:
    """``doc_id, tid, number`` of the lines whose ``keys`` recur in ``min_docs`` documents, but for the first."""
    recurring = (
        lines.groupBy(*keys, "doc_id", "tid")
        .agg(F.min("number").alias("number"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct("doc_id", "tid", "number")).alias("first"))
        .filter(F.col("docs") >= min_docs)
    )
    is_first = F.struct("doc_id", "tid", "number").eqNullSafe(F.col("first"))
    return lines.join(recurring, keys).filter(~is_first).select("doc_id", "tid", "number")


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, long_docs: int = LONG_DOCS) -> DataFrame:
    """``doc_id, tid, number`` of the lines that go."""
    lines = stored(_line_table(docs), "lines")
    passages = _repeated(lines.filter(F.col("words") >= LONG_WORDS), ["same"], long_docs)
    leaves = lines.groupBy("node").agg(F.count_if("fresh").alias("n")).filter(F.col("n") >= min_docs).select("node")
    lines = stored(lines.join(leaves, "node").drop("fresh", "words"), "lines-shared")
    # Equal lines are one row here; a line counts once for each document that has it.
    per_doc = lines.groupBy("node", "key", "doc_id", "tid").agg(F.min("number").alias("number"))
    equal = per_doc.groupBy("node", "key").agg(
        F.count(F.lit(1)).alias("docs"), F.min(F.struct("doc_id", "tid", "number")).alias("at")
    )
    wanted = equal.select("at.doc_id", "at.tid", "at.number", "docs")
    tokens = stored(_tokens_of(docs, wanted), "line-tokens")
    # How often min_docs doubles up to the documents that have a token at its place.
    level = F.floor(F.log2(F.col("docs_with") / min_docs)).cast("int")
    constant = (
        tokens.groupBy("node", "place", "token")
        .agg(F.sum("docs").alias("docs_with"))
        .filter(F.col("docs_with") >= min_docs)
        .select("node", "place", "token", level.alias("level"))
    )
    kept = tokens.join(constant, ["node", "place", "token"], "left").withColumn("level", F.coalesce("level", F.lit(-1)))
    lead = F.col("place") < DEPTH
    by_level = kept.groupBy("node", "key", "level").agg(
        F.bit_xor(F.xxhash64("place", "token")).alias("mark"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(~lead).alias("inner"),
        F.count_if(~F.col("variable")).alias("literal"),
    )
    line = Window.partitionBy("node", "key")
    above = line.orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shape = by_level.select(
        "node",
        "key",
        "level",
        F.bit_xor("mark").over(above).alias("template"),
        F.sum("n").over(line).alias("n"),
        F.sum("inner").over(line).alias("inner"),
        F.sum("inner").over(above).alias("inner_fixed"),
        F.sum("literal").over(above).alias("literal"),
    )
    # Of the templates that say enough of a line, the coarsest: lines that agree in a finer one agree in it too.
    known = (
        shape.filter("level >= 0")
        .filter((F.col("inner_fixed") >= F.col("inner") * SIMILARITY) & (F.col("literal") >= F.col("n") * LITERAL))
        .groupBy("node", "key")
        .agg(F.max_by("template", "level").alias("template"))
    )
    # Lines with too few words for a template recur only where they are equal, numbers and all.
    frequent = equal.filter(F.col("docs") >= min_docs).select("node", "key", F.lit(True).alias("frequent"))
    known = known.join(frequent, ["node", "key"], "full_outer").select("node", "key", "template")
    alone = F.coalesce("template", F.xxhash64("same", F.lit("equal")))
    placed = lines.join(known, ["node", "key"]).withColumn("template", alone).drop("key", "same")
    placed = stored(placed, "line-templates")
    return _repeated(placed, ["node", "template"], min_docs).unionByName(passages).distinct()


@F.pandas_udf(StringType())
def _without(text: pd.Series, gone: pd.Series) -> pd.Series:
    out = []
    for t, g in zip(text, gone, strict=True):
        if t is not None and g is not None and len(g):
            drop = set(g)
            t = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in drop)
        out.append(t)
    return pd.Series(out, dtype=object)


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, long_docs: int = LONG_DOCS) -> DataFrame:
    """``docs`` with the text that is left, and ``n_lines``, ``n_removed``.

    All rows and columns stay; only the column ``text`` changes, and columns named
    ``n_lines`` or ``n_removed``, in any case, are replaced. Lines end at
    line feeds; a line without tokens never goes. A null text stays null with 0
    lines, an empty text is one line. Rows that repeat doc_id and text count as
    one document and lose the same lines. Where several documents could come
    first, it is the one with the least doc_id (null first), then the least line.
    """
    gone = recurring_lines(docs, min_docs, long_docs).groupBy("doc_id", "tid")
    gone = gone.agg(F.collect_list("number").alias("gone"))
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("tid").alias("gone_tid"), "gone")
    added = ("n_lines", "n_removed")
    kept = [c for c in docs.columns if c.lower() not in added]
    whole = docs.select(
        F.struct(*[docs[c] for c in kept]).alias("row"),
        docs["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(docs["text"], F.lit("")).cast("binary")).alias("tid"),
    )
    joined = whole.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("tid") == F.col("gone_tid")), "left")
    text = F.col("row").getField("text")
    return joined.select(
        *[(_without(text, F.col("gone")) if c == "text" else F.col("row").getField(c)).alias(c) for c in kept],
        F.coalesce(F.regexp_count(text, F.lit("\n")) + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
