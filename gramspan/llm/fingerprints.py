"""Document fingerprints: a Merkle tree over sections, paragraphs and leaves.

A text is cut, without loss, into sections (after each blank line), these
into paragraphs (lines with their line break) and these into leaves: runs of words up to
one that ends in certain letters, so that an insertion changes the leaf that it
falls into and no other. A paragraph's digest is the SHA-256 of its bytes' digest and its
leaves' hashes, a section's that of its paragraphs' digests, and the
fingerprint is the root over the sections' digests. Equal texts have equal
roots; where roots differ, only differing branches need to be followed to the
edit. The likeness of two fingerprints is that of their trees' leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramspan.plans.ordering import with_row_index

# A leaf ends with a word that ends so, or with the paragraph, or after so many code points.
LEAF_ENDS, LEAF = "[dens][.,;:!?]*[ \\t]+", 64


def _joined_digest(digests: Column, level: str) -> Column:
    """Digest of an inner node; the level keeps a node from passing for another kind."""
    return F.sha2(F.concat(F.lit(f"{level}:"), F.array_join(digests, ",")), 256)


def leaves(paragraph: Column) -> Column:
    """Hashes of the leaves of a paragraph, in order."""
    rule = rf"[^\n]{{1,{LEAF}}}?(?:{LEAF_ENDS}|\n|$)|[^\n]{{1,{LEAF}}}\n?|\n"
    return F.transform(F.regexp_extract_all(paragraph, F.lit(rule), F.lit(0)), lambda x: F.hash(x))


def tree(text: Column) -> Column:
    """Section by section, the ``digest`` and ``leaves`` of each paragraph."""
    sections = F.split(text, r"(?<=\n\n)", -1)
    lines = lambda s: F.regexp_extract_all(s, F.lit(r"[^\n]*\n|[^\n]+"), F.lit(0))
    cut = lambda p: F.struct(F.sha2(p, 256).alias("whole"), leaves(p).alias("leaves"))
    below = lambda x: F.concat(x["whole"], F.lit(":"), F.array_join(F.transform(x["leaves"], F.hex), ","))
    named = lambda x: F.struct(_joined_digest(F.array(below(x)), "paragraph").alias("digest"), x["leaves"].alias("leaves"))
    return F.transform(sections, lambda s: F.transform(F.transform(lines(s), cut), named))


def branches(nodes: Column) -> Column:
    """The digests of the paragraphs, section by section."""
    return F.transform(nodes, lambda s: F.transform(s, lambda p: p["digest"]))


def section_digests(branch: Column) -> Column:
    return F.transform(branch, lambda s: _joined_digest(s, "section"))


def root(branch: Column) -> Column:
    """The fingerprint: 64 hexadecimal digits."""
    return _joined_digest(section_digests(branch), "root")


def leaf_set(nodes: Column) -> Column:
    """Distinct hashes of the leaves of a tree."""
    return F.array_distinct(F.flatten(F.flatten(F.transform(nodes, lambda s: F.transform(s, lambda p: p["leaves"])))))


def likeness(a: Column, b: Column, same: Column) -> Column:
    """Share of common leaves, 1 for equal roots and 0 for nothing in common."""
    both = F.size(a) + F.size(b)
    common = 2.0 * F.size(F.array_intersect(a, b))
    return F.when(same, 1.0).when(both == 0, 0.0).otherwise(common / both)


def first_difference(a: Column, b: Column) -> Column:
    """``section, paragraph`` (from 1) where two trees first differ; null if they don't."""
    differ = lambda x, y: F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False).cast("int")
    at = differ(section_digests(a), section_digests(b))
    none = F.array().cast("array<string>")
    inside = differ(F.coalesce(F.get(a, at - 1), none), F.coalesce(F.get(b, at - 1), none))
    return F.when(at > 0, F.struct(at.alias("section"), inside.alias("paragraph")))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row, its edited text and the likeness to it and to the next.

    The edited text has its last half replaced by as much of the beginning of
    the next document in descending ``doc_id`` (of the first after the last).
    Rows without doc_id come last; rows that share one follow each other in the
    order of a hash of their texts, equal rows one after another. A null text is empty.
    Extra columns are ignored; a single document is its own next one.
    """
    key = ["bare", "id", "a", "b"]
    text = F.coalesce(F.col("text"), F.lit(""))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # One shuffle of the texts: what follows joins on the columns that they are grouped by. Both joins
    # use all columns of ``one``; a column that only one of them needs would make Spark group the texts twice.
    rows = known.select(
        F.col("doc_id").isNull().alias("bare"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.xxhash64("text").alias("a"),
        F.xxhash64("text", F.lit(7)).alias("b"),
        "text",
    )
    one = rows.groupBy(*key).agg(F.min("text").alias("text"))
    sizes = rows.select(*key, F.char_length("text").alias("most")).groupBy(*key)
    keys = sizes.agg(F.max("most").alias("most"), F.count(F.lit(1)).alias("copies"))
    keys = keys.withColumn("known", ~F.col("bare"))
    place = with_row_index(keys, ["known", "id", "a", "b"], "place").drop("known")
    n = place.agg(F.coalesce(F.max("place") + 1, F.lit(1))).head()[0]
    of = [F.col(c).alias(f"of_{c}") for c in key]
    after = place.select(((F.col("place") + n - 1) % n).alias("place"), *of, "most", "copies")
    pairs = place.drop("most", "copies").join(after, "place").drop("place")

    # What a document needs of the next one: no more text than it can take over, and the leaves.
    nexts = one.join(pairs, key).select(
        *[F.col(f"of_{c}").alias(c) for c in key],
        "copies",
        F.substring("text", 1, F.floor(F.col("most") / 2).cast("int")).alias("head"),
        tree(F.col("text")).alias("nodes"),
    )
    heads = nexts.select(
        *key,
        "copies",
        "head",
        leaf_set(F.col("nodes")).alias("next_leaves"),
        root(branches(F.col("nodes"))).alias("next_root"),
    )
    half = F.floor(F.char_length("text") / 2).cast("int")
    each = one.join(heads, key).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    # An equal row is the next one of all equal rows but the last.
    again = F.col("copy") < F.col("copies")
    begin = F.substring(F.when(again, F.col("text")).otherwise(F.col("head")), F.lit(1), half)
    edited = each.select(
        F.when(~F.col("bare"), F.col("id")).alias("doc_id"),
        "text",
        F.char_length("text").cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), F.char_length("text") - half), begin).alias("edited"),
        again.alias("again"),
        "next_leaves",
        "next_root",
    )
    trees = edited.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        tree(F.col("text")).alias("nodes"),
        tree(F.col("edited")).alias("edited_nodes"),
        "again",
        "next_leaves",
        "next_root",
    )
    branched = trees.select(
        "*",
        branches(F.col("nodes")).alias("branch"),
        branches(F.col("edited_nodes")).alias("edited_branch"),
        leaf_set(F.col("nodes")).alias("leaves"),
        leaf_set(F.col("edited_nodes")).alias("edited_leaves"),
    ).drop("nodes", "edited_nodes")
    rooted = branched.select(
        "*",
        root(F.col("branch")).alias("fingerprint"),
        root(F.col("edited_branch")).alias("edited_fingerprint"),
        first_difference(F.col("branch"), F.col("edited_branch")).alias("edit"),
    )
    near = lambda other, same: likeness(F.col("leaves"), F.col(other), same)
    return rooted.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        near("edited_leaves", F.col("fingerprint") == F.col("edited_fingerprint")).alias("near_edited"),
        near("next_leaves", F.col("again") | (F.col("fingerprint") == F.col("next_root"))).alias("near_next"),
        F.col("edit.section").alias("edit_section"),
        F.col("edit.paragraph").alias("edit_paragraph"),
    )
