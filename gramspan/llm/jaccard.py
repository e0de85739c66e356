"""Exact self-join of documents by Jaccard similarity of their word n-grams.

Equal sets are one node from the start. The hash range is cut into more parts
than the tokens in which two linked sets can differ, so linked sets agree in
several parts and have that many part keys in common; sizes that can be similar
meet at a level whose parts are enough for both. Of the keys that a set shares
with any other it can do without the most frequent ones, one less than linked
sets have in common: this drops common passages, and sets without near ones.

The first set of each key that is left is compared with the others. Where a key
has further sets that this leaves apart, those are searched with a signature
tree: nodes hold the OR of their sets' bitmaps and the range of their sizes, and a
traversal of node pairs goes on only where the overlap can still be large enough
and the sets are still apart. What shares such keys is cut into blocks, and pairs of
blocks are searched in different tasks. Components are formed of verified links
only, and the number of jobs does not depend on the data but for those.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gramspan.llm.common import stored, texts
from gramspan.llm.hashing import Block, Rolling, blocks, mix, signed
from gramspan.plans.components import connected_components

# Sets, and tokens of all sets, in a block that is searched against others.
SETS, TOKENS = 2_000, 1_000_000
# Members of a key up to which they are counted; more are equally frequent.
COUNTED = 1 << 20
_LEAF, _FAN = 8, 8


@dataclass(frozen=True)
class Similarity:
    """``100 * intersection >= percent * union`` over sets of ``words``-grams."""

    words: int = 5
    percent: int = 80

    def linked(self, common: int, a: int, b: int) -> bool:
        return 100 * common >= self.percent * (a + b - common)

    def least_common(self, total: int) -> float:
        """Common tokens that two linked sets with ``total`` tokens together must have."""
        return self.percent * total / (100 + self.percent)

    def size_class(self, n: np.ndarray) -> np.ndarray:
        """Linked sets are in the same class or in neighbouring ones."""
        return np.floor(np.log(np.maximum(n, 1)) / np.log(self.ratio) + 1e-9).astype(np.int64)

    @property
    def ratio(self) -> float:
        return 100 / self.percent * 1.003

    def differences(self, level: np.ndarray) -> np.ndarray:
        """Most tokens in which linked sets differ that meet at a level: of this class, or of it and the next."""
        share = (100 - self.percent) / (100 + self.percent) * (1 + 100 / self.percent)
        return np.floor(share * self.ratio ** (level + 1) * (1 + 1e-9)).astype(np.int64)

    def agreeing(self, differences: np.ndarray) -> np.ndarray:
        """Parts beyond the differences: as many are equal in linked sets."""
        return 6 + differences // 8


class Sets:
    """Distinct n-gram hashes of a block of texts, in order of text and hash."""

    def __init__(self, body: list[bytes], words: int):
        block = Block([t.lower() for t in body])
        block.words()
        rolling = Rolling(block.word_hashes())
        owner = block.owner
        n = max(len(owner) - words + 1, 0)
        whole = owner[:n] == owner[words - 1 :] if n else np.zeros(0, bool)
        grams, of = rolling.windows(words)[whole], owner[:n][whole]
        # Shorter texts are one gram; it can't equal one of full length.
        few = np.flatnonzero((block.n_words > 0) & (block.n_words < words))
        short = rolling.slices(block.word0[few], block.word0[few] + block.n_words[few])
        short = mix(short ^ block.n_words[few].astype(np.uint64))
        grams, of = np.concatenate([grams, short]), np.concatenate([of, few])
        order = np.lexsort((grams, of))
        grams, of = grams[order], of[order]
        new = np.ones(len(of), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])
        self.grams, self.owner = grams[new], of[new]
        self.size = np.bincount(self.owner, minlength=len(body)).astype(np.int64)
        self.first = np.cumsum(self.size) - self.size

    def of(self, i: int) -> np.ndarray:
        return self.grams[self.first[i] : self.first[i] + self.size[i]]

    def digest(self, i: int) -> tuple[int, int]:
        d = hashlib.blake2b(self.of(i).tobytes(), digest_size=16).digest()
        return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)

    def part_keys(self, sim: Similarity, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the parts of the chosen sets and the set of each key."""
        return self.shared_keys(sim, chosen)[:2]

    def shared_keys(self, sim: Similarity, chosen: np.ndarray) -> tuple[np.ndarray, ...]:
        """Part keys, the set of each, and two times the keys that a linked set has too, plus the level's step."""
        keys, sets, tags = [], [], []
        own = sim.size_class(self.size)
        for step in (0, 1):
            level = own - step
            d = np.where((self.size > 0) & chosen & (level >= 0), sim.differences(level), 0)
            spare = sim.agreeing(d)
            # With no difference allowed only equal sets are linked, and those are one.
            parts = np.where(d > 0, d + spare, 0)
            use = np.flatnonzero(parts[self.owner] > 0)
            if not len(use):
                continue
            h, o = self.grams[use], self.owner[use]
            p = parts[o].astype(np.uint64)
            index = ((h >> np.uint64(32)) * p) >> np.uint64(32)
            new = np.flatnonzero(np.append(True, (o[1:] != o[:-1]) | (index[1:] != index[:-1])))
            place = mix(index[new] * np.uint64(4096) + (level[o[new]] + 1).astype(np.uint64))
            filled = np.bincount(o[new], minlength=len(parts))
            # Empty parts have no key, so those that are equal in both may be missing from the common ones.
            common = spare - (parts - filled)
            tag = 2 * np.maximum(common, 1) + step
            keys.append(mix(np.add.reduceat(mix(h), new) ^ place))
            sets.append(o[new])
            tags.append(tag[o[new]])
            # If the empty parts alone could be what two sets agree on, they count as parts.
            for i in np.flatnonzero((parts > 0) & (common <= 0)):
                mine = index[new][o[new] == i].astype(np.int64)
                empty = np.setdiff1d(np.arange(parts[i]), mine).astype(np.uint64)
                keys.append(mix(mix(empty * np.uint64(4096) + np.uint64(level[i] + 1)) + np.uint64(1)))
                sets.append(np.full(len(empty), i))
                tags.append(np.full(len(empty), tag[i]))
        if not keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(keys), np.concatenate(sets), np.concatenate(tags)


def _set_rows(docs: DataFrame, sim: Similarity) -> DataFrame:
    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, body in blocks(batch):
                s = Sets(body, sim.words)
                digests = [s.digest(i) for i in range(len(body))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(s.size), *(pa.array(c, pa.int64()) for c in zip(*digests, strict=True))],
                    ["doc_id", "n", "a", "b"],
                )

    return docs.mapInArrow(read, "doc_id long, n long, a long, b long")


def _part_rows(docs: DataFrame, sim: Similarity) -> DataFrame:
    """``k, a, tag``: part keys of the different sets of each block of texts."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, body in blocks(batch):
                s = Sets(body, sim.words)
                digests = [s.digest(i) for i in range(len(body))]
                chosen = np.zeros(len(body), bool)
                chosen[list({d: i for i, d in enumerate(digests)}.values())] = True
                keys, sets, tags = s.shared_keys(sim, chosen)
                nodes = np.array([a for a, _ in digests], np.int64)[sets]
                yield pa.RecordBatch.from_arrays([signed(keys), pa.array(nodes), pa.array(tags)], ["k", "a", "tag"])

    return docs.mapInArrow(read, "k long, a long, tag long")


def _shared(rows: DataFrame) -> DataFrame:
    """``k, a, tag, n``: rows of keys with ``n`` different sets, two at least, read as a stream."""
    names = ["k", "a", "tag", "n"]

    def out(c, n):
        some = n > 1
        n = np.minimum(n[some], COUNTED)
        return pa.RecordBatch.from_arrays([*(pa.array(x[some]) for x in c), pa.array(n)], ["k", "a", "tag", "n"])

    def all_of(c, n):
        return out(c, np.full(len(c[0]), n))

    def read(batches) -> Iterator[pa.RecordBatch]:
        # The key that may go on, its rows until they are too many to be counted, and the row before.
        key, held, many, last = None, None, False, None
        for batch in batches:
            c = [x.to_numpy() for x in batch.columns]
            if not len(c[0]):
                continue
            new = np.append(True, (c[0][1:] != c[0][:-1]) | (c[1][1:] != c[1][:-1]))
            new[0] = (c[0][0], c[1][0]) != last
            last = c[0][-1], c[1][-1]
            c = [x[new] for x in c]
            if not len(c[0]):
                continue
            more = 0 if key is None else int(np.searchsorted(c[0], key, "right"))
            if more and many:
                yield all_of([x[:more] for x in c], COUNTED)
            elif more:
                held = [np.concatenate([h, x[:more]]) for h, x in zip(held, c, strict=True)]
                many = len(held[0]) >= COUNTED
                if many:
                    yield all_of(held, COUNTED)
            if more < len(c[0]):
                if key is not None and not many:
                    yield all_of(held, len(held[0]))
                tail = int(np.searchsorted(c[0], c[0][-1]))
                first = np.flatnonzero(np.diff(c[0][more:tail], prepend=c[0][more] - 1))
                sizes = np.diff(np.append(first, tail - more))
                yield out([x[more:tail] for x in c], np.repeat(sizes, sizes))
                key, held, many = c[0][-1], [x[tail:] for x in c], False
        if key is not None and not many:
            yield all_of(held, len(held[0]))

    return rows.repartition("k").sortWithinPartitions("k", "a").mapInArrow(read, "k long, a long, tag long, n long")


def _stars(rows: DataFrame) -> DataFrame:
    """``a, b``: from the least set of each key to the others, of different ``k, a``."""
    least = rows.groupBy("k").agg(F.min("a").alias("least"))
    pairs = rows.join(least, "k").filter("a != least")
    return pairs.select(F.col("least").alias("a"), F.col("a").alias("b")).distinct()


class Forest:
    """Union-find whose roots are the least members."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)

    def labels(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if (up == self.up).all():
                return up
            self.up = up


class SignatureTree:
    """Nodes over sets in a fixed order: OR of bitmaps, range of sizes, most colliding tokens.

    A set with n tokens and b bits set has at most ``n - b`` tokens more in
    common with another set than the two bitmaps have bits.
    """

    def __init__(self, sets: list[np.ndarray]):
        size = np.array([len(s) for s in sets])
        width = 1 << max(8, int(size.max()).bit_length())
        bits = np.zeros((len(sets), width // 64), np.uint64)
        owner = np.repeat(np.arange(len(sets)), size)
        at = (np.concatenate(sets) & np.uint64(width - 1)).astype(np.int64)
        np.bitwise_or.at(bits, (owner, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
        slack = size - np.bitwise_count(bits).sum(1)
        # levels[0] are the sets, the last level has one node.
        self.levels = [(bits, size, size, slack)]
        fan = _LEAF
        while len(self.levels[-1][1]) > 1:
            bits, low, high, slack = self.levels[-1]
            cut = np.arange(0, len(low), fan)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, cut),
                    np.minimum.reduceat(low, cut),
                    np.maximum.reduceat(high, cut),
                    np.maximum.reduceat(slack, cut),
                )
            )
            fan = _FAN
        self.fans = [1, _LEAF] + [_FAN] * max(len(self.levels) - 2, 0)

    def possible(self, level: int, i: np.ndarray, j: np.ndarray, sim: Similarity) -> np.ndarray:
        """Which node pairs of a level may hold linked sets."""
        bits, low, high, slack = self.levels[level]
        common = np.bitwise_count(bits[i] & bits[j]).sum(1) + np.minimum(slack[i], slack[j])
        common = np.minimum(common, np.minimum(high[i], high[j]))
        near = (low[i] * sim.percent <= high[j] * 100) & (low[j] * sim.percent <= high[i] * 100)
        return near & (common + 1e-9 >= sim.least_common(low[i] + low[j]))


def link_cluster(sets: list[np.ndarray], sim: Similarity, known: np.ndarray | None = None) -> np.ndarray:
    """For each set, the position of the first set of its component.

    Sets with equal ``known`` labels are linked from the start.
    """
    forest = Forest(len(sets))
    if known is not None:
        _, first, label = np.unique(known, return_index=True, return_inverse=True)
        forest.up = first[label]
    size = np.array([len(s) for s in sets])

    def linked(i: int, j: int) -> bool:
        return sim.linked(len(np.intersect1d(sets[i], sets[j], assume_unique=True)), size[i], size[j])

    # Near copies of one text: most sets link to the first, or to the one with the next least token.
    order = np.lexsort((size, [s[0] for s in sets]))
    for k in range(1, len(sets)):
        if forest.root(k) != forest.root(0) and linked(0, k):
            forest.join(0, k)
    for i, j in zip(order[:-1], order[1:], strict=True):
        if forest.root(i) != forest.root(j) and linked(i, j):
            forest.join(i, j)
    labels = forest.labels()
    if len(sets) < 3 or (labels == 0).all():
        return labels
    tree = SignatureTree([sets[i] for i in order])
    top = len(tree.levels) - 1
    pending = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while pending:
        level, i, j = pending.pop()
        keep = tree.possible(level, i, j, sim)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if level == 0:
            for x, y in zip(order[i], order[j], strict=True):
                if forest.root(x) != forest.root(y) and linked(x, y):
                    forest.join(x, y)
            continue
        fan, below = tree.fans[level], len(tree.levels[level - 1][1])
        a, b = np.meshgrid(np.arange(fan), np.arange(fan), indexing="ij")
        left = (i[:, None] * fan + a.ravel()).ravel()
        right = (j[:, None] * fan + b.ravel()).ravel()
        good = (left < below) & (right < below) & ((left < right) if level == 1 else (left <= right))
        left, right = left[good], right[good]
        if level == 1:
            # Pairs of one component need no comparison.
            at = forest.labels()[order]
            apart = at[left] != at[right]
            left, right = left[apart], right[apart]
        # Depth first and in slices, so that few node pairs wait at a time.
        for s in range(0, len(left), 4096):
            pending.append((level - 1, left[s : s + 4096], right[s : s + 4096]))
    return forest.labels()


def _blocks(members: DataFrame, most: int, most_tokens: int) -> DataFrame:
    """``cluster, i, j, a, label, n``: the members of each pair of blocks that can hold an unknown link.

    Blocks follow the labels, so that pairs of blocks of one and the same label fall away.
    """
    order = Window.partitionBy("cluster").orderBy("label", "a")
    upto = F.sum(F.lit(1.0 / most) + F.col("n") / float(most_tokens)).over(order)
    # Of the sum without the set itself, so that no block is left empty at the front.
    placed = members.withColumn("block", F.floor(upto - F.lit(1.0 / most) - F.col("n") / float(most_tokens)))
    blocks_ = placed.groupBy("cluster", "block").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    left, right = (blocks_.select("cluster", *(F.col(c).alias(c + s) for c in ("block", "low", "high"))) for s in "ij")
    alone = blocks_.groupBy("cluster").agg((F.count(F.lit(1)) == 1).alias("alone"))
    pairs = (
        left.join(right, "cluster")
        .join(alone, "cluster")
        .filter("blocki < blockj or (alone and blocki = blockj)")
        .filter("not (lowi = highi and lowi = lowj and lowj = highj)")
        .select("cluster", F.col("blocki").alias("i"), F.col("blockj").alias("j"))
    )
    ends = pairs.withColumn("block", F.explode(F.array_distinct(F.array("i", "j"))))
    return placed.join(ends, ["cluster", "block"]).select("cluster", "i", "j", "a", "label", "n")


def _search(members: DataFrame, sim: Similarity) -> DataFrame:
    """``a, b``: links between the sets of each pair of blocks, with those that labels tell; few."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        now, ids, labels, sets = None, [], [], []

        def solved():
            if len(sets) > 1:
                roots = link_cluster(sets, sim, np.array(labels, np.int64))
                rest = np.flatnonzero(roots != np.arange(len(roots)))
                of = np.array(ids, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(of[roots[rest]]), pa.array(of[rest])], ["a", "b"])

        for batch in batches:
            flat = batch.column(5)
            keys = zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True)
            for r, (cluster, i, j, node, label) in enumerate(keys):
                if (cluster, i, j) != now:
                    yield from solved()
                    now, ids, labels, sets = (cluster, i, j), [], [], []
                ids.append(node)
                labels.append(label)
                sets.append(flat[r].values.to_numpy().view(np.uint64))
        yield from solved()

    rows = members.select("cluster", "i", "j", "a", "label", "grams").repartition("cluster", "i", "j")
    rows = rows.sortWithinPartitions("cluster", "i", "j", "label", "a")
    return rows.mapInArrow(read, "a long, b long").distinct()


def _grams(docs: DataFrame, sim: Similarity) -> DataFrame:
    """``a, grams`` of ``doc_id, text``."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, body in blocks(batch):
                s = Sets(body, sim.words)
                nodes = pa.array([s.digest(i)[0] for i in range(len(body))], pa.int64())
                offsets = pa.array(np.append(s.first, len(s.grams)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([nodes, pa.ListArray.from_arrays(offsets, signed(s.grams))], ["a", "grams"])

    return docs.mapInArrow(read, "a long, grams array<long>")


def _verified(pairs: DataFrame, grams: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs ``a, b`` of linked sets."""
    left = grams.select("a", F.col("grams").alias("left"))
    right = grams.select(F.col("a").alias("b"), F.col("grams").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("left", "right"))
    either = F.size("left") + F.size("right") - common
    return both.filter(common * 100 >= either * sim.percent).select("a", "b")


def near_duplicates(
    docs: DataFrame, sim: Similarity | None = None, most: int = SETS, most_tokens: int = TOKENS
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs`` (``doc_id, text``).

    ``component_id`` is the least doc_id that links reach. A null or blank text
    has no shingles and no links; a text with fewer words than a shingle has its
    whole sequence as one. Rows that share a doc_id are one document for links.
    Rows without doc_id have the component of rows with equal sets, or none.
    Extra columns are ignored. ``most`` sets or about ``most_tokens`` of their
    tokens are a block; the result does not depend on them. Hashes of shingles and
    of whole sets have 64 bits.
    """
    sim = sim or Similarity()
    known = texts(docs)
    sets = stored(_set_rows(known, sim), "jaccard-sets")
    groups = sets.filter("n > 0 and doc_id is not null").groupBy("a", "b").agg(F.min("doc_id").alias("leader"))
    led = stored(sets.join(groups, ["a", "b"], "left").select("doc_id", "n", "a", "leader"), "jaccard-led")

    # Keys that a set shares with others, without the most frequent that it need not have.
    shared = stored(_shared(_part_rows(known, sim)), "jaccard-shared")
    often = Window.partitionBy("a", F.col("tag") % 2).orderBy(F.desc("n"), "k")
    rare = shared.withColumn("r", F.row_number().over(often)).filter("r >= floor(tag / 2)")
    rare = stored(rare.select("k", "a"), "jaccard-rare")
    stars = stored(_stars(rare), "jaccard-stars")

    # Sets of the nodes that are left, from one text each.
    nodes = stars.select("a").union(stars.select("b")).distinct()
    leaders = led.filter("leader = doc_id").select("a", "leader").distinct()
    inside = known.join(leaders.join(nodes, "a").select(F.col("leader").alias("doc_id")).distinct(), "doc_id", "left_semi")
    grams = stored(_grams(inside, sim).join(nodes, "a", "left_semi").dropDuplicates(["a"]), "jaccard-grams")
    found = stored(_verified(stars, grams, sim), "jaccard-found")

    # Keys with members that the first one does not tell apart from each other.
    label = found.groupBy(F.col("b").alias("a")).agg(F.min("a").alias("label"))
    least = rare.groupBy("k").agg(F.min("a").alias("least"), F.count(F.lit(1)).alias("n"))
    rest = rare.join(least.filter("n > 2"), "k").filter("a != least").join(label, "a", "left")
    rest = rest.select("k", "a", F.coalesce("label", "a").alias("label"))
    mixed = rest.groupBy("k").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    rest = stored(rest.join(mixed, "k", "left_semi"), "jaccard-rest")
    clusters = connected_components(_stars(rest)).select(F.col("node").alias("a"), F.col("label").alias("cluster"))
    size = grams.select("a", F.size("grams").alias("n"))
    members = clusters.join(rest.select("a", "label").distinct(), "a").join(size, "a")
    pairs = _blocks(stored(members, "jaccard-members"), most, most_tokens).join(grams, "a")
    links = stored(found.unionByName(_search(pairs, sim)), "jaccard-links")

    # From sets to documents; documents with several texts tie their sets.
    edges = links
    for end in ("a", "b"):
        name = leaders.select(F.col("a").alias("_a"), F.col("leader").alias("_l"))
        edges = edges.join(name, F.col(end) == F.col("_a")).drop("_a", end).withColumnRenamed("_l", end)
    several = led.filter("leader is not null and doc_id is not null")
    several = several.groupBy("doc_id").agg(F.min("leader").alias("a"), F.max("leader").alias("b")).filter("a < b")
    ties = led.join(several.select("doc_id", F.col("a").alias("low")), "doc_id").filter("leader > low")
    edges = edges.select("a", "b").unionByName(ties.select(F.col("low").alias("a"), F.col("leader").alias("b")))
    labels = connected_components(edges).select(F.col("node").alias("leader"), "label")
    return led.join(labels, "leader", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "leader", "doc_id").alias("component_id")
    )
