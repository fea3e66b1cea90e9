"""Near-duplicate documents by a chosen-path set similarity join.

Every class of equal shingle sets has minwise tokens. In a tree, a node chooses one or
two of their positions (4/3 on average, the reciprocal of the similarity wanted) by its
own hash, and a class goes on to the child named by its token there. Similar sets stay
together on some path; small nodes are compared exhaustively on sketches, large ones
branch again. Many trees make up for pairs that a single tree parts. Where crowds branch
so deep that the trees of one round keep a pair with less than the wanted recall, their
classes get more rounds with fresh tokens. Every candidate is confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MAX_BROADCAST_ROWS, checked, in_arrow, ship, slices, stash
from .components import connected_components
from .shingles import overlap, scramble, shingle_set

TOKENS = 128
TREES = 16
#: Probability that a pair at 0.75 stays together on some path, at the depth that its classes reach.
TARGET = 0.999
#: Nodes of up to so many classes are compared exhaustively.
SMALL = 2048
#: Levels of branching after which a large node is compared in blocks instead.
DEPTH = 20
#: Share of equal sketch bytes from which a pair is a candidate: 4.4 standard deviations below 0.75.
MAYBE = 0.58
#: Share from which members of a large node count as linked to its pivot and branch no further.
SURE = 0.85

MEMBER = "node long, cls long, label long"


@cache
def pool(number: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and offsets of the ``TOKENS`` hash functions of a round."""
    rng = np.random.default_rng([20240229, number] if number else 20240229)
    multiply, add = (rng.integers(0, 2**32, TOKENS, dtype=np.uint64).astype(np.uint32) for _ in range(2))
    return multiply | np.uint32(1), add


def roots(number: int) -> np.ndarray:
    """Names of the ``TREES`` roots of a round."""
    return scramble(np.arange(1 + number * TREES, TREES + 1 + number * TREES, dtype=np.uint64) * np.uint64(0x5851F42D4C957F2D))


@cache
def recall(levels: int) -> float:
    """Probability that a pair at 0.75 shares ``levels`` branchings in some tree of a round.

    All trees draw from one pool of tokens, so they are independent only for a given
    number of tokens that agree; the result is the mean over that number."""
    agree = np.arange(TOKENS + 1) / TOKENS
    chance = np.array([math.comb(TOKENS, k) * 0.75**k * 0.25**(TOKENS - k) for k in range(TOKENS + 1)])
    alive = np.ones(TOKENS + 1)
    for _ in range(levels):
        lost = 1 - agree * alive
        alive = 1 - (2 * lost + lost**2) / 3
    return float((chance * (1 - (1 - alive)**TREES)).sum())


def rounds(levels: int) -> int:
    """Rounds of ``TREES`` trees, each with its own tokens, that reach ``TARGET``."""
    number = 1
    while 1 - (1 - recall(levels))**number < TARGET:
        number += 1
    return number


def min_tokens(shingles: np.ndarray, number: int = 0) -> np.ndarray:
    """Minwise tokens of a set under the ``TOKENS`` hash functions of a round."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    multiply, add = pool(number)
    best = np.full(TOKENS, 2**32 - 1, np.uint32)
    for at in range(0, len(low), 2048):
        best = np.minimum(best, (low[at:at + 2048, None] * multiply + add).min(axis=0))
    return best


def small_sketch(tokens: np.ndarray) -> np.ndarray:
    """One byte per token; unequal tokens agree by chance in one of 256."""
    return ((tokens * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity from sketches along the last axis."""
    return ((a == b).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


def class_number(shingles: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _binary(column: pa.Array) -> pa.Array:
    return column.cast(pa.binary())


def signatures(documents: DataFrame, key: str = "doc_id", text: str = "text", number: int = 0) -> DataFrame:
    """``(k, n_shingles, cls, tokens)`` of whole texts, tokens of one round; ``cls`` and ``tokens`` are NULL for empty sets."""
    rows = documents.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text}`").alias("t"))

    def sign(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw = _binary(batch.column(1))
        sizes, names, tokens = [], [], []
        for value in raw:
            found = shingle_set(value.as_py() or b"")
            sizes.append(len(found))
            names.append(class_number(found) if len(found) else None)
            tokens.append(min_tokens(found, number).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.array(tokens, pa.binary())],
                                         names=["k", "n_shingles", "cls", "tokens"])

    return in_arrow(rows, sign, "k long, n_shingles long, cls long, tokens binary")


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def branch(nodes: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Children of (node, token row) pairs: row numbers and child nodes."""
    choice = scramble(nodes + np.uint64(0x632BE59BD9B4E019))
    first = (choice % np.uint64(TOKENS)).astype(np.int64)
    again = np.flatnonzero((choice >> np.uint64(20)) % np.uint64(3) == 0)
    second = (first[again] + 1 + ((choice[again] >> np.uint64(40)) % np.uint64(TOKENS - 1)).astype(np.int64)) % TOKENS
    rows = np.concatenate((np.arange(len(nodes)), again))
    at = np.concatenate((first, second))
    value = tokens[rows, at].astype(np.uint64)
    return rows, scramble(nodes[rows] * np.uint64(0x2545F4914F6CDD1D) + (np.uint64(1) << np.uint64(32)) * at.astype(np.uint64) + value)


def _plant(classes: DataFrame, number: int) -> DataFrame:
    """Members of the children of all roots of a round."""
    def grow(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names = batch.column(0).to_numpy()
        tokens = _matrix(batch.column(1), np.uint32, TOKENS)
        for root in roots(number):
            rows, child = branch(np.full(len(names), root, np.uint64), tokens)
            yield pa.RecordBatch.from_pydict({"node": child.view(np.int64), "cls": names[rows], "label": names[rows]})

    return in_arrow(classes.select("cls", "tokens"), grow, MEMBER)


def _crowds(members: DataFrame) -> DataFrame:
    """Nodes with members of different labels, one for each set of members, with a pivot."""
    nodes = members.groupBy("node").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("cls")).alias("mark"), F.min("label").alias("low"), F.max("label").alias("high"),
        F.min_by("cls", F.xxhash64("node", "cls")).alias("pivot")).where("n > 1 and low < high")
    return nodes.groupBy("n", "mark").agg(F.min_by(F.struct("node", "pivot"), "node").alias("x")).select("n", "x.node", "x.pivot")


def _split_crowds(large: DataFrame, classes: DataFrame) -> DataFrame:
    """Compare the members of large nodes with the node's pivot.

    Rows ``(kind, node, cls, label, pivot)``. Members surely linked to the pivot (kind
    ``sure``) take its label and leave the recursion; the ``rest`` also branch, kind
    ``child``. Kind ``pair`` is a candidate pair ``(cls, pivot)``.
    """
    of = classes.select("cls", "tokens", "n_shingles")
    # narrow sides are broadcast while they are few, so that tokens are not shuffled level by level
    chosen = checked(stash(large.select("pivot").distinct(), "pivots"))
    pivots = stash(of.join(chosen, F.col("cls") == F.col("pivot")).select("pivot", F.col("tokens").alias("pivot_tokens"), F.col("n_shingles").alias("pivot_size")), "pivots")
    side = F.broadcast(pivots) if pivots.count() <= MAX_BROADCAST_ROWS // TOKENS else pivots
    rows = of.join(checked(large), "cls").join(side, "pivot").select("node", "cls", "label", "pivot", "tokens", "pivot_tokens", "n_shingles", "pivot_size")

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        node, cls, label, pivot, size, other = (batch.column(c).to_numpy() for c in ("node", "cls", "label", "pivot", "n_shingles", "pivot_size"))
        tokens = _matrix(batch.column("tokens"), np.uint32, TOKENS)
        near = (tokens == _matrix(batch.column("pivot_tokens"), np.uint32, TOKENS)).mean(axis=1)
        near = np.where(fits(size, other), near, 0.0)

        def out(kind: str, at: np.ndarray, nodes: np.ndarray, labels: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"kind": pa.array([kind] * len(at), pa.string()), "node": nodes, "cls": cls[at], "label": labels, "pivot": pivot[at]})

        sure = np.flatnonzero(near >= SURE)
        rest = np.flatnonzero(near < SURE)
        pair = np.flatnonzero((near >= MAYBE) & (cls != pivot))
        rows_, child = branch(node[rest].view(np.uint64), tokens[rest])
        yield out("sure", sure, node[sure], pivot[sure])
        yield out("rest", rest, node[rest], label[rest])
        yield out("pair", pair, node[pair], label[pair])
        yield out("child", rest[rows_], child.view(np.int64), label[rest[rows_]])

    return in_arrow(rows, step, "kind string, " + MEMBER + ", pivot long")


def _sure_with_rest(split: DataFrame) -> DataFrame:
    """Members of nodes that bring every block of sure members together with every block of the rest."""
    half = F.lit(SMALL // 2)
    counts = split.where("kind in ('sure', 'rest')").groupBy("node").agg(
        F.ceil(F.count_if(F.col("kind") == "sure") / half).cast("int").alias("sure_blocks"),
        F.ceil(F.count_if(F.col("kind") == "rest") / half).cast("int").alias("rest_blocks")).where("rest_blocks > 0")
    mark = F.xxhash64("cls")
    both = split.where("kind in ('sure', 'rest')").join(counts, "node")
    own = F.when(F.col("kind") == "sure", F.pmod(mark, F.col("sure_blocks"))).otherwise(F.pmod(mark, F.col("rest_blocks"))).cast("int")
    others = F.when(F.col("kind") == "sure", F.col("rest_blocks")).otherwise(F.col("sure_blocks"))
    cut = both.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    first, second = F.when(F.col("kind") == "sure", F.col("own")).otherwise(F.col("other")), F.when(F.col("kind") == "sure", F.col("other")).otherwise(F.col("own"))
    return cut.select(F.xxhash64("node", first, second).alias("node"), "cls", "label")


def fits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the sizes of two sets allow a similarity of 0.75."""
    return 100 * np.minimum(a, b) >= 75 * np.maximum(a, b)


def _blocks(large: DataFrame) -> DataFrame:
    """Members of large nodes as members of all pairs of their blocks of ``SMALL / 2``."""
    blocks = F.ceil(F.col("n") / F.lit(SMALL // 2)).cast("int")
    cut = large.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    return cut.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("node"), "cls", "label")


def grow_trees(classes: DataFrame, number: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members of all small nodes ``(node, cls, label)``, candidate pairs ``(a, b)`` with
    pivots, and the most branchings ``(cls, levels)`` of classes that large nodes passed on."""
    members = stash(_plant(classes, number), "path-members")
    small, pairs = [], []
    deep = classes.sparkSession.createDataFrame([], "cls long, levels int")
    for depth in range(DEPTH):
        crowds = stash(_crowds(members), "path-nodes")
        # members are shuffled to their nodes once a level; small and large nodes are read from that table
        placed = stash(members.join(crowds, "node"), "path-placed")
        small.append(placed.where(f"n <= {SMALL}").select("node", "cls", "label"))
        large = placed.where(f"n > {SMALL}")
        if not crowds.where(f"n > {SMALL}").take(1):
            break
        if depth == DEPTH - 1:
            small.append(_blocks(large))
            break
        split = stash(_split_crowds(large, classes), "path-members")
        pairs.append(split.where("kind = 'pair'").select(F.least("cls", "pivot").alias("a"), F.greatest("cls", "pivot").alias("b")))
        small.append(stash(_sure_with_rest(split), "path-blocks"))
        members = split.where("kind = 'child'").select("node", "cls", "label")
        deep = deep.unionByName(members.select("cls", F.lit(depth + 2).alias("levels")))
    found = small[0]
    for more in small[1:]:
        found = found.unionByName(more)
    stars = classes.sparkSession.createDataFrame([], "a long, b long")
    for more in pairs:
        stars = stars.unionByName(more)
    return found, stars, deep.groupBy("cls").agg(F.max("levels").alias("levels"))


def grow_rounds(classes: DataFrame, documents: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Small nodes and candidate pairs of as many rounds as each class needs for ``TARGET``.

    Later rounds hold only classes that branched deep in the first and read their texts
    again for fresh tokens; without such classes there are none."""
    found, stars, deep = grow_trees(classes)
    need = {n: rounds(n) for n in range(2, DEPTH + 1)}
    if max(need.values()) == 1:
        return found, stars
    deep = stash(deep.where(F.col("levels").isin([n for n, r in need.items() if r > 1])), "path-deep")
    for number in range(1, max(need.values())):
        wanted = classes.join(deep.where(F.col("levels").isin([n for n, r in need.items() if r > number])), "cls", "left_semi").select("k", "cls")
        wanted = stash(wanted, "wanted")
        if not wanted.take(1):
            break
        ids = checked(wanted.select(F.col("k").alias("__k")).distinct())
        rows = documents.join(ids, F.col(f"`{key}`").cast("long") == F.col("__k"), "left_semi")
        # other rows of a wanted id may hold other texts: the class decides
        fresh = signatures(rows, key, text, number).join(checked(wanted.select("cls")), "cls", "left_semi").dropDuplicates(["cls"])
        more, pairs, _ = grow_trees(stash(fresh, "class-tokens"), number)
        found, stars = found.unionByName(more), stars.unionByName(pairs)
    return found, stars


def _forest(label: np.ndarray, size: np.ndarray, sketch: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges of a maximum spanning forest of a node's candidates, members of equal label
    being joined already. Memory grows with the members, not with their pairs."""
    n = len(label)
    best, parent, open_ = np.full(n, -1.0), np.zeros(n, np.int64), np.ones(n, bool)
    left, right, at = [], [], 0
    for _ in range(n - 1):
        open_[at] = False
        near = np.where(label == label[at], 2.0, np.where(fits(size, size[at]), agreement(sketch, sketch[at]), -1.0))
        closer = near > best
        best[closer], parent[closer] = near[closer], at
        at = int(np.where(open_, best, -2.0).argmax())
        if MAYBE <= best[at] < 2.0:
            left.append(int(parent[at]))
            right.append(at)
    return left, right


def _candidate_groups(label: np.ndarray, size: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Group number of every member: members joined by candidates of different labels."""
    group = np.arange(len(label))
    for i in range(len(label)):
        at = np.flatnonzero((group != group[i]) & (label != label[i]) & fits(size, size[i]))
        at = at[agreement(sketch[at], sketch[i]) >= MAYBE]
        if len(at):
            group[np.isin(group, group[at])] = group[i]
    return group


def _exact_links(label: np.ndarray, sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Links of a node on full sets: enough of those between labels to join all that are linked."""
    size = np.array([len(x) for x in sets])
    starts = np.concatenate(([0], np.cumsum(size)[:-1]))
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(int(number.max()) + 1, bool)
    group = {x: x for x in label.tolist()}

    def root(x: int) -> int:
        while group[x] != x:
            x = group[x]
        return x

    left, right = [], []
    for i in range(len(sets) - 1):
        own = number[starts[i]:starts[i] + size[i]]
        mark[own] = True
        common = np.add.reduceat(mark[number[starts[i + 1]:]], starts[i + 1:] - starts[i + 1], dtype=np.int64)
        mark[own] = False
        for j in np.flatnonzero(100 * common >= 75 * (size[i + 1:] + size[i] - common)) + i + 1:
            x, y = root(label[i]), root(label[j])
            if x != y:
                group[x] = y
                left.append(i)
                right.append(int(j))
    return left, right


def _node_stream(rows: DataFrame, each, schema: str) -> DataFrame:
    """Bring the rows of a node together and give ``each`` complete nodes: a table and the
    bounds of its nodes. A task holds one batch and one node."""
    ship(rows.sparkSession)
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartition(parts, "node").sortWithinPartitions("node", "cls")

    def bounds(node: np.ndarray) -> list[tuple[int, int]]:
        cuts = np.flatnonzero(np.diff(node)) + 1
        return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(node)]))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            for low in range(0, batch.num_rows, 2 * SMALL):
                part = pa.Table.from_batches([batch.slice(low, 2 * SMALL)])
                table = part if waiting is None else pa.concat_tables([waiting, part])
                node = table.column("node").to_numpy()
                start = int(np.searchsorted(node, node[-1]))  # the last node may go on in the next rows
                if start:
                    yield each(table.slice(0, start), bounds(node[:start]))
                waiting = table.slice(start)
        if waiting is not None:
            yield each(waiting, bounds(waiting.column("node").to_numpy()))

    return ordered.mapInArrow(stream, schema)


def _pair_batch(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    a = np.concatenate(left) if left else np.empty(0, np.int64)
    b = np.concatenate(right) if right else np.empty(0, np.int64)
    return pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _sketched(leaves: DataFrame, classes: DataFrame) -> DataFrame:
    def shrink(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sketches = small_sketch(_matrix(batch.column("tokens"), np.uint32, TOKENS))
        yield pa.RecordBatch.from_arrays([batch.column("cls"), batch.column("n_shingles"), pa.array([s.tobytes() for s in sketches], pa.binary())],
                                         names=["cls", "n_shingles", "sketch"])

    sketches = in_arrow(classes.select("cls", "n_shingles", "tokens"), shrink, "cls long, n_shingles long, sketch binary")
    return sketches.join(checked(leaves), "cls").select("node", "cls", "label", "n_shingles", "sketch")


def likely_pairs(leaves: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct candidate pairs ``(a, b)``: a spanning forest of the candidates of each node."""
    def forests(table: pa.Table, nodes: list[tuple[int, int]]) -> pa.RecordBatch:
        cls, label, size = (table.column(c).to_numpy() for c in ("cls", "label", "n_shingles"))
        sketch, left, right = _matrix(table.column("sketch"), np.uint8, TOKENS), [], []
        for low, high in nodes:
            if label[low:high].min() < label[low:high].max():
                x, y = _forest(label[low:high], size[low:high], sketch[low:high])
                left.append(cls[low:high][x])
                right.append(cls[low:high][y])
        return _pair_batch(left, right)

    return _node_stream(_sketched(leaves, classes), forests, "a long, b long").distinct()


def remaining_links(leaves: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between labels inside nodes, found on full sets.

    Only members with a candidate of another label bring their sets, once for each group
    of them that candidates hold together. No pair leaves a
    task unless it is a link that joins two labels.
    """
    def doubtful(table: pa.Table, nodes: list[tuple[int, int]]) -> pa.RecordBatch:
        cls, label, size = (table.column(c).to_numpy() for c in ("cls", "label", "n_shingles"))
        sketch = _matrix(table.column("sketch"), np.uint8, TOKENS)
        names, kept = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for low, high in nodes:
            if label[low:high].min() < label[low:high].max():
                group = np.unique(_candidate_groups(label[low:high], size[low:high], sketch[low:high]), return_inverse=True)[1]
                many = np.bincount(group)
                at = np.flatnonzero(many[group] > 1)
                marks = np.zeros(len(many), np.uint64)
                np.add.at(marks, group[at], scramble(cls[low:high][at].view(np.uint64)))  # equal groups of several nodes get one name
                kept.append(low + at)
                names.append(marks[group[at]])
        at = np.concatenate(kept)
        return pa.RecordBatch.from_pydict({"node": np.concatenate(names).view(np.int64), "cls": cls[at], "label": label[at]})

    def exact(table: pa.Table, nodes: list[tuple[int, int]]) -> pa.RecordBatch:
        cls, label = (table.column(c).to_numpy() for c in ("cls", "label"))
        raw, left, right = table.column("s"), [], []
        for low, high in nodes:
            if high - low > 1:
                x, y = _exact_links(label[low:high], [np.frombuffer(v.as_py(), np.uint64) for v in raw.slice(low, high - low)])
                left.append(cls[low:high][x])
                right.append(cls[low:high][y])
        return _pair_batch(left, right)

    mixed = leaves.groupBy("node").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("node")
    members = stash(_node_stream(_sketched(stash(leaves.join(mixed, "node"), "path-mixed"), classes), doubtful, MEMBER).distinct(), "path-doubts")
    return _node_stream(sets.join(checked(members), "cls").select("node", "cls", "label", "s"), exact, "a long, b long").distinct()


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets have ``100 * intersection >= 75 * union``; ``sets`` holds ``(cls, s)``."""
    both = sets.select(F.col("cls").alias("a"), F.col("s").alias("s_a")).join(checked(pairs), "a").join(
        sets.select(F.col("cls").alias("b"), F.col("s").alias("s_b")), "b").select("a", "b", "s_a", "s_b")

    def check(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept = []
        for i, (s, t) in enumerate(zip(batch.column(2), batch.column(3))):
            one, other = np.frombuffer(s.as_py(), np.uint64), np.frombuffer(t.as_py(), np.uint64)
            common = overlap(one, other)
            if 100 * common >= 75 * (len(one) + len(other) - common):
                kept.append(i)
        yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return in_arrow(both, check, "a long, b long")


def sets_of(documents: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """Full sets ``(cls, s)`` of the classes in ``wanted (k, cls)``. The ids are broadcast only
    if they are few; beyond, the documents are joined by shuffle."""
    rows = documents.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text}`").alias("t"))
    wanted = stash(wanted, "wanted")
    side = checked(wanted.select("k").distinct())

    def name(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw = _binary(batch.column(0))
        for low, high in slices([v.as_py() for v in raw], 16_000_000):
            found = [x for v in raw.slice(low, high - low) if len(x := shingle_set(v.as_py() or b""))]
            yield pa.RecordBatch.from_arrays([pa.array([class_number(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())],
                                             names=["cls", "s"])

    # other rows of a wanted id may hold other texts: the class decides
    named = in_arrow(rows.join(side, "k", "left_semi").select("t"), name, "cls long, s binary")
    return named.join(wanted.select("cls").distinct(), "cls", "left_semi").dropDuplicates(["cls"])


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` for every row.

    A text's set is its distinct shingles of five words, A-Z in lower case; a shorter text
    is one shingle; NULL, empty and wordless texts have the empty set and link with
    nothing. Sets with ``100 * intersection >= 75 * union`` are linked, and
    ``component_id`` is the smallest key reachable. Equal sets form a class first, so
    copies are never paired. A spanning forest of each node's candidates is confirmed;
    then every candidate that still lies between components is decided on full sets
    inside its node, so no link that would join two groups is left out. Rows with a NULL key link with nothing and
    have a NULL component. Repeated rows share a class. An empty table gives no rows.
    Other columns are ignored.
    """
    signed = stash(signatures(documents, key, text), "signatures")
    named = signed.where("k is not null and cls is not null").groupBy("cls").agg(F.min("k").alias("rep"))
    named = stash(named, "classes")
    classes = stash(signed.join(named.select(F.col("cls").alias("c"), F.col("rep").alias("k")), "k").where("cls = c").drop("c").dropDuplicates(["cls"]), "class-tokens")
    leaves, stars = grow_rounds(classes, documents, key, text)
    likely = stash(likely_pairs(leaves, classes).unionByName(stars).distinct(), "pairs")
    involved = likely.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = stash(sets_of(documents, classes.join(involved, "cls", "left_semi").select("k", "cls"), key, text), "pair-sets")
    edges = stash(confirm(likely, sets), "links")
    components = stash(connected_components(edges), "components")
    labelled = leaves.join(components.withColumnRenamed("node", "cls"), "cls", "left").select("node", "cls", F.coalesce("component", "cls").alias("label"))
    more = stash(remaining_links(labelled, classes, sets), "links")
    if more.take(1):
        components = stash(connected_components(edges.unionByName(more)), "components")
    ends = named.join(components.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "rep", F.coalesce("component", "cls").alias("root"))
    least = ends.groupBy("root").agg(F.min("rep").alias("component_id"))
    answer = ends.join(least, "root").select("cls", "component_id")
    out = signed.select("k", "n_shingles", "cls").join(answer, "cls", "left")
    component = F.when(F.col("k").isNotNull(), F.coalesce("component_id", "k"))
    return out.select(F.col("k").alias(key), "n_shingles", component.alias("component_id"), (F.col("k") == component).alias("kept"))
