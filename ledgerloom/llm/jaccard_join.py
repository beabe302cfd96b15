"""Self-join of documents on the Jaccard similarity of their five-word shingles, by chosen paths.

Each different shingle set is embedded as ``HASHES`` tokens (coordinate, minimum hash), of which two
sets share a fraction equal to their similarity in expectation. Every run starts with all sets in one
node and splits a node on coordinates sampled by the node's path, so that two sets that share a token
there stay together; about 1 / threshold coordinates are sampled, which keeps similar pairs alive in
expectation. Nodes of one set are dropped, small ones are compared in full, larger ones are split again,
and the dense ones that are left at the deepest level are compared in blocks. The number of runs follows
from the recall asked for.

Buckets name candidates by compared tokens; inside each connected group of candidates all similarities
are then computed exactly on the sets, which gives links, link counts and classes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD, numbered, without_rows
from ledgerloom.llm.components import components
from ledgerloom.sources.workspace import materialize, settled

SHINGLE_WORDS = 5
THRESHOLD = 0.8
HASHES = 128
RECALL = 0.99
DEPTH = 4
SMALL_BUCKET = 2048
BLOCK_ROWS = 1024
VERIFY_ROWS = 256
SEED = 99
_REMEMBERED = 500_000


def survival(depth: int) -> float:
    """Chance that one run keeps a pair of exactly the threshold's similarity together ``depth`` levels down.

    The shared children of a node are close to Poisson with mean 1: q(d) = 1 - exp(-q(d - 1)).
    """
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-alive)
    return alive


def runs_for(recall: float, depth: int, threshold: float = THRESHOLD) -> int:
    """Runs that the recall takes: as many as expected draws ask for, and more if the seed's own draws are too few."""
    runs = max(1, math.ceil(math.log(1 - recall) / math.log(1 - survival(depth))))
    while recall_of(runs, depth, threshold) < recall:
        runs += 1
    return runs


def recall_of(runs: int, depth: int, threshold: float = THRESHOLD) -> float:
    """Chance that a pair of exactly the threshold's similarity meets, by the coordinates that the runs draw at the root.

    A coordinate is shared with the threshold's chance, by all runs that draw it at once; from there on runs differ.
    """
    roots = np.array([root_path(run) for run in range(runs)], dtype=np.uint64)
    often = (_draws(roots) <= _limit(threshold)).sum(axis=0)
    missed = 1 - threshold + threshold * (1 - survival(depth - 1)) ** often
    return 1 - float(missed.prod())


def root_path(run: int) -> np.uint64:
    return mixed(np.array([SEED * 1_000_003 + run + 1], dtype=np.uint64))[0]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))
        return found


_WORDS = re.compile(WORD)


def shingles(text: str | None, words: WordHashes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted different 64-bit hashes of the runs of ``size`` lower-cased words.

    A text of fewer words has one shingle, all its words; one without words has none.
    """
    found = re.findall(_WORDS, (text or "").lower())
    if not found:
        return np.zeros(0, dtype=np.uint64)
    each = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    take = min(size, len(each))
    count = len(each) - take + 1
    rolled = np.full(count, take, dtype=np.uint64)
    for at in range(take):
        rolled = mixed(rolled + each[at : at + count])
    return np.unique(rolled)


def minimum_hashes(values: np.ndarray, hashes: int = HASHES, seed: int = SEED) -> np.ndarray:
    turns = np.random.default_rng(seed).integers(0, 1 << 63, size=(2, hashes), dtype=np.uint64)
    lowest = np.full(hashes, np.iinfo(np.uint64).max)
    for begin in range(0, len(values), 4096):
        part = values[begin : begin + 4096, None] * (turns[0] * np.uint64(2) + np.uint64(1)) + turns[1]
        lowest = np.minimum(lowest, (part >> np.uint64(32)).min(axis=0))
    return lowest.astype(np.uint32)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for batch in batches:
        high, low, size, tokens = [], [], [], []
        for text in batch.column(2).to_pylist():
            found = shingles(text, words)
            key = xxhash.xxh3_128_intdigest(found.tobytes())
            high.append((key >> 64) - (1 << 63))
            low.append((key & ((1 << 64) - 1)) - (1 << 63))
            size.append(len(found))
            tokens.append(minimum_hashes(found).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(size, pa.int32()), pa.array(tokens, pa.binary()), batch.column(3)],
            names=["id", "place", "high", "low", "size", "tokens", "row"],
        )


def _token_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(len(column), HASHES)


def _draws(paths: np.ndarray) -> np.ndarray:
    """A number for each path and coordinate; low ones are sampled."""
    return mixed(paths[:, None] ^ mixed(np.arange(1, HASHES + 1, dtype=np.uint64))[None, :])


def _limit(threshold: float) -> np.uint64:
    return np.uint64(int((1 << 64) / (threshold * HASHES)) - 1)


def children(paths: np.ndarray, tokens: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child path) of every sampled token: a coordinate is sampled by the path alone."""
    drawn = _draws(paths)
    rows, at = np.nonzero(drawn <= _limit(threshold))
    return rows, mixed(drawn[rows, at] + tokens[rows, at].astype(np.uint64) + np.uint64(1))


def _roots(runs: int, threshold: float):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, nodes = _token_rows(batch.column(1)), batch.column(0).to_numpy()
            for run in range(runs):
                root = np.full(len(nodes), root_path(run))
                rows, paths = children(root, tokens, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[rows]), pa.array(paths.view(np.int64))], names=["node", "path"])

    return split


def _deeper(threshold: float):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                nodes, paths = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
                rows, paths = children(paths, _token_rows(batch.column(2)), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[rows]), pa.array(paths.view(np.int64))], names=["node", "path"])

    return split


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the first row of each; input is sorted by its first ``keys`` columns."""
    held: list[pa.RecordBatch] = []

    def firsts(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows, dtype=bool)
        change[:1] = True
        for k in range(keys):
            values = table.column(k).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(change)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        starts = firsts(table)
        if len(starts) > 1:
            cut = int(starts[-1])
            yield table.slice(0, cut), starts[:-1]
            held = table.slice(cut).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, firsts(table)


def lowest_labels(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``count`` items the smallest item connected to it."""
    labels = np.arange(count)
    while True:
        low = np.minimum(labels[left], labels[right])
        after = labels.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        after = after[after]
        if (after == labels).all():
            return labels
        labels = after


def _compared(threshold: float):
    """Candidates of each bucket or pair of blocks, as edges to the first of their group."""
    # four standard deviations below the threshold; one-byte tokens agree by chance 1 in 256
    least = HASHES * (threshold - 4 * math.sqrt(threshold * (1 - threshold) / HASHES))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_groups(batches, 3):
            group = np.zeros(table.num_rows, dtype=np.int64)
            group[starts[1:]] = 1
            group = np.cumsum(group)
            ends = np.append(starts[1:], table.num_rows)
            node, own = table.column("node").to_numpy(), table.column("own").to_numpy()
            cross = table.column("block").to_numpy() != table.column("other").to_numpy()
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, HASHES)
            left, right = [], []
            for gap in range(1, int((ends - starts).max())):
                a = np.flatnonzero(group[gap:] == group[:-gap])
                b = a + gap
                use = ~cross[a] | (own[a] != own[b])
                a, b = a[use], b[use]
                alike = (sketch[a] == sketch[b]).sum(axis=1) >= least
                left.append(a[alike])
                right.append(b[alike])
            if left:
                order = np.argsort(node, kind="stable")  # so that the first item is the smallest node
                place = np.empty_like(order)
                place[order] = np.arange(len(order))
                labels = lowest_labels(len(node), place[np.concatenate(left)], place[np.concatenate(right)])
                moved = np.flatnonzero(labels != np.arange(len(labels)))
                a, b = node[order[moved]], node[order[labels[moved]]]
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return compared


def _in_blocks(rows: DataFrame, size: str, limit: int, identity: str) -> DataFrame:
    """Rows of groups above ``limit`` dealt to all pairs of blocks: columns own, block, other."""
    blocks = F.ceil(F.col(size) / limit).cast("int")
    own = F.pmod(F.xxhash64(F.col(identity)), blocks).cast("int")
    dealt = rows.withColumn("own", own).withColumn("_with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.withColumn("block", F.least("own", "_with")).withColumn("other", F.greatest("own", "_with")).drop("_with")


def candidate_edges(sets: DataFrame, threshold: float, recall: float, depth: int, small: int) -> DataFrame:
    """Edges that connect the candidates found by all runs, from ``sets`` (node, tokens)."""
    schema = "node bigint, path bigint"
    level = sets.select("node", "tokens").mapInArrow(_roots(runs_for(recall, depth, threshold), threshold), schema)
    leaves = None
    for at in range(1, depth + 1):
        level = materialize(level, "paths")
        sizes = level.groupBy("path").agg(F.count("*").alias("rows")).filter("rows > 1").withColumnRenamed("path", "_path")
        sized = level.join(materialize(sizes, "path-sizes"), F.col("path") == F.col("_path")).drop("_path")
        done = sized if at == depth else sized.filter(F.col("rows") <= small)
        leaves = done if leaves is None else leaves.unionByName(done)
        if at == depth or sizes.filter(F.col("rows") > small).isEmpty():
            break
        large = sized.filter(F.col("rows") > small).join(sets.select(F.col("node").alias("_node"), "tokens"), F.col("node") == F.col("_node"))
        level = large.select("node", "path", "tokens").mapInArrow(_deeper(threshold), schema)
    # a path met in another level by a 64-bit accident would only add comparisons
    sketches = sets.select(F.col("node").alias("_node"), "sketch")
    units = _in_blocks(leaves, "rows", BLOCK_ROWS, "node").join(sketches, F.col("node") == F.col("_node"))
    key = ["path", "block", "other"]
    sorted_units = units.select(*key, "node", "own", "sketch").repartition(*key).sortWithinPartitions(*key)
    return sorted_units.mapInArrow(_compared(threshold), "a bigint, b bigint")


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of each node once, however often its row is repeated in the task."""
    words, sent = WordHashes(), set()
    for batch in batches:
        if len(sent) > _REMEMBERED:  # a node met again after that is folded where sets are compared
            sent.clear()
        keep, sets = [], []
        found = zip(*(batch.column(c).to_pylist() for c in (0, 3, 4, 5)))
        for at, (node, high, low, text) in enumerate(found):
            if node in sent:
                continue
            values = shingles(text, words).tobytes()
            key = xxhash.xxh3_128_intdigest(values)
            # another text with the same 64-bit place is not this node's
            if (key >> 64) - (1 << 63) == high and (key & ((1 << 64) - 1)) - (1 << 63) == low:
                sent.add(node)
                keep.append(at)
                sets.append(values)
        rows = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([*rows.columns[:3], pa.array(sets, pa.binary())], names=["node", "component", "copies", "set"])


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, as products of membership columns."""
    count = len(sets)
    owner = np.repeat(np.arange(count), [len(s) for s in sets])
    values, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    total = np.zeros((count, count), dtype=np.float32)
    shared = often > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    owner, column = owner[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    step = max(256, 4_000_000 // max(count, 1))
    for begin in range(0, int(shared.sum()), step):
        a, b = np.searchsorted(column, [begin, begin + step])
        part = np.zeros((count, step), dtype=np.float32)
        part[owner[a:b], column[a:b] - begin] = 1
        total += part @ part.T
    return total


def _verified(threshold: float):
    """Exact links inside each pair of blocks: per node the copies it is linked to and a connected node."""

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_groups(batches, 3):
            ends = np.append(starts[1:], table.num_rows)
            all_nodes, all_own = table.column("node").to_numpy(), table.column("own").to_numpy()
            all_copies = table.column("copies").to_numpy()
            cross = table.column("block").to_numpy() != table.column("other").to_numpy()
            packed = table.column("set")
            nodes, links, roots = [], [], []
            for a, b in zip(starts.tolist(), ends.tolist()):
                order = np.argsort(all_nodes[a:b], kind="stable")
                keep = order[np.append(True, np.diff(all_nodes[a:b][order]) != 0)]
                if len(keep) < 2:
                    continue
                sets = [np.frombuffer(packed[a + int(i)].as_py(), dtype=np.uint64) for i in keep]
                size = np.array([len(s) for s in sets], dtype=np.float64)
                common = intersections(sets).astype(np.float64)
                linked = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-9
                np.fill_diagonal(linked, False)
                if cross[a]:
                    own = all_own[a:b][keep]
                    linked &= own[:, None] != own[None, :]
                left, right = np.nonzero(linked)
                if len(left):
                    node = all_nodes[a:b][keep]
                    count = linked @ all_copies[a:b][keep]
                    some = np.flatnonzero(count)
                    nodes.append(node[some])
                    links.append(count[some])
                    roots.append(node[lowest_labels(len(node), left, right)[some]])
            if nodes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in (nodes, links, roots)], names=["node", "links", "root"]
                )

    return verified


def similar_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    depth: int = DEPTH,
    small: int = SMALL_BUCKET,
    row_col: str | None = None,
) -> DataFrame:
    """One row per input row: id, class_id, class_size, n_links, kept.

    A class is a connected group of links; a link is a similarity of at least ``threshold``, and
    ``class_id`` the smallest id in it. ``n_links`` counts the other rows that a row is linked to, copies
    with the same shingles included. ``kept`` marks one row of each class, the one with the smallest
    id. NULL, empty and blank texts have no shingles and are classes of their own; texts under five
    words have one shingle; repeated rows are linked to each other; an empty table gives no rows.
    ``row_col`` names a column with a number of its own for each row, which is returned as the last one.
    """
    place = F.xxhash64(id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    number = F.monotonically_increasing_id() if row_col is None else F.col(row_col).cast("bigint")
    rows = docs.select(F.col(id_col).alias("id"), place.alias("place"), F.col(text_col).alias("text"), number.alias("row")).mapInArrow(
        _featured, f"id {kind}, place bigint, high bigint, low bigint, size int, tokens binary, row bigint"
    )
    rows = materialize(rows, "shingled")
    first = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("row").alias("row"))
    sets = materialize(
        rows.filter("size > 0").groupBy("high", "low").agg(F.min("row").alias("node"), F.count("*").alias("copies"), F.min(first).alias("first")),
        "sets",
    )
    one = rows.select(F.col("row").alias("_row"), "tokens", "place").join(sets, F.col("_row") == F.col("node")).drop("_row")
    # the last byte of each token is enough to compare candidates
    one = one.mapInArrow(_sketched, "node bigint, copies bigint, high bigint, low bigint, place bigint, tokens binary, sketch binary")
    one = materialize(one, "set-tokens")
    groups = components(candidate_edges(one, threshold, recall, depth, small))
    roots = groups.select(F.col("root").alias("node"), "root").distinct()
    members = materialize(groups.unionByName(roots), "candidate-groups")
    sizes = members.groupBy("root").agg(F.count("*").alias("rows")).withColumnRenamed("root", "component")
    wanted = (
        members.select(F.col("node").alias("_node"), F.col("root").alias("component"))
        .join(one.select("node", "copies", "high", "low", "place"), F.col("_node") == F.col("node"))
        .select("node", "component", "copies", "high", "low", F.col("place").alias("_place"))
    )
    texts = docs.select(place.alias("place"), F.col(text_col).alias("text"))
    wanted = texts.join(wanted, F.col("place") == F.col("_place")).select("node", "component", "copies", "high", "low", "text")
    exact = materialize(wanted.mapInArrow(_with_sets, "node bigint, component bigint, copies bigint, set binary"), "candidate-sets")
    key = ["component", "block", "other"]
    units = _in_blocks(exact.join(sizes, "component"), "rows", VERIFY_ROWS, "node")
    units = units.select(*key, "node", "own", "copies", "set").repartition(*key).sortWithinPartitions(*key)
    linked = materialize(units.mapInArrow(_verified(threshold), "node bigint, links bigint, root bigint"), "links-found")
    classes = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "_node")
    counts = linked.groupBy("node").agg(F.sum("links").alias("links")).withColumnRenamed("node", "_counted")
    labelled = (
        sets.join(classes, F.col("node") == F.col("_node"), "left")
        .join(counts, F.col("node") == F.col("_counted"), "left")
        .select("high", "low", "copies", "first", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    labelled = materialize(labelled, "labelled-sets")
    merged = labelled.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("kept_row"), F.sum("copies").alias("class_size"))
    by_set = materialize(
        labelled.join(merged, F.col("root") == F.col("_root")).select(
            F.col("high").alias("_high"), F.col("low").alias("_low"), "kept_row", "class_size", (F.col("links") + F.col("copies") - 1).alias("n_links")
        ),
        "classes-of-sets",
    )
    out = rows.select("id", "row", "high", "low", "size").join(
        by_set, (F.col("high") == F.col("_high")) & (F.col("low") == F.col("_low")) & (F.col("size") > 0), "left"
    )
    alone: Column = F.col("kept_row").isNull()
    return out.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("kept_row.id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("bigint").alias("class_size"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        (alone | (F.col("kept_row.row") == F.col("row"))).alias("kept"),
        *([] if row_col is None else [F.col("row").alias(row_col)]),
    )


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cut = [np.frombuffer(t, dtype=np.uint32).astype(np.uint8).tobytes() for t in batch.column("tokens").to_pylist()]
        names = ["node", "copies", "high", "low", "place", "tokens"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(cut, pa.binary())], names=[*names, "sketch"])


def one_row_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class, the one ``similar_classes`` marks as kept.

    Rows are told apart by a number of their own, so rows that repeat id and text leave one, and an id
    may stand for several texts. A row without an id is the one that stays only if no other has one. Texts
    without words are similar to nothing and stay; an empty table gives no rows. The join's work tables are deleted
    as soon as the numbers of the rows that go are known.
    """
    table = numbered(docs)
    rows = table.select(F.col(f"doc.{id_col}").alias("id"), F.col(f"doc.{text_col}").alias("text"), "row")

    def gone() -> DataFrame:
        return similar_classes(rows, "id", "text", row_col="row").filter(~F.col("kept")).select("row")

    return without_rows(table, settled(docs.sparkSession, "similar", gone))
