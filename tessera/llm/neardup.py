"""MinHash near-duplicates by an LSH forest, with links confirmed on full shingle sets.

1. Every document gets its set's size, a 128-bit fingerprint of the set, and a signature of minima under
   ``trees * DEPTH`` hash functions. Documents of equal sets are one node, named by the smallest id.
2. The forest: each tree has DEPTH minima of its own, and an order of all nodes by them. Nodes that share the first
   ``PREFIX`` of them form a region, a stretch of the order. Spark sorts each region; in it the neighbours with the longest common
   prefixes are the first candidates, from a depth on that the region's own prefixes give, so that what shares it is
   a short run. What these join is then compared with all else in the region, so no pair is left out. A region of over ``REGION`` nodes is cut into
   stretches of its order, by the nodes' numbers from prefix sums, each with some nodes of the region (``REPRESENTATIVES``)
   that all meet. What this does not connect with the largest part of the region then meets all of the region, block
   by block, and where a region is of one kind the work is in proportion to it.
   Candidates whose signatures agree in ``threshold - MARGIN`` of the places or more are joined; a piece of work gives
   a spanning forest of these, not all pairs.
3. What the trees join together is a cluster. The full sets of a cluster are compared in the same two rounds: blocks of
   bounded size with some representatives, then what is not linked with the largest part, with all. Links are
   pairs whose sets reach the threshold, in whole numbers; each piece gives a spanning star of them.
4. Documents take the component of their node.

The chance that no tree puts a pair just at the threshold into one region is ``MISS`` at most, by the number of
trees: regions of any size are compared by their first ``PREFIX`` minima only. Signatures that agree in less than the
threshold less the margin by chance are as rare.

Defined cases: null and empty texts and texts without words have no shingles and are linked with nothing; a text
of fewer words than a shingle has one, of all of them; rows of one id and text are one node; a row with a
null id takes the component of its set, or null, and is kept if no id is in it; an id with several texts has the
links of all of them; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, numbered, slices, text_buffer
from tessera.llm.graph import components, spanning
from tessera.llm.words import NOT_SPACE, mix, shingles, split, stream

PREFIX, DEPTH = 4, 8
MISS = 1e-5
MARGIN = 0.15
REGION = 2048
REPRESENTATIVES = 64
BLOCK_DOCS, BLOCK_SHINGLES = 250, 200_000
SET_REPRESENTATIVES = 16
SHORT = 8  # regions up to this size are compared all at once
RUN = 16  # neighbours that a prefix may join before a region goes deeper


def tree_count(threshold: float) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - threshold**PREFIX))


def _sets(texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each row of a slice, and their offsets."""
    values, offsets = shingles(split(*text_buffer(texts), NOT_SPACE), size)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[new], np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=len(offsets) - 1))])


def _sketch(size: int, trees: int):
    hashes = trees * DEPTH
    factors = stream(hashes, 41) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, offsets = _sets(batch.column("text"), size)
            counts = np.diff(offsets)
            full = np.flatnonzero(counts)
            at = offsets[:-1][full]
            prints = np.zeros((2, len(counts)), np.uint64)
            minima = np.zeros((len(full), hashes), np.uint64)
            if len(full):
                prints[0, full] = np.add.reduceat(mix(values), at)
                prints[1, full] = np.add.reduceat(mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at)
                for k in range(hashes):
                    minima[:, k] = np.minimum.reduceat((values * factors[k]) >> np.uint64(32), at)
            mixed = mix(minima + (np.arange(hashes, dtype=np.uint64) << np.uint64(40)))
            signature = np.zeros((len(counts), hashes), np.uint8)
            signature[full] = (mixed & np.uint64(255)).astype(np.uint8)
            by_tree = mixed.reshape(len(full), trees, DEPTH)
            key = np.zeros((len(full), trees), np.uint64)
            for k in range(PREFIX):
                key = mix(key + by_tree[:, :, k])
            ends = np.zeros(len(counts) + 1, np.int32)
            ends[1:] = np.cumsum(np.where(counts > 0, trees, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "h1", "h2")),
                    pa.array(counts, pa.int64()),
                    pa.array(prints[0].view(np.int64)),
                    pa.array(prints[1].view(np.int64)),
                    pa.array([x.tobytes() if n else None for x, n in zip(signature, counts)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(key.view(np.int64).ravel())),
                ],
                names=["doc_id", "h1", "h2", "n_shingles", "g1", "g2", "signature", "keys"],
            )

    return run


def common_prefixes(order: np.ndarray) -> np.ndarray:
    """How many minima each row of a sorted order has in common with the one before it; none for the first."""
    out = np.zeros(len(order), np.int64)
    out[1:] = np.cumprod(order[1:] == order[:-1], axis=1).sum(axis=1)
    return out


def _own_depth(prefix: np.ndarray) -> int:
    """The least depth at which no more than ``RUN`` neighbours share a prefix; the whole order where there is none."""
    for depth in range(PREFIX, DEPTH):
        ends = np.flatnonzero(np.append(prefix < depth, True))
        if np.diff(ends, prepend=0).max(initial=0) <= RUN:
            return depth
    return DEPTH


def _join_region(order: np.ndarray, signature: np.ndarray, need: int, first: int, found: list[tuple[int, int]]) -> None:
    """Spanning pairs of a region's nodes in their order, ``first`` the place of the first.

    Neighbours of longest common prefixes come first; what they join is then compared with all that is left.
    """
    prefix = common_prefixes(order)
    depth = _own_depth(prefix)
    parent = np.arange(len(order))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = int(parent[k])
        return k

    run = np.cumsum(prefix < depth)
    for step in range(1, RUN):
        i = np.flatnonzero(run[step:] == run[:-step])
        if not len(i):
            break
        i = i[(signature[i] == signature[i + step]).sum(axis=1) >= need]
        for k in i.tolist():
            a, b = root(k), root(k + step)
            if a != b:
                parent[b] = a
                found.append((first + k, first + k + step))
    label = np.array([root(k) for k in range(len(order))])
    by_label = np.argsort(label, kind="stable")
    cuts = np.searchsorted(label[by_label], np.arange(len(order) + 1))
    members = lambda x: by_label[cuts[x] : cuts[x + 1]].tolist()
    left = np.ones(len(order), bool)
    for begin in range(len(order)):
        if not left[begin]:
            continue
        queue = members(int(label[begin]))
        left[queue] = False
        while queue and left.any():
            node = queue.pop()
            others = np.flatnonzero(left)
            near = others[(signature[others] == signature[node]).sum(axis=1) >= need]
            for x in np.unique(label[near]).tolist():  # one of them joins all of what it is joined with
                found.append((first + node, first + int(near[label[near] == x][0])))
                more = members(x)
                left[more] = False
                queue += more


def _is_representative(count: str, most: int) -> Column:
    """Whether a hash makes a node one of about ``most`` of its group."""
    return F.pmod(F.xxhash64(F.col("node"), F.lit(17)), F.col(count)) < most


def _placed(nodes: DataFrame, region: int) -> DataFrame:
    """(key, node, signature, order, blocks, count) of each node and tree; ``blocks`` and ``count`` are null in regions of up to ``region``."""
    sizes = nodes.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("count")).where(F.col("count") > region)
    large = materialise(sizes.withColumn("blocks", F.ceil(F.col("count") / F.lit(region)).cast("int")), "neardup-regions")
    planted = nodes.select("node", "signature", F.posexplode("keys").alias("tree", "key")).join(large, "key", "left")
    order = F.substring("signature", F.col("tree") * DEPTH + 1, F.lit(DEPTH))
    return planted.select("key", "node", "signature", order.alias("order"), "blocks", "count")


def _first_pieces(placed: DataFrame, region: int) -> DataFrame:
    """(piece, node, signature, order): small regions; of large ones stretches of their order, with the representatives."""
    columns = ("node", "signature", "order")
    small = placed.where("blocks is null").select(F.col("key").alias("piece"), *columns)
    large = placed.where("blocks is not null")
    own = numbered(large, ["key"], ["order", "node"], "_k", few=False).withColumn("part", F.floor(F.col("_k") / F.lit(region)))
    piece = F.xxhash64("key", "part").alias("piece")
    stretches = own.select("key", "blocks").distinct().select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("part"))
    shown = large.where(_is_representative("count", REPRESENTATIVES)).join(stretches, "key")
    return small.union(own.select(piece, *columns)).union(shown.select(piece, *columns))


def _labels(members: DataFrame, group: str, joined: DataFrame) -> DataFrame:
    """The members with ``loose``: whether what they are joined with is not the largest part of their group."""
    named = members.join(joined, "node", "left").withColumn("_label", F.coalesce("root", "node"))
    top = named.groupBy(group, "_label").agg(F.count("*").alias("_n")).groupBy(group).agg(F.max_by("_label", "_n").alias("_top"))
    return named.join(top, group).withColumn("loose", F.col("_label") != F.col("_top")).drop("_label", "_top", "root")


def _second_pieces(labelled: DataFrame, region: int) -> DataFrame:
    """(piece, node, signature, order) of large regions: each block of a region with each block of its loose nodes."""
    loose = labelled.where("loose").groupBy("key").agg(F.ceil(F.count("*") / F.lit(region)).cast("int").alias("turns"))
    rows = labelled.join(loose, "key")
    block, turn = F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")), F.pmod(F.xxhash64("node", F.lit(3)), F.col("turns"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    all_rows = rows.select("key", block.cast("int").alias("b"), every("turns").alias("l"), "node", "signature", "order")
    loose_rows = rows.where("loose").select("key", every("blocks").alias("b"), turn.cast("int").alias("l"), "node", "signature", "order")
    return all_rows.union(loose_rows).select(F.xxhash64("key", "b", "l").alias("piece"), "node", "signature", "order")


def _candidates(need: int):
    """Pairs of nodes that a tree joins, from rows of which those of one key stand together, in their order."""

    def handle(key: np.ndarray, node: np.ndarray, signature: np.ndarray, order: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(cuts, len(key)))
        region = np.repeat(np.arange(len(cuts)), sizes)
        small = sizes[region] <= SHORT
        pairs: list[tuple[int, int]] = []
        for step in range(1, SHORT):
            i = np.flatnonzero(small[:-step] & (region[step:] == region[:-step]))
            agree = (signature[i] == signature[i + step]).sum(axis=1) >= need
            pairs += zip(i[agree].tolist(), (i[agree] + step).tolist())
        for r in np.flatnonzero(sizes > SHORT).tolist():
            a, b = int(cuts[r]), int(cuts[r] + sizes[r])
            _join_region(order[a:b], signature[a:b], need, a, pairs)
        at = np.array(pairs, np.int64).reshape(-1, 2)
        star = spanning(node[at[:, 0]].tolist(), node[at[:, 1]].tolist())
        out = np.array([(x, r) for x, r in star.items() if x != r], np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            columns = [np.asarray(batch.column(c)) for c in ("piece", "node")]
            columns += [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("signature", "order")]
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest, columns)]
            # the last region may go on in the next batch
            cut = int(np.searchsorted(columns[0], columns[0][-1], "left"))
            if cut:
                yield handle(*(x[:cut] for x in columns))
            rest = [x[cut:] for x in columns]
        if rest is not None:
            yield handle(*rest)

    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, offsets = _sets(batch.column("text"), size)
            sets = [values[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "cluster", "h1", "h2")), pa.array(np.diff(offsets), pa.int64()), pa.array(sets, pa.binary())], names=["node", "cluster", "h1", "h2", "n", "shingles"])

    return run


def _links(node: np.ndarray, side: np.ndarray, sets: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Spanning star of the links between the sets of two blocks (side 0 and 1), or of one block with itself (side 0)."""
    flat = np.frombuffer(b"".join(sets), np.uint64)
    sizes = np.array([len(s) // 8 for s in sets])
    begin = np.cumsum(sizes) - sizes
    number = np.unique(flat, return_inverse=True)[1].ravel()
    width = int(number.max()) + 1
    two = bool(side.any())
    rows = np.flatnonzero(side == 0)
    # the columns that a row is compared with stand in one stretch, so that one sum takes them all
    order = np.flatnonzero(side == 1) if two else rows
    stretch = np.concatenate([number[begin[j] : begin[j] + sizes[j]] for j in order])
    start = np.cumsum(sizes[order]) - sizes[order]
    a, b = [], []
    mark = np.zeros(width, np.int64)
    for place, i in enumerate(rows.tolist()):
        skip = 0 if two else place + 1
        if skip >= len(order):
            break
        own = number[begin[i] : begin[i] + sizes[i]]
        mark[own] = 1
        shared = np.add.reduceat(mark[stretch[start[skip] :]], start[skip:] - start[skip])
        mark[own] = 0
        linked = order[skip:][100 * shared >= percent * (sizes[i] + sizes[order[skip:]] - shared)]
        a += [int(node[i])] * len(linked)
        b += node[linked].tolist()
    return [(x, r) for x, r in spanning(a, b).items() if x != r]


def _confirm(percent: int):
    """Links of each (cluster, i, j), whose rows stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, node, side, sets = None, [], [], []

        def links() -> pa.RecordBatch:
            out = np.array(_links(np.array(node, np.int64), np.array(side), sets, percent) if len(node) > 1 else [], np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"])

        for batch in batches:
            for *now, n, s, values in zip(*(batch.column(c).to_pylist() for c in ("cluster", "i", "j", "node", "side", "shingles"))):
                if now != key:
                    if len(node) > 1:
                        yield links()
                    key, node, side, sets = now, [], [], []
                node.append(n)
                side.append(s)
                sets.append(values)
        if len(node) > 1:
            yield links()

    return run


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _text_prints() -> tuple[Column, Column]:
    """Two hashes of the text, by which rows of one id or of none are told apart."""
    return F.xxhash64(_text()), F.xxhash64(F.lit(2), _text())


def find_components(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; sets of ``shingle`` words, links from ``percent`` on."""
    return _components(docs, **options).select("doc_id", "n_shingles", "component_id", "kept")


def _components(docs: DataFrame, *, shingle: int = 3, percent: int = 85, block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES, region: int = REGION) -> DataFrame:
    """As above, with the hashes of the text."""
    spark = docs.sparkSession
    trees = tree_count(percent / 100)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    h1, h2 = _text_prints()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), h1.alias("h1"), h2.alias("h2"), _text().alias("text"))
    sketch = materialise(texts.mapInArrow(_sketch(shingle, trees), "doc_id long, h1 long, h2 long, n_shingles long, g1 long, g2 long, signature binary, keys array<long>"), "neardup-sketch")
    known = sketch.where("n_shingles > 0 and doc_id is not null")
    nodes = known.groupBy("g1", "g2").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"), F.first("keys").alias("keys"))
    nodes = materialise(nodes, "neardup-nodes")
    need = math.ceil((percent / 100 - MARGIN) * trees * DEPTH)

    def meet(pieces: DataFrame) -> DataFrame:
        return pieces.repartition(n, "piece").sortWithinPartitions("piece", "order").mapInArrow(_candidates(need), "a long, b long")

    placed = _placed(nodes, region)
    clusters = materialise(components(meet(_first_pieces(placed, region))), "neardup-clusters")
    crowded = placed.where("blocks is not null").drop("count")
    if crowded.limit(1).count():
        labelled = materialise(_labels(crowded, "key", clusters), "neardup-crowded")
        if labelled.where("loose").limit(1).count():
            stars = clusters.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b")
            clusters = materialise(components(stars.union(meet(_second_pieces(labelled, region)))), "neardup-clusters")
    # one text for each node of a cluster: repeated rows of an id have to be told apart by their sets
    cluster = clusters.select("node", F.col("root").alias("cluster"))
    members = texts.join(cluster, texts["doc_id"] == cluster["node"]).select("node", "cluster", "h1", "h2", "text")
    sets = members.mapInArrow(_full_sets(shingle), "node long, cluster long, h1 long, h2 long, n long, shingles binary").where("n > 0")
    sets = materialise(sets.dropDuplicates(["node", "h1", "h2"]).drop("h1", "h2"), "neardup-sets")
    blocks = F.greatest(F.ceil(F.count("*") / F.lit(block_docs)), F.ceil(F.sum("n") / F.lit(block_shingles))).cast("int")
    extent = materialise(sets.groupBy("cluster").agg(blocks.alias("blocks"), F.count("*").alias("count")), "neardup-extent")

    def confirm(dealt: DataFrame) -> DataFrame:
        dealt = dealt.repartition(n, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
        return dealt.mapInArrow(_confirm(percent), "a long, b long")

    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = sets.join(extent, "cluster").withColumn("own", own)
    first = spread.select("cluster", F.col("own").alias("i"), F.lit(-1).alias("j"), "node", F.lit(0).alias("side"), "shingles")
    shown = spread.where((F.col("blocks") > 1) & _is_representative("count", SET_REPRESENTATIVES)).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("i <> own")
    links = materialise(confirm(first.union(shown.select("cluster", "i", F.lit(-1), "node", F.lit(0), "shingles"))), "neardup-stars")
    roots = materialise(components(links), "neardup-links")
    several = spread.where("blocks > 1").select("cluster", "node", "n", "blocks", "own").distinct()
    if extent.where("blocks > 1").limit(1).count():
        labelled = materialise(_labels(several, "cluster", roots), "neardup-large")
        if labelled.where("loose").limit(1).count():
            turns = labelled.where("loose").groupBy("cluster").agg(blocks.alias("turns"))
            rows = labelled.join(turns, "cluster").drop("n").join(sets.select("cluster", "node", "shingles"), ["cluster", "node"])
            every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
            turn = F.pmod(F.xxhash64("node", F.lit(3)), F.col("turns")).cast("int")
            whole = rows.select("cluster", F.col("own").alias("i"), every("turns").alias("j"), "node", F.lit(0).alias("side"), "shingles")
            loose = rows.where("loose").select("cluster", every("blocks").alias("i"), turn.alias("j"), "node", F.lit(1).alias("side"), "shingles")
            roots = materialise(components(links.union(confirm(whole.union(loose)))), "neardup-links")
    named = nodes.select("g1", "g2", "node").join(roots, "node", "left").select("g1", "g2", F.coalesce("root", "node").alias("_root"))
    named = materialise(named, "neardup-names")
    out = sketch.select("doc_id", "h1", "h2", "n_shingles", "g1", "g2").join(named, ["g1", "g2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("_root")).otherwise(F.col("doc_id")).alias("component_id")
    return out.select("doc_id", "h1", "h2", "n_shingles", component).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows that are kept, with all their columns: one document of each group of near-duplicates.

    Rows of one id and text stay or go together; rows of one id and other texts, and rows without an id, are
    judged by their own text.
    """
    names = ["_tessera_id", "_tessera_h1", "_tessera_h2"]
    out = _components(docs, **options).where(~F.col("kept")).select("doc_id", "h1", "h2").distinct().toDF(*names)
    own = [docs["doc_id"].cast("long"), *_text_prints()]
    match = own[0].eqNullSafe(out[names[0]]) & (own[1] == out[names[1]]) & (own[2] == out[names[2]])
    return docs.join(out, match, "left_anti")
