"""Exact hard negatives by a multiway hyperplane tree whose split points keep distance ranges to their siblings' subtrees.

The inner product of two vectors and their norms give their distance, so a
window of scores is an annulus around the anchor. A subtree is left out if
for one of the split points beside it no distance in its range can lie in any
annulus that is still asked for. What is left of the tree, its leaves, is
scored exactly in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quaestor.llm.tables import pin, read_table

ARITY = 16  # split points of an inner node; the tree has two levels of them
SAMPLE = 8192  # vectors that split points are chosen from
BLOCK_ROWS = 16384  # leaf rows, and queries, that one task scores against each other
EXACT = float(1 << 53)
UNBOUNDED = (1 << 62)
SLACK = 1e-6  # distances are roots; a subtree goes only if it is out of reach by more than this share

NODE = "key binary, label bigint, vec binary, ids array<bigint>"
QUERY = "key binary, label bigint, vec binary, leaf int, windows array<struct<w:int,low:bigint,high:bigint>>"
FOUND = "key binary, label bigint, w int, best array<struct<down:bigint,id:bigint>>"
OUTPUT = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as bytes, two each if they fit."""
    small = values.astype(np.int16)
    return b"h" + small.tobytes() if (small == values).all() else b"q" + values.astype(np.int64).tobytes()


def unpack(packed: list[bytes]) -> np.ndarray:
    """A row per vector; shorter ones end in zeros."""
    rows = [np.frombuffer(p, np.int16 if p[:1] == b"h" else np.int64, offset=1) for p in packed]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.float64)
    if all(p[:1] == b"h" for p in packed):
        for k, row in enumerate(rows):
            out[k, :len(row)] = row
        return out
    exact = np.zeros(out.shape, object)
    for k, row in enumerate(rows):
        exact[k, :len(row)] = row.tolist()
    return exact


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of both: by doubles where every partial sum is a whole number they can hold, else by Python's integers."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    if a.dtype != object and b.dtype != object and np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * width < EXACT:
        return (a @ b.T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -UNBOUNDED, UNBOUNDED).astype(np.int64)


def _merge_ids(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[pa.RecordBatch]:
    """Equal vectors of one label as one node, with their ``keep`` smallest ids."""
    held: dict[tuple, list] = {}

    def out() -> pa.RecordBatch:
        nodes = [(key, label, vec, sorted(ids)[:keep]) for (key, label), (vec, ids) in held.items()]
        held.clear()
        columns = list(zip(*nodes, strict=True)) or [[]] * 4
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64())), strict=True)],
                               ["key", "label", "vec", "ids"])

    for batch in batches:
        for vec_id, label, values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            vec = pack(np.array(values, np.int64))
            node = held.setdefault((xxhash.xxh3_128_digest(vec), label), (vec, []))
            node[1].append(vec_id)
            if len(node[1]) > 64 * keep:
                node[1][:] = sorted(node[1])[:keep]
        if len(held) > 100_000:
            yield out()
    yield out()


@dataclass
class Tree:
    """Split points of both levels, and distance and norm ranges of what lies below them."""
    top: np.ndarray               # split points of the root
    below: list[np.ndarray]       # those of each child
    near: np.ndarray | None = None      # [inner node, split point, child]: least distance
    far: np.ndarray | None = None       # greatest distance
    small: np.ndarray | None = None     # [inner node, child]: least squared norm
    large: np.ndarray | None = None


def _squared(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    points, rows = np.asarray(points, np.float64), np.asarray(rows, np.float64)
    width = max(points.shape[1], rows.shape[1])
    points, rows = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (points, rows))
    return np.maximum((rows ** 2).sum(1)[:, None] + (points ** 2).sum(1)[None] - 2 * rows @ points.T, 0)


def _spread_points(sample: np.ndarray, n: int) -> np.ndarray:
    """Split points far from each other: each next one is the farthest from those chosen."""
    chosen = [0]
    away = _squared(sample[:1], sample)[:, 0]
    while len(chosen) < n and away.max(initial=0) > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, _squared(sample[chosen[-1:]], sample)[:, 0])
    return sample[chosen]


def plant(sample: np.ndarray, arity: int = ARITY) -> Tree:
    sample = np.asarray(sample, np.float64)
    top = _spread_points(sample, arity)
    cell = _squared(top, sample).argmin(1)
    return Tree(top, [_spread_points(sample[cell == k], arity) for k in range(len(top))])


def leaves_of(tree: Tree, rows: np.ndarray, arity: int) -> np.ndarray:
    """Leaf of each row: the nearest split point of the root, then of that child."""
    first = _squared(tree.top, rows).argmin(1)
    second = np.zeros(len(rows), np.int64)
    for k in np.unique(first).tolist():
        own = np.flatnonzero(first == k)
        second[own] = _squared(tree.below[k], np.asarray(rows, np.float64)[own]).argmin(1)
    return first * arity + second


def _measure(batches: Iterator[pa.RecordBatch], tree: Tree, arity: int) -> Iterator[pa.RecordBatch]:
    """Per inner node and child: ranges of distances to all split points beside it, and of squared norms (as split point -1)."""
    shape = (1 + arity, arity + 1, arity)
    least, most = np.full(shape, np.inf), np.full(shape, -np.inf)
    for batch in batches:
        rows = np.asarray(unpack(batch.column(0).to_pylist()), np.float64)
        if not len(rows):
            continue
        leaf = batch.column(1).to_numpy()
        for node, child, points in [(0, leaf // arity, tree.top), *[(1 + k, np.where(leaf // arity == k, leaf % arity, -1), p) for k, p in enumerate(tree.below)]]:
            own = np.flatnonzero(child >= 0)
            if not len(own):
                continue
            values = np.sqrt(_squared(points, rows[own]))
            values = np.concatenate([values, np.zeros((len(own), arity - len(points))), (rows[own] ** 2).sum(1)[:, None]], axis=1)
            for c in np.unique(child[own]).tolist():
                part = values[child[own] == c]
                least[node, :, c] = np.minimum(least[node, :, c], part.min(0))
                most[node, :, c] = np.maximum(most[node, :, c], part.max(0))
    node, point, child = np.nonzero(least <= most)
    yield pa.record_batch({"node": pa.array(node, pa.int32()), "point": pa.array(point, pa.int32()), "child": pa.array(child, pa.int32()),
                           "least": pa.array(least[node, point, child]), "most": pa.array(most[node, point, child])})


def _with_ranges(tree: Tree, nodes: DataFrame, arity: int) -> Tree:
    """Ranges over all rows; at most ``arity ** 3`` numbers or so reach the driver."""
    parts = nodes.select("vec", "leaf").mapInArrow(lambda b: _measure(b, tree, arity), "node int, point int, child int, least double, most double")
    rows = parts.groupBy("node", "point", "child").agg(F.min("least").alias("least"), F.max("most").alias("most")).toPandas()
    shape = (1 + arity, arity + 1, arity)
    least, most = np.full(shape, np.inf), np.full(shape, -np.inf)
    least[rows["node"], rows["point"], rows["child"]] = rows["least"]
    most[rows["node"], rows["point"], rows["child"]] = rows["most"]
    tree.near, tree.far, tree.small, tree.large = least[:, :arity], most[:, :arity], least[:, arity], most[:, arity]
    return tree


def _reachable(tree: Tree, node: int, points: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Children of an inner node that each row's windows (``low``, ``high``: rows by windows) may reach: rows by children."""
    norm = (rows ** 2).sum(1)
    to_points = np.sqrt(_squared(points, rows))[:, :, None]
    near, far = tree.near[node, :len(points)][None], tree.far[node, :len(points)][None]
    with np.errstate(invalid="ignore"):
        nearest = np.maximum(np.maximum(to_points - far, near - to_points), 0).max(1)
        farthest = (to_points + far).min(1)
        inner = norm[:, None, None] + tree.small[node][None, None] - 2.0 * high[:, :, None]
        outer = norm[:, None, None] + tree.large[node][None, None] - 2.0 * low[:, :, None]
        inner, outer = np.sqrt(np.maximum(inner, 0)), np.where(outer < 0, -1, np.sqrt(np.maximum(outer, 0)))
        slack = SLACK * (1 + farthest)
        meets = (nearest - slack)[:, None] <= outer
        meets &= inner <= (farthest + slack)[:, None]
    meets &= (low <= high)[:, :, None]
    return meets.any(1) & (tree.small[node] <= tree.large[node])[None]


def visited(tree: Tree, rows: np.ndarray, low: np.ndarray, high: np.ndarray, arity: int) -> list[list[int]]:
    """Leaves that can hold a vector of any window of each row."""
    rows = np.asarray(rows, np.float64)
    out: list[list[int]] = [[] for _ in range(len(rows))]
    top = _reachable(tree, 0, tree.top, rows, low, high)
    for k, points in enumerate(tree.below):
        own = np.flatnonzero(top[:, k]) if k < top.shape[1] else []
        if len(own):
            for i, c in zip(*np.nonzero(_reachable(tree, 1 + k, points, rows[own], low[own], high[own])), strict=True):
                out[own[i]].append(k * arity + int(c))
    return out


def _choose_leaves(batches: Iterator[pa.RecordBatch], tree: Tree, arity: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        windows = batch.column("windows").to_pylist()
        width = max(map(len, windows), default=0)
        low, high = np.full((len(batch), width), 1.0), np.zeros((len(batch), width))
        for i, own in enumerate(windows):
            for k, w in enumerate(own):
                low[i, k], high[i, k] = w["low"], w["high"]
        found = visited(tree, unpack(batch.column("vec").to_pylist()), low, high, arity) if len(batch) else []
        found = [[leaf for leaf in own if leaf != home] for own, home in zip(found, batch.column("leaf").to_pylist(), strict=True)]
        yield batch.append_column("leaves", pa.array(found, pa.list_(pa.int32())))


def _best(scores: np.ndarray, ids: list[list[int]], at: np.ndarray, k: int) -> list[dict]:
    """The first ``k`` ids at ``at`` by score, then id."""
    if len(at) > k:  # the k-th best node bounds what can be among the first k
        bound = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= bound]
    return [{"down": d, "id": i} for d, i in sorted((-int(scores[n]), i) for n in at.tolist() for i in ids[n][:k])[:k]]


def _score_block(table: pa.Table, same: bool, k: int) -> pa.Table:
    """One block of a leaf against one block of queries."""
    asks = np.array([w is not None for w in table["windows"].to_pylist()])
    nodes, queries = table.filter(pa.array(~asks)), table.filter(pa.array(asks))
    found = []
    if len(nodes) and len(queries):
        rows, ids, labels = unpack(nodes["vec"].to_pylist()), nodes["ids"].to_pylist(), nodes["label"].to_numpy()
        step = max(1, (1 << 22) // len(nodes))
        for at in range(0, len(queries), step):
            part = queries[at:at + step]
            scores = products(unpack(part["vec"].to_pylist()), rows)
            for own, key, label, windows in zip(scores, part["key"].to_pylist(), part["label"].to_pylist(), part["windows"].to_pylist(), strict=True):
                fits = (labels == label) == same
                for w in windows:
                    best = _best(own, ids, np.flatnonzero(fits & (own >= w["low"]) & (own <= w["high"])), k)
                    if best:
                        found.append((key, label, w["w"], best))
    columns = list(zip(*found, strict=True)) or [[]] * 4
    best_type = pa.list_(pa.struct([("down", pa.int64()), ("id", pa.int64())]))
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int32(), best_type), strict=True)],
                    names=["key", "label", "w", "best"])


@dataclass
class Index:
    nodes: DataFrame  # key, label, vec, ids, leaf
    tree: Tree
    blocks: dict[int, int]  # blocks of each leaf
    arity: int
    block_rows: int


def build_index(nodes: DataFrame, arity: int = ARITY, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS) -> Index | None:
    """Every node in a leaf. Split points come from the ``sample`` nodes of least key hash; ranges from all nodes."""
    chosen = nodes.orderBy("key", "label").limit(sample).select("vec").toPandas()["vec"].map(bytes).tolist()
    if not chosen:
        return None
    tree = plant(unpack(chosen), arity)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = leaves_of(tree, unpack(batch.column("vec").to_pylist()), arity) if len(batch) else []
            yield batch.append_column("leaf", pa.array(leaf, pa.int32()))

    placed = pin(nodes.mapInArrow(assign, f"{NODE}, leaf int"), "negatives-leaves")
    sizes = {r["leaf"]: -(-r["n"] // block_rows) for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Index(placed, _with_ranges(tree, placed, arity), sizes, arity, block_rows)


def _scored(index: Index, visits: DataFrame, query_blocks: int, same: bool, k: int) -> DataFrame:
    """``key, label, w, best`` of visits (queries with ``leaf`` to read), a row per block that has something."""
    blocks = F.create_map(*[F.lit(x) for pair in sorted(index.blocks.items()) for x in pair])
    group = F.pmod(F.xxhash64("key", "label"), F.lit(query_blocks)).cast("int")
    asked = (visits.withColumn("asked", group)
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.element_at(blocks, F.col("leaf")) - 1))))
    tiles = asked.select("leaf", "asked").distinct()
    held = index.nodes.withColumn("block", F.pmod(F.xxhash64("key"), F.element_at(blocks, F.col("leaf"))).cast("int"))
    columns = ["leaf", "block", "asked", "key", "label", "vec"]
    both = (held.join(tiles, "leaf").select(*columns, "ids", F.lit(None).cast("array<struct<w:int,low:bigint,high:bigint>>").alias("windows"))
            .unionByName(asked.select(*columns, F.lit(None).cast("array<bigint>").alias("ids"), "windows")))
    return both.groupBy("leaf", "block", "asked").applyInArrow(lambda t: _score_block(t, same, k), FOUND)


def _merged(found: DataFrame, k: int) -> DataFrame:
    return found.groupBy("key", "label", "w").agg(F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best"))


def search(index: Index, queries: DataFrame, same: bool, k: int, label: str) -> DataFrame:
    """``key, label, w, best``, pinned: the first ``k`` rows of each window of each query, of the same label or of others.

    Each query first reads its own leaf; what it finds there raises the lower
    ends of its windows. Then it reads the leaves that the ranges can't rule out.
    """
    query_blocks = max(1, -(-queries.count() // index.block_rows))
    near = pin(_merged(_scored(index, queries, query_blocks, same, k), k), f"{label}-near")
    bounds = (near.where(F.size("best") == k).select("key", "label", "w", (-F.element_at("best", -1)["down"]).alias("bound"))
              .groupBy("key", "label").agg(F.map_from_entries(F.collect_list(F.struct("w", "bound"))).alias("bounds")))
    raised = F.transform("windows", lambda w: F.struct(
        w["w"].alias("w"), F.greatest(w["low"], F.coalesce(F.element_at("bounds", w["w"]), w["low"])).alias("low"), w["high"].alias("high")))
    asking = (queries.join(bounds, ["key", "label"], "left").withColumn("windows", F.when(F.col("bounds").isNull(), F.col("windows")).otherwise(raised))
              .select("key", "label", "vec", "leaf", "windows"))
    tree, arity = index.tree, index.arity
    visits = (asking.mapInArrow(lambda b: _choose_leaves(b, tree, arity), f"{QUERY}, leaves array<int>")
              .withColumn("leaf", F.explode("leaves")).drop("leaves"))
    far = _scored(index, pin(visits, f"{label}-visits"), query_blocks, same, k)
    return pin(_merged(near.unionByName(far), k), label)


def hard_negatives(rows: DataFrame, anchor: Column, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
                   arity: int = ARITY, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are inner products of the components ``floor(scale * x)``. For
    each row that ``anchor`` (a condition on the columns of ``rows``) chooses
    and each of its first ``positives`` rows of the same label, the first
    ``negatives`` rows of other labels with a score of ``low`` to ``high`` per
    cent of the positive's; ties go to the smaller id.

    Rows without id or label, with a null vector, or with a null or
    non-finite component take no part. Vectors of different lengths count as
    filled up with zeros; sums beyond 62 bits are held there. Equal vectors
    of one label are indexed once, with as many ids as a result can hold.
    Rows that repeat an id are rows of their own. Other columns don't matter;
    an empty table gives no rows.
    """
    spark = rows.sparkSession
    value = F.col(vector)
    fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    clean = (rows.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & value.isNotNull()).where(fine)
             .select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"),
                     F.transform(value, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("values"),
                     F.coalesce(anchor, F.lit(False)).alias("is_anchor")))
    keep = positives + 1  # one of them may be the anchor itself

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _merge_ids(batches, keep)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [pack(np.array(v, np.int64)) for v in batch.column("values").to_pylist()]
            own = [int(products(v, v)[0, 0]) for v in map(unpack, zip(packed))]
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array(map(xxhash.xxh3_128_digest, packed), pa.binary()),
                                   pa.array(own, pa.int64())], ["vec_id", "label", "key", "own"])

    partial = clean.select("vec_id", "label", "values").mapInArrow(merge, NODE)
    nodes = pin(partial.groupBy("key", "label").agg(
        F.first("vec").alias("vec"), F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, keep).alias("ids"))
        .select("key", "label", "vec", "ids"), "negatives-nodes")
    anchors = pin(clean.where("is_anchor").select("vec_id", "label", "values").mapInArrow(keyed, "vec_id bigint, label bigint, key binary, own bigint"),
                  "negatives-anchors")
    index = build_index(nodes, arity, sample, block_rows)
    if index is None:
        return spark.createDataFrame([], OUTPUT)
    asked = pin(index.nodes.join(anchors.select("key", "label").distinct(), ["key", "label"], "left_semi").select("key", "label", "vec", "leaf"),
                "negatives-queries")
    everything = F.array(F.struct(F.lit(0).alias("w"), F.lit(-UNBOUNDED).alias("low"), F.lit(UNBOUNDED).alias("high")))
    friends = search(index, asked.withColumn("windows", everything), True, keep, "negatives-positives")
    # Scores are numbered from the best one, so a window is known by its place.
    scores = friends.select("key", "label", F.array_distinct(F.transform("best", lambda b: -b["down"])).alias("scores"))
    windows = F.expr(f"""transform(transform(scores, s -> cast(s as decimal(20,0))), (s, i) -> named_struct('w', cast(i as int),
        'low', (s * {low}) div 100 + if(s > 0 and s * {low} % 100 != 0, 1, 0),
        'high', (s * {high}) div 100 - if(s < 0 and s * {high} % 100 != 0, 1, 0)))""")
    hunted = asked.join(scores, ["key", "label"]).select("key", "label", "vec", "leaf", windows.alias("windows"))
    others = search(index, hunted, False, negatives, "negatives-found")
    by_score = others.join(scores, ["key", "label"]).select(
        "key", "label", F.element_at("scores", F.col("w") + 1).alias("positive_score"), F.col("best").alias("negatives"))
    # The anchor is one of the rows with its id and its score with itself; others that share both are rows of their own.
    itself = F.array_position(F.transform("best", lambda b: (b["id"] == F.col("vec_id")) & (b["down"] == -F.col("own"))), True)
    pairs = (anchors.join(friends.select("key", "label", "best"), ["key", "label"])
             .select("key", "label", F.col("vec_id").alias("anchor_id"),
                     F.explode(F.slice(F.filter("best", lambda b, i: i != itself - 1), 1, positives)).alias("p"))
             .select("key", "label", "anchor_id", F.col("p.id").alias("positive_id"), (-F.col("p.down")).alias("positive_score")))
    return (pairs.join(by_score, ["key", "label", "positive_score"])
            .select("anchor_id", "positive_id", "positive_score", F.posexplode("negatives").alias("at", "n"))
            .select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.id").alias("negative_id"),
                    "positive_score", (-F.col("n.down")).alias("negative_score")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 50 == 0)


QUERIES = {"op12_hard_negatives": op12_hard_negatives}
ORACLE = {"op12_hard_negatives": """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                   CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
                   FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 3
"""}
