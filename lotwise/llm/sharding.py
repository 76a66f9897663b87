"""Sharding: a k-d tree over the metadata of documents, cut at weighted medians.

Points are groups of equal texts, weighted by their bytes. A node with several leaves is cut
along its widest dimension so that both sides weigh as much as their leaves should. All nodes of
a level are cut together: their weights are summed into bins of the leading bits of the cut key,
and the bin with the median is refined until its weight no longer matters. One row per node
reaches the driver, so what it holds grows with the number of shards and not with the rows.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.sources.staging import stage

SCALE_BITS = 31
BIN_BITS = 11
SHIFTS = (52, 41, 30, 19, 8, 0)
# Shares of a shard's target: a bin that is fine enough, a group that is placed last, and a
# piece of a group too large for one shard.
FINE, HEAVY, PIECE = 0.0005, 0.02, 0.01
ROWS_PER_BUCKET = 200_000


def code(value: Column, skipped: int = 0) -> Column:
    """The first six bytes of a string behind ``skipped`` ones, as a number with the order of
    strings that agree in those; null is 0."""
    head = F.substring(F.encode(F.coalesce(value, F.lit("")), "UTF-8"), skipped + 1, 6)
    return F.conv(F.rpad(F.hex(head), 12, "0"), 16, 10).cast("double")


def codes(docs: DataFrame, names: list[str]) -> dict[str, Column]:
    """The codes of string columns, each behind the bytes that all its values begin with: those
    that its smallest and its largest value have in common."""
    ends = docs.agg(*[f(F.encode(F.col(c), "UTF-8")) for c in names for f in (F.min, F.max)]).first()
    common = [len(commonprefix([bytes(e or b"") for e in ends[i : i + 2]])) for i in range(0, len(ends), 2)]
    return {c: code(F.col(c), skipped) for c, skipped in zip(names, common)}


def _ledger(docs: DataFrame, id_col: str, text: str, dims: dict[str, Column]) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.when(F.col(text).isNull(), 0).otherwise(F.octet_length(text)).cast("long").alias("_bytes"),
        F.crc32(F.encode(body, "UTF-8")).alias("_crc"),
        F.unhex(F.sha2(body, 256)).alias("_group"),
        *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"_d{i}") for i, c in enumerate(dims.values())],
    ).withColumn("_size", F.col("_bytes") + 1)
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    return stage(rows, "shard-ledger").withColumn("_place", place)


def _chunk(groups: DataFrame, ledger: DataFrame, target: float) -> DataFrame:
    """The ledger with ``_chunk``: 0, or the piece of a group that outweighs a shard.

    Fewer groups than shards outweigh one, which bounds what is broadcast.
    """
    large = groups.filter(F.col("_weight") > target)
    pieces = F.ceil(F.col("_weight") / F.lit(PIECE * target)).cast("long").alias("_pieces")
    split = ledger.join(F.broadcast(large.select("_group", pieces)), "_group", "left")
    chunk = F.coalesce(F.pmod("_place", "_pieces"), F.lit(0).cast("long"))
    return split.withColumn("_chunk", chunk).drop("_pieces")


def _points(rows: DataFrame, dims: int) -> DataFrame:
    return rows.groupBy("_group", "_chunk").agg(
        F.sum("_size").alias("_weight"), *[F.min(f"_d{i}").alias(f"_d{i}") for i in range(dims)]
    )


def _scaled(points: DataFrame, dims: int, target: float) -> DataFrame:
    """Points with every dimension scaled to whole numbers, and the tie-breaking hash.

    Groups that weigh a noticeable part of a shard sort behind all others in every dimension,
    so that a median seldom falls on one.
    """
    low_high = points.agg(
        *[f(f"_d{i}") for i in range(dims) for f in (F.min, F.max)]
    ).first()
    top = (1 << SCALE_BITS) - 1
    scaled = []
    for i in range(dims):
        low, high = low_high[2 * i] or 0.0, low_high[2 * i + 1] or 0.0
        part = (F.col(f"_d{i}") - low) / (high - low) if high > low else F.lit(0.0)
        scaled.append(F.floor(part * top).cast("long").alias(f"_d{i}"))
    heavy = F.col("_weight") > HEAVY * target
    tie = F.shiftrightunsigned(F.xxhash64("_group", "_chunk"), 64 - SCALE_BITS)
    return points.select(
        "_group", "_chunk", "_weight", *scaled, tie.alias("_tie"), heavy.alias("_heavy"),
        F.lit(0).alias("_node"),
    )


def _key(dims: int) -> Column:
    """The sort key of a point along the dimension ``_dim`` of its node, 63 bits."""
    value = reduce(
        lambda rest, i: F.when(F.col("_dim") == i, F.col(f"_d{i}")).otherwise(rest),
        range(1, dims),
        F.col("_d0"),
    )
    front = F.lit(1 << SCALE_BITS).cast("long") * F.col("_heavy").cast("long")
    return F.shiftleft(front.bitwiseOR(value), SCALE_BITS).bitwiseOR(F.col("_tie"))


def _widest(points: DataFrame, nodes: dict[int, int], dims: int) -> dict[int, tuple[int, int]]:
    """Of each node with rows: its widest dimension, the first of equally wide, and its weight."""
    spans = [(F.max(f"_d{i}") - F.min(f"_d{i}")).alias(f"_d{i}") for i in range(dims)]
    found = points.groupBy("_node").agg(F.sum("_weight").alias("_weight"), *spans).collect()
    return {
        r["_node"]: (max(range(dims), key=lambda i: (r[f"_d{i}"], -i)), r["_weight"])
        for r in found
        if nodes.get(r["_node"], 1) > 1
    }


def _medians(points: DataFrame, wanted: dict[int, tuple[int, float]], dims: int, fine: float) -> dict[int, int]:
    """The cut key of each node, given its dimension and the weight its left side should have."""
    spark = points.sparkSession
    cuts: dict[int, int] = {}
    # Of each open node: dimension, leading bits of the key found so far, weight still wanted.
    open_nodes = {node: (dim, 0, goal) for node, (dim, goal) in wanted.items()}
    for step, shift in enumerate(SHIFTS):
        if not open_nodes:
            break
        rows = [(n, d, prefix, float(goal)) for n, (d, prefix, goal) in open_nodes.items()]
        table = spark.createDataFrame(rows, "_node int, _dim int, _prefix long, _goal double")
        keyed = points.join(F.broadcast(table), "_node").withColumn("_key", _key(dims))
        if step:
            keyed = keyed.filter(F.shiftright("_key", SHIFTS[step - 1]) == F.col("_prefix"))
        bins = keyed.groupBy("_node", "_goal", F.shiftright("_key", shift).alias("_bin")).agg(
            F.sum("_weight").alias("_weight")
        )
        upto = F.sum("_weight").over(Window.partitionBy("_node").orderBy("_bin"))
        reached = bins.withColumn("_upto", upto).filter("_upto >= _goal").groupBy("_node")
        for r in reached.agg(F.min(F.struct("_bin", "_weight", "_upto", "_goal")).alias("x")).collect():
            found, dim = r["x"], open_nodes.pop(r["_node"])[0]
            before = found["_upto"] - found["_weight"]
            if shift and found["_weight"] > fine:
                open_nodes[r["_node"]] = (dim, found["_bin"], found["_goal"] - before)
            else:
                nearer = found["_goal"] - before > found["_upto"] - found["_goal"]
                cuts[r["_node"]] = (found["_bin"] + nearer) << shift
    return cuts


def _moved(points: DataFrame, cuts: list[tuple[int, int, int, int]], dims: int) -> DataFrame:
    spark = points.sparkSession
    table = spark.createDataFrame(cuts, "_node int, _dim int, _cut decimal(20,0), _right int")
    joined = points.join(F.broadcast(table), "_node", "left")
    node = F.when(_key(dims) >= F.col("_cut"), F.col("_right")).otherwise(F.col("_node"))
    return joined.withColumn("_node", node).drop("_dim", "_cut", "_right")


def kd_tree(points: DataFrame, shards: int, dims: int, target: float) -> DataFrame:
    """Points with the number of their leaf as ``_node``."""
    nodes = {0: shards}  # first leaf -> leaves below it
    while any(n > 1 for n in nodes.values()):
        widest = _widest(points, nodes, dims)
        wanted = {
            node: (dim, weight * (nodes[node] // 2) / nodes[node])
            for node, (dim, weight) in widest.items()
        }
        cuts = _medians(points, wanted, dims, FINE * target)
        moves = [(n, widest[n][0], cut, n + nodes[n] // 2) for n, cut in cuts.items()]
        if moves:
            points = _moved(points, [(n, d, Decimal(c), r) for n, d, c, r in moves], dims)
        nodes = {
            first: leaves
            for node, n in nodes.items()
            for first, leaves in (((node, n // 2), (node + n // 2, n - n // 2)) if n > 1 else ((node, n),))
        }
    return points


def _slots(rows: DataFrame) -> DataFrame:
    """Numbers from 0 within each shard, counted in buckets so that no task sees a whole shard."""
    buckets = max(1, -(-rows.count() // ROWS_PER_BUCKET))
    rows = rows.withColumn("_bucket", F.pmod("_place", F.lit(buckets)))
    counts = rows.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("_id", "_place"))
    numbered = rows.withColumn("_own", own).join(starts, ["shard", "_bucket"])
    return numbered.withColumn("slot", (F.col("_start") + F.col("_own") - 1).cast("long"))


def shard_documents(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dims: dict[str, Column] | None = None,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every row of ``docs`` as ``id_col``, ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Give either the number of shards or their ``target_bytes``. ``size`` is the bytes of the text
    plus 1; a null text has none and counts as empty. Shards weigh nearly the same; ``slot``
    numbers the rows of a shard from 0 without gaps. Rows with equal texts share a shard, unless
    they weigh more than a shard should: such a group is cut into pieces by the place of its
    rows. Null metadata sorts first. Repeated rows are all kept, each with a slot of its own; an
    empty table gives no rows, and with fewer groups than shards some shards stay empty. Other
    columns are not read.
    """
    if dims is None:
        dims = {"size": F.octet_length(text), **codes(docs, ["lang", "source"]), "id": F.col(id_col)}
    n = len(dims)
    ledger = _ledger(docs, id_col, text, dims)
    total = ledger.agg(F.sum("_size")).first()[0] or 0
    if shards is None:
        shards = max(1, -(-total // target_bytes))
    target = total / shards
    groups = ledger.groupBy("_group").agg(F.sum("_size").alias("_weight"))
    rows = _chunk(stage(groups, "shard-groups"), ledger, target)
    points = stage(_points(rows, n), "shard-points")
    points = stage(_scaled(points, n, target), "shard-scaled")
    leaves = kd_tree(points, shards, n, target)
    placed = rows.join(
        leaves.select("_group", "_chunk", F.col("_node").alias("shard")), ["_group", "_chunk"]
    )
    placed = stage(placed.select("_id", "_size", "_crc", "_place", "shard"), "shard-placed")
    return _slots(placed).select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        "shard",
        "slot",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard_documents(docs, shards=16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
