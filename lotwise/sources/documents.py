"""Reading a published document in parallel, line by line.

The text of a document is one JSON object over many lines and files, each line holding one leaf or
one override, so a line alone does not say under which keys it stands. That is found by a segmented
scan: lines are scanned within the block of the file they were read from, all blocks at once; what
a block leaves open is summed up in one row, carried over the blocks of a file and then over the
files; and every line is completed with the keys carried to it. No task sees more than a block of
lines, and only the last step, with one row a file, is not split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from lotwise.sources.staging import stage

# A document nests bidder, continent and country; below them a line is whole.
LEVELS = 3
# A JSON string, and one that names an object.
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
OPENED = rf"({STRING}):\{{"

SEGMENT = ("file", "block")


def _earlier(key: Sequence[str], place: str) -> WindowSpec:
    """The rows of a key before each."""
    return Window.partitionBy(*key).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)


def _in_block() -> WindowSpec:
    return _earlier(SEGMENT, "place")


def _in_file() -> WindowSpec:
    return _earlier(["file"], "block")


def _of_files() -> WindowSpec:
    return _earlier([], "file")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a file or folder: ``file``, ``block`` and ``place`` give their order."""
    lines = spark.read.text(path)
    return lines.select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )


def _braces(bare: Column, brace: str) -> Column:
    return F.length(bare) - F.length(F.replace(bare, F.lit(brace), F.lit("")))


def _measured(lines: DataFrame) -> DataFrame:
    """Lines without what joins them to the one before, with the keys each opens, how many more
    objects it opens than it closes, and the sum of that over earlier lines of its block."""
    body = F.regexp_replace("line", r"^[{,]", "")
    bare = F.regexp_replace("body", STRING, "")
    found = lines.select(*SEGMENT, "place", body.alias("body")).withColumns(
        {"opened": F.regexp_extract_all("body", F.lit(OPENED), F.lit(1)), "bare": bare}
    )
    net = _braces(F.col("bare"), "{") - _braces(F.col("bare"), "}")
    before = F.coalesce(F.sum("net").over(_in_block()), F.lit(0))
    return found.withColumn("net", net).drop("bare").withColumn("before", before)


def _depths(lines: DataFrame) -> DataFrame:
    """The depth at which every block begins."""
    blocks = lines.groupBy(*SEGMENT).agg(F.sum("net").alias("net"))
    files = blocks.groupBy("file").agg(F.sum("net").alias("net"))
    start = files.select("file", F.sum("net").over(_of_files()).alias("_start"))
    inside = F.sum("net").over(_in_file())
    depth = F.coalesce("_start", F.lit(0)) + F.coalesce("_inside", F.lit(0))
    return blocks.withColumn("_inside", inside).join(start, "file").select(*SEGMENT, depth.alias("depth"))


def _level(n: int) -> str:
    return f"key_{n}"


def _levels() -> list[str]:
    return [_level(n) for n in range(LEVELS)]


def _last(name: str, window: WindowSpec) -> Column:
    return F.last(name, ignorenulls=True).over(window)


def _carried(lines: DataFrame) -> DataFrame:
    """The key last opened at every level before a block begins."""
    def ends(df: DataFrame, key: tuple[str, ...], place: str) -> DataFrame:
        own = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(place))).alias(c) for c in _levels()]
        return df.groupBy(*key).agg(*own)

    blocks = ends(lines, SEGMENT, "place")
    files = ends(blocks, ("file",), "block")
    start = files.select("file", *[_last(c, _of_files()).alias(f"_start_{c}") for c in _levels()])
    inside = blocks.select(*SEGMENT, *[_last(c, _in_file()).alias(f"_inside_{c}") for c in _levels()])
    carried = [F.coalesce(f"_inside_{c}", f"_start_{c}").alias(f"carried_{c}") for c in _levels()]
    return inside.join(start, "file").select(*SEGMENT, *carried)


def completed_lines(lines: DataFrame) -> DataFrame:
    """Every line as an object of its own, under all keys it stands under: ``text``."""
    measured = stage(_measured(lines), "measured-lines")
    placed = measured.join(_depths(measured), list(SEGMENT))
    placed = placed.withColumn("depth", F.col("depth") + F.col("before"))
    keys = {_level(n): F.get("opened", F.lit(n) - F.col("depth")) for n in range(LEVELS)}
    placed = placed.withColumns(keys)
    scanned = placed.withColumns({f"_{c}": _last(c, _in_block()) for c in _levels()})
    scanned = scanned.join(_carried(placed), list(SEGMENT))
    path = [
        F.when(F.col("depth") > n, F.concat(F.coalesce(f"_{c}", f"carried_{c}"), F.lit(":{"))).otherwise("")
        for n, c in enumerate(_levels())
    ]
    closed = F.repeat(F.lit("}"), F.greatest(F.lit(0), 1 + F.col("depth") + F.col("net")).cast("int"))
    return scanned.select(F.concat(F.lit("{"), *path, F.col("body"), closed).alias("text"))


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """A document that ``write_document`` wrote, a file or a folder, as (bidder, document) with a
    row for every leaf or override; ``unfold_rates`` flattens them like whole documents.

    Calling it runs a job: the lines are written once with what each opens and closes.
    """
    objects = completed_lines(text_lines(spark, path)).select(F.parse_json("text").alias("object"))
    members = spark.tvf.variant_explode(F.col("object").outer()).alias("member")
    return objects.lateralJoin(members).select(
        F.col("member.key").alias("bidder"), F.col("member.value").alias("document")
    )
