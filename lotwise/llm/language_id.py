"""Language ID by compression: the language whose dictionary encodes a text in the fewest bytes.

Of every language a bounded sample of labelled texts becomes a zstandard raw-content dictionary.
A text is lower-cased, runs of signs and digits are made one space, and every block of it is
compressed alone with every dictionary, so that all of a long text speaks for its language and
not only its beginning. The smallest sum of sizes wins; the margin is what it saves against the
second smallest, as a part of that.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The bounds of what is learned of a language: rows, and characters of each.
SAMPLE_ROWS, SAMPLE_CHARS = 200, 2000
BLOCK, SHORT = 512, 256
LEVEL, MIN_MATCH = 5, 4
UNKNOWN = "und"
NARROW = 0.002

_NOISE = re.compile(r"[\W\d_]{2,}|[\d_]+")
_ASCII_LETTER = re.compile("[A-Za-z]")


def plain(text: str) -> str:
    return _NOISE.sub(" ", text.lower())


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text)


def blocks(text: str) -> list[bytes]:
    """A short text is encoded once from each of its bytes on, round its end and repeated: its copies
    cost next to nothing, and the sum tells dictionaries apart where one size in bytes cannot."""
    data = plain(text).encode("utf-8", "surrogatepass")
    if len(data) < SHORT:
        ring = b" " + data.strip()
        step = 1 + len(ring) // 32
        times = 2 + 64 // len(ring)
        return [(ring[i:] + ring[:i]) * times for i in range(0, len(ring), step)]
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def learn(
    labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id"
) -> dict[str, bytes]:
    """The dictionary of every language in ``labelled``, in order of its name.

    At most ``SAMPLE_ROWS`` different beginnings of ``SAMPLE_CHARS`` characters are taken of a
    language, those of the rows with the smallest hashed ``key``. Rows without a language or
    without text teach nothing. Hash thresholds from the number of rows of each language keep
    what is sorted small; the languages themselves reach the driver.
    """
    part = F.substring(text, 1, SAMPLE_CHARS)
    rows = labelled.filter(F.col(lang).isNotNull() & (F.length(text) > 0))
    rows = rows.select(F.col(lang).alias("_lang"), F.xxhash64(key).alias("_hash"), part.alias("_part"))
    counts = rows.groupBy("_lang").count().collect()
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for r in counts for x in (r[0], 4.0 * SAMPLE_ROWS / r[1])])
    chance = F.shiftrightunsigned("_hash", 11) / F.lit(float(1 << 53))
    few = rows.filter(chance < share[F.col("_lang")]).groupBy("_lang", "_part").agg(F.min("_hash").alias("_hash"))
    place = F.row_number().over(Window.partitionBy("_lang").orderBy("_hash", "_part"))
    taken = few.withColumn("_place", place).filter(F.col("_place") <= SAMPLE_ROWS)
    parts: dict[str, list[str]] = {r["_lang"]: [] for r in sorted(counts, key=lambda r: r["_lang"])}
    for r in taken.orderBy("_lang", "_place").collect():
        parts[r["_lang"]].append(plain(r["_part"]))
    return {name: "\n".join(own).encode() for name, own in parts.items() if own}


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL,
        source_size=BLOCK,
        dict_size=len(content),
        min_match=MIN_MATCH,
        write_content_size=False,
        write_checksum=False,
    )
    words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    words.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=words, compression_params=parameters)


def classify(text: str | None, compressors: dict) -> tuple[str, float]:
    """Language and margin; equal sizes go to the language first by name."""
    if not text or not compressors or not has_letter(text):
        return UNKNOWN, 0.0
    parts = blocks(text)
    sizes = sorted(
        (sum([len(own.compress(p)) for p in parts]), name) for name, own in compressors.items()
    )
    margin = 1 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0
    return sizes[0][1], margin


def predicted(text: Column, model: dict[str, bytes]) -> Column:
    """A struct of ``lang`` and ``margin`` for a column of texts."""
    spark = SparkSession.getActiveSession()
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, margin double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = {name: _compressor(content) for name, content in shared.value.items()}
        for texts in batches:
            yield pd.DataFrame([classify(t, own) for t in texts], columns=["lang", "margin"])

    return run(text)


def identify(
    docs: DataFrame, model: dict[str, bytes], text: str = "text", narrow: float = NARROW
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``.

    ``score`` is the margin, from 0 to 1; 1 with a single learned language. A row is rejected if
    its text is null, empty or without any letter, or if nothing was learned (``und``, score 0),
    or if its margin is below ``narrow``. Repeated rows are judged alike; columns of ``docs``
    named like the results are replaced. Only the text is read for a prediction, all of it.
    """
    found = docs.withColumn("_found", predicted(F.col(text), model))
    unsure = (F.col("_found.lang") == UNKNOWN) | (F.col("_found.margin") < narrow)
    results = {
        "lang_pred": F.col("_found.lang"),
        "score": F.col("_found.margin"),
        "rejected": unsure,
    }
    return found.withColumns(results).drop("_found")


def held_out(key: Column) -> Column:
    """The fold that nothing is learned from. Rows without a key are not in it."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def model_of(docs: DataFrame) -> dict[str, bytes]:
    return learn(docs.filter(~held_out(F.col("doc_id"))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return identify(fold, model_of(docs)).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected"
    )
