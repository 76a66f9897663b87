"""Best-fit packing: sum-of-squares placement of documents into sequences of a fixed length.

Let N(g) be the number of open sequences with g free places. Each document goes where the sum of
all N(g) squared becomes smallest: into an open sequence of some gap, of equally good ones the
one it fits best. A sequence is opened only if none has room. Documents come longest first.

Sum of squares needs the counts of everything placed before, so it runs inside groups of pieces
of a bounded number, dealt by a hash of their place. A group of this size ends within one or two
sequences of the total length divided by the capacity.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.batches import small_batches
from lotwise.sources.staging import stage

CAPACITY = 2048
SEPARATOR = 0
# The special token of the vocabulary, as text and id.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
PIECES_PER_GROUP = 32768
CACHED_CHUNKS = 400_000
# What the vocabulary's pattern takes for white space. It steps back over runs of it
# and overflows at about a million characters, so long runs are cut by its rule beforehand.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG = 10_000
LONG_RUN = re.compile(f"(?<![{_WHITE}])[{_WHITE}]{{{LONG},}}+")


class ChunkIds(dict):
    """Ids of a space and the chunk after it, as little-endian unsigned 32-bit bytes.

    None for a chunk that cannot be encoded alone, because white space touches the space.
    """

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def whole(self, text: str) -> bytes:
        if len(text) < LONG:
            return np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()
        ids, at = [], 0
        for run in LONG_RUN.finditer(text):
            # A run is one piece without its last character, which goes with what follows it.
            end = run.end() - (run.end() < len(text))
            ids += self.encoding.encode_ordinary(text[at : run.start()])
            ids += self.encoding._encode_single_piece(text[run.start() : end])
            at = end
        ids += self.encoding.encode_ordinary(text[at:])
        return np.array(ids, dtype="<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes | None:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            ids = None
        else:
            ids = self.whole(" " + chunk)
        if len(self) >= CACHED_CHUNKS:
            self.clear()
        self[chunk] = ids
        return ids

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens.

        A piece of the vocabulary's pattern never crosses the boundary before a single space
        between two characters that are not white space, so chunks are encoded one by one.
        """
        first, *chunks = text.split(" ")
        if not first[-1:].isspace():
            try:
                return self.whole(first) + b"".join(map(self.__getitem__, chunks))
            except TypeError:  # some chunk is None
                pass
        return self.whole(text)

    def ids(self, text: str) -> bytes:
        special = array("I", [SPECIAL_ID]).tobytes()
        return special.join(map(self.plain, text.split(SPECIAL))) if SPECIAL in text else self.plain(text)


_encoders: dict[str, ChunkIds] = {}


def encoder(path: str) -> ChunkIds:
    """One per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = ChunkIds(path)
    return _encoders[path]


PIECE_FIELDS = "piece int, start long, length long, ids_crc32 long"


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, bytes]]:
    """Start and ids of each piece: the first may be shorter, the others are full."""
    size = len(ids) // 4
    end = (size - 1) % capacity + 1
    start = 0
    while start < size:
        yield start, ids[4 * start : 4 * end]
        start, end = end, end + capacity


def _pieces(path: str, capacity: int, keep_ids: bool):
    separator = array("I", [SEPARATOR]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            names, parts = [], {"piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = own.ids(text or "") + separator
                for piece, (start, part) in enumerate(cut(ids, capacity)):
                    names.append(row)
                    parts["piece"].append(piece)
                    parts["start"].append(start)
                    parts["length"].append(len(part) // 4)
                    parts["ids_crc32"].append(zlib.crc32(part))
                    parts["ids"].append(part if keep_ids else None)
            types = {"piece": pa.int32(), "ids": pa.binary()}
            columns = {k: pa.array(v, types.get(k, pa.int64())) for k, v in parts.items()}
            yield pa.RecordBatch.from_pydict({"_id": batch.column(0).take(pa.array(names, pa.int64())), **columns})

    return run


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, placed in the given order."""
    counts = np.zeros(capacity + 1)
    counts[0] = -0.5  # a sequence that becomes full counts no more
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    opened = 0
    for i, size in enumerate(lengths.tolist()):
        gaps = counts[size:capacity]
        growth = np.where(gaps > 0, counts[: capacity - size] - gaps, np.inf)
        best = int(growth.argmin()) if len(growth) else 0
        if len(growth) and growth[best] < np.inf:
            gap = best + size
            place = open_at[gap].pop()
            counts[gap] -= 1
        else:
            gap, place = capacity, opened
            opened += 1
        sequence[i], offset[i] = place, capacity - gap
        if gap > size:
            counts[gap - size] += 1
            open_at[gap - size].append(place)
    return sequence, offset


def _placed(capacity: int):
    def run(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "_id", "piece"], ascending=[False, True, True], kind="stable")
        sequence, offset = sum_of_squares(pieces["length"].to_numpy(), capacity)
        return pieces.assign(sequence_id=sequence + (int(key[0]) << 32), offset=offset)

    return run


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    tokenizer_path: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id`` and ``offset``, and with ``keep_ids`` the ``ids`` as little-endian bytes.

    A document is its tokens and one separator; a null text is an empty one, so its document is
    the separator alone. Only documents longer than ``capacity`` are cut. Pieces of a sequence
    follow each other without gaps from offset 0. Repeated rows are packed once each, ties in
    length go by identifier and piece; an empty table gives no rows, and columns other than the
    two named are not read. ``tokenizer_path`` names a file of byte-pair ranks that every
    executor can open.
    """
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    fields = f"_id {kind}, {PIECE_FIELDS}, ids binary"
    with small_batches(docs.sparkSession):
        pieces = stage(rows.mapInArrow(_pieces(path, capacity, keep_ids), fields), "pieces")
    groups = max(1, -(-pieces.count() // PIECES_PER_GROUP))
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    dealt = pieces.withColumn("_group", F.pmod(place, F.lit(groups)))
    packed = dealt.groupBy("_group").applyInPandas(
        _placed(capacity), f"{fields}, _group long, sequence_id long, offset long"
    )
    shown = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return packed.select(F.col("_id").alias(id_col), *shown, *["ids"] * keep_ids)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
