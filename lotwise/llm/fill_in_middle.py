"""Fill-in-the-middle by piece tables.

A document is a list of descriptors, each naming a span of one of two immutable buffers: its text
or the sentinels. Cutting splits descriptors at a place and copies nothing; an arrangement permutes
the parts and puts sentinel descriptors before them; the inverse permutation brings the parts back
into reading order. Digests and output texts are made by streaming the spans that descriptors name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.batches import sliced, views

SEED = 7
# Hundredths of documents that are transformed, and of those that are in the form spm.
RATE, SPM_RATE = 100, 50
TEXT, SENTINELS = 0, 1
# The sentinels of prefix, suffix and middle, three bytes each.
SENTINEL_BYTES = b"<P><S><M>"
SENTINEL = re.compile(rb"<[PSM]>")
# The parts a form shows, by their place in the document: 0 prefix, 1 middle, 2 suffix.
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
SENTINEL_AT = {0: 0, 2: 3, 1: 6}
PLAIN = "plain"


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


def cut(pieces: list[Piece], place: int) -> tuple[list[Piece], list[Piece]]:
    """The descriptors before and behind ``place``; the one it falls into is split."""
    before, behind = [], []
    for piece in pieces:
        inside = min(max(place, 0), piece.length)
        if inside:
            before.append(Piece(piece.buffer, piece.start, inside))
        if inside < piece.length:
            behind.append(Piece(piece.buffer, piece.start + inside, piece.length - inside))
        place -= piece.length
    return before, behind


def parted(pieces: list[Piece], first: int, second: int) -> list[list[Piece]]:
    """Prefix, middle and suffix of a table cut at two places in order."""
    head, suffix = cut(pieces, second)
    prefix, middle = cut(head, first)
    return [prefix, middle, suffix]


def arranged(parts: list[list[Piece]], form: str) -> list[Piece]:
    """The parts in the order of ``form``, a sentinel before each."""
    table = []
    for part in ORDERS[form]:
        table += [Piece(SENTINELS, SENTINEL_AT[part], 3), *parts[part]]
    return table


def restored(parts: list[list[Piece]], form: str) -> list[Piece]:
    """Parts shown in the order of ``form``, brought back into reading order."""
    back = np.argsort(ORDERS[form])
    return [piece for shown in back for piece in parts[shown]]


def shown_parts(output: memoryview, form: str) -> list[list[Piece]]:
    """The parts that an output shows, as descriptors of its own bytes."""
    parts, start = [], 0
    for part in ORDERS[form]:
        sentinel = SENTINEL_BYTES[SENTINEL_AT[part] : SENTINEL_AT[part] + 3]
        found = re.compile(re.escape(sentinel)).search(output, start)
        if found is None or (not parts and found.start()):
            raise ValueError(f"no output of the form {form}")
        if parts:
            parts[-1] = (parts[-1][0], found.start())
        parts.append((found.end(), len(output)))
        start = found.end()
    return [[Piece(TEXT, first, last - first)] for first, last in parts]


def spans(pieces: Iterable[Piece], buffers: tuple[memoryview, memoryview]) -> Iterator[memoryview]:
    for piece in pieces:
        yield buffers[piece.buffer][piece.start : piece.start + piece.length]


def digest(pieces: Iterable[Piece], buffers: tuple[memoryview, memoryview]) -> str:
    """Lowercase hex SHA-256 of the bytes that the descriptors name."""
    hashed = hashlib.sha256()
    for span in spans(pieces, buffers):
        hashed.update(span)
    return hashed.hexdigest()


def code_points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def draws(seed: int, name: object) -> list[int]:
    """Four numbers below 2^32 that a document's identifier decides."""
    spelled = "" if name is None else str(name)
    hexed = hashlib.sha256(f"{seed}:{spelled}".encode()).hexdigest()
    return [int(hexed[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(text: memoryview, name: object, seed: int, rate: int, spm_rate: int) -> tuple:
    """Number of lines, form, code points of prefix and middle, and the piece table of the output."""
    data = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(data == 0x0A) + 1
    if len(data) and data[-1] != 0x0A:
        ends = np.append(ends, len(data))
    n = len(ends)
    h1, h2, h3, h4 = draws(seed, name)
    whole = [Piece(TEXT, 0, len(data))]
    if not n or SENTINEL.search(text) or h3 % 100 >= rate:
        return n, PLAIN, None, None, whole
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, second = (int(ends[k - 1]) if k else 0 for k in (first, second))
    form = "spm" if h4 % 100 < spm_rate else "psm"
    table = arranged(parted(whole, first, second), form)
    return n, form, code_points(data[:first]), code_points(data[first:second]), table


PIECES = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))
FIELDS = (
    "n long, form string, prefix_chars long, middle_chars long,"
    " pieces array<struct<buffer int, start long, length long>>, output string, output_sha256 string"
)
TYPES = (pa.int64(), pa.string(), pa.int64(), pa.int64(), PIECES, pa.large_string(), pa.string())
NAMES = ("n", "form", "prefix_chars", "middle_chars", "pieces", "output", "output_sha256")


def _transformed(seed: int, rate: int, spm_rate: int):
    sentinels = memoryview(SENTINEL_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            columns = [[] for _ in NAMES]
            for name, text in zip(batch.column(1).to_pylist(), views(batch.column(0))):
                *found, table = transform(text, name, seed, rate, spm_rate)
                output = b"".join(spans(table, (text, sentinels)))
                row = (*found, [p._asdict() for p in table], output, digest(table, (text, sentinels)))
                for column, value in zip(columns, row):
                    column.append(value)
            columns[5] = pa.array(columns[5], pa.large_binary())
            made = [c.cast(t) if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, TYPES)]
            yield pa.RecordBatch.from_arrays([batch.column(1), *made], ["_id", *NAMES])

    return run


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n`` (lines), ``form``, ``prefix_chars``,
    ``middle_chars``, ``pieces`` (the piece table, in bytes), ``output`` and ``output_sha256``.

    Documents are cut at two line ends that the SHA-256 of seed and identifier draws; ``rate``
    hundredths of them are transformed, ``spm_rate`` hundredths of those show the suffix first. A
    null text is an empty one. Empty texts and texts that hold a sentinel stay plain: their output
    is the text and both counts are null. A null identifier is drawn for as an empty one, repeated
    rows come out alike, an empty table gives no rows, and columns other than the two named are
    not read. A text of any length is handled whole, its lines are never held one by one.
    """
    rows = docs.select(F.col(text).alias("_text"), F.col(id_col).alias("_id"))
    kind = rows.schema["_id"].dataType.simpleString()
    made = rows.mapInArrow(_transformed(seed, rate, spm_rate), f"_id {kind}, {FIELDS}")
    return made.select(F.col("_id").alias(id_col), *NAMES)


def rebuild(output: memoryview, form: str | None) -> list[Piece]:
    """The piece table, over the bytes of ``output``, of the text it was made from."""
    if form is None or form == PLAIN:
        return [Piece(TEXT, 0, len(output))]
    return restored(shown_parts(output, form), form)


def _restored(keep_text: bool):
    nothing = memoryview(b"")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts, digests = [], []
            for output, form in zip(views(batch.column(0)), batch.column(1).to_pylist()):
                table = rebuild(output, form)
                texts.append(b"".join(spans(table, (output, nothing))) if keep_text else None)
                digests.append(digest(table, (output, nothing)))
            restored_text = pa.array(texts, pa.large_binary()).cast(pa.large_string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), restored_text, pa.array(digests, pa.string())],
                ["_row", "restored", "restored_sha256"],
            )

    return run


def restore_documents(
    rows: DataFrame, output: str = "output", form: str = "form", keep_text: bool = True
) -> DataFrame:
    """``rows`` with ``restored``, the exact text that each output was made from, and
    ``restored_sha256`` in place of the output.

    Only output and form are used. A null form is a plain one and a null output an empty text; an
    output that is not of its form is an error. Without ``keep_text`` the text stays null. Columns
    of ``rows`` named like the two new ones are replaced.
    """
    taken = {output.lower(), "restored", "restored_sha256"}
    kept = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c.lower() not in taken]).alias("_row")
    given = rows.select(F.col(output).alias("_output"), F.col(form).alias("_form"), kept)
    fields = f"_row {given.schema['_row'].dataType.simpleString()}, restored string, restored_sha256 string"
    made = given.mapInArrow(_restored(keep_text), fields)
    return made.select("_row.*", "restored", "restored_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("pieces")
    return restore_documents(made, keep_text=False).drop("restored")


ORACLE = """
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h,
        regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units
    FROM documents
), drawn AS (
    SELECT doc_id, text, units, len(units) AS n,
        CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
    FROM units
), formed AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
            OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT doc_id, n, form, text,
        CASE WHEN form = 'plain' THEN NULL WHEN a = 0 THEN '' ELSE array_to_string(units[1:a], '') END AS pre,
        CASE WHEN form = 'plain' THEN NULL WHEN a = b THEN '' ELSE array_to_string(units[a + 1:b], '') END AS mid,
        CASE WHEN form = 'plain' THEN NULL WHEN b = n THEN '' ELSE array_to_string(units[b + 1:n], '') END AS suf
    FROM formed
), made AS (
    SELECT doc_id, n, form, length(pre) AS prefix_chars, length(mid) AS middle_chars,
        CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
            ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS output
    FROM parts
), placed AS (
    SELECT *, strpos(output, '<P>') AS p, strpos(output, '<S>') AS s, strpos(output, '<M>') AS m FROM made
)
SELECT doc_id, n, form, prefix_chars, middle_chars, sha256(output) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN output
        WHEN 'psm' THEN substr(output, 4, s - 4) || substr(output, m + 3) || substr(output, s + 3, m - s - 3)
        ELSE substr(output, p + 3, m - p - 3) || substr(output, m + 3) || substr(output, 4, p - 4) END)
        AS restored_sha256
FROM placed
"""
