"""Line dedup: lines fall through a tree of fixed depth to templates; recurring ones are dropped.

A line is cut into tokens at white space, and tokens with a digit are variable from the start. The
first level of the tree is the number of tokens, the next ones are the leading tokens. In each
leaf the tokens are counted by position over its documents: one that holds a majority stays
constant, every other position becomes variable. If enough positions are constant this is a
template of the leaf, lines that agree with it on nearly all of them belong to it, and the lines
left are counted anew. If there is no such template the leaf is split, each line going with the
most frequent token it has, until no part has two different lines. A line without a template is
one of its own. A template found in several documents is dropped from all but the first of them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.rows import PLACE, located
from lotwise.sources.staging import stage

DEPTH = 3
MIN_DOCS = 2
# Tenths of the positions that are constant in a template, and that may differ in a line of it.
CONSTANT, DIFFERENT = 8, 2
SPACE = " \t\x0b\x0c\r"
_SPACE = r" \t\x0B\f\r"
VARIABLE = "<*>"
# Tokens a part is split by at once; lines with none of them stay together and are split next.
RANKED = 64
# Fixed value: matches texts without a digit, in one greedy run.
NO_DIGIT = r"\A[^0-9]*\z"


def masked(text: Column) -> Column:
    """A text of any number of lines, its tokens with digits made variable.

    The pattern starts at the start of a token only and never steps back, so it is linear. It is
    only searched for in texts that have a digit.
    """
    token = f"(?<![^{_SPACE}\\n])[^{_SPACE}\\n0-9]*+[0-9][^{_SPACE}\\n]*+"
    return F.when(text.rlike("[0-9]"), F.regexp_replace(text, token, VARIABLE)).otherwise(text)


def tokens(line: Column) -> Column:
    return F.split(line, f"[{_SPACE}]+")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _masked_lines(text: Column) -> Column:
    """The masked lines of a text without outer white space."""
    line, cut = _lines(text), lambda x: F.btrim(x, F.lit(SPACE))
    digits = ~text.rlike(NO_DIGIT)
    return F.when(digits, F.transform(line, lambda x: cut(masked(x)))).otherwise(F.transform(line, cut))


def _uneven(text: Column) -> Column:
    """Whether tokens may be apart by anything but one space."""
    return reduce(or_, (text.contains(x) for x in ("  ", *SPACE[1:])))


def _even(line: Column) -> Column:
    """A trimmed line with one space between its tokens."""
    return F.when(_uneven(line), F.regexp_replace(line, f"[{_SPACE}]+", " ")).otherwise(line)


def _leaf(even: Column, depth: int) -> Column:
    spaces = F.octet_length(even) - F.octet_length(F.replace(even, F.lit(" "), F.lit("")))
    return F.xxhash64(spaces, F.substring_index(even, " ", depth))


def _signature(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _signed(rows: DataFrame, depth: int) -> DataFrame:
    """Of every row: place, leaf and signature of each of its lines that are not blank."""
    line = F.transform(_masked_lines(F.col("_text")), lambda x, i: F.struct(i.alias("pos"), x.alias("m")))
    kept = F.filter(line, lambda x: x["m"] != "")
    # Asked of the whole text first, as hardly any has such a line.
    cut = F.when(
        _uneven(F.col("_text")), F.transform(kept, lambda x: x.withField("even", _even(x["m"])))
    ).otherwise(F.transform(kept, lambda x: x.withField("even", x["m"])))
    signed = F.transform(
        cut,
        lambda x: F.struct(
            x["pos"].alias("pos"),
            _leaf(x["even"], depth).alias("leaf"),
            _signature(x["m"]).alias("sig"),
        ),
    )
    return stage(rows.select("_id", "_row", signed.alias("lines")), "signed-lines")


def _leaf_members(rows: DataFrame, signatures: DataFrame) -> DataFrame:
    """The different lines of leaves that have several: ``leaf``, ``sig``, ``words``, ``docs``.

    The words of a line are those of the first row that has it, so each line is met once, and one
    that very many rows have does not gather in one task.
    """
    leaves = signatures.groupBy("leaf").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    wanted = signatures.join(leaves, "leaf", "left_semi")
    wanted = wanted.select("leaf", F.col("sig").alias("of"), "docs", F.col("first._id").alias("id"), F.col("first._row").alias("row"))
    texts = rows.select("_id", "_row", F.explode(F.array_distinct(_masked_lines(F.col("_text")))).alias("m"))
    texts = texts.filter("m != ''").withColumn("sig", _signature(F.col("m")))
    same = (F.col("sig") == F.col("of")) & F.col("_id").eqNullSafe(F.col("id")) & (F.col("_row") == F.col("row"))
    met = texts.join(wanted, same)
    return stage(met.select("leaf", "sig", tokens(F.col("m")).alias("words"), "docs"), "leaf-members")


def _judged(members: DataFrame) -> DataFrame:
    """Of the members of each ``part`` that has several: whether each ``fits`` the template of its
    part, if there is one, and the part it is in if the part is split, null if it is alone there."""
    heard = members.groupBy("part").agg(
        F.sum("docs").alias("heard"), F.count(F.lit(1)).alias("kinds"), F.max(F.size("words")).alias("n")
    )
    votes = members.select("part", "docs", F.posexplode("words").alias("pos", "word"))
    votes = votes.groupBy("part", "pos", "word").agg(F.sum("docs").alias("votes"), F.count(F.lit(1)).alias("have"))
    counted = votes.filter("have > 1 or votes > 1").join(heard.filter("kinds > 1"), "part")
    constant = F.col("votes") * 2 > F.col("heard")
    dividing = (F.col("have") > 1) & (F.col("have") < F.col("kinds"))
    found = counted.groupBy("part", "n").agg(
        F.collect_list(F.when(constant, F.struct("pos", "word"))).alias("constants"),
        F.sort_array(
            F.collect_list(F.when(dividing, F.struct((-F.col("votes")).alias("order"), "pos", "word")))
        ).alias("ranked"),
    )
    general = F.size("constants") * 10 >= F.col("n") * CONSTANT
    found = found.select(
        "part",
        F.when(general, F.col("constants")).alias("constants"),
        F.slice("ranked", 1, RANKED).alias("ranked"),
        (F.size("ranked") > RANKED).alias("more"),
    )
    differ = F.size(F.filter("constants", lambda c: F.get(F.col("words"), c["pos"]) != c["word"]))
    fits = F.col("constants").isNotNull() & (differ * 10 <= F.size("words") * DIFFERENT)
    own = F.get(F.filter("ranked", lambda c: F.get(F.col("words"), c["pos"]) == c["word"]), F.lit(0))
    split = F.when(own.isNotNull(), F.xxhash64("part", own["pos"], own["word"])).when(
        F.col("more"), F.xxhash64("part", F.lit(-1))
    )
    return members.join(found, "part").select("part", "sig", "words", "docs", fits.alias("fits"), split.alias("split"))


def _fitting(members: DataFrame) -> DataFrame:
    """Signatures of lines that belong to a template of their leaf: ``sig`` and ``template``.

    A round takes the template of each part from it, or splits the part by a token that some of
    its lines have and others have not, so every part becomes smaller until no two lines are left.
    """
    members, found, number = members.withColumnRenamed("leaf", "part"), None, 0
    while True:
        judged = stage(_judged(members), "judged")
        fitting = judged.filter("fits").select("sig", F.xxhash64("part", F.lit(number)).alias("template"))
        found = found.union(fitting) if found else fitting
        if judged.isEmpty():
            return found
        templates = judged.filter("fits").select("part").distinct().withColumn("met", F.lit(True))
        rest = judged.filter("not fits").join(templates, "part", "left")
        part = F.when(F.col("met"), F.col("part")).otherwise(F.col("split"))
        members = rest.select(part.alias("part"), "sig", "words", "docs").filter("part is not null")
        number += 1


def recurring(rows: DataFrame, signed: DataFrame, depth: int, min_docs: int) -> DataFrame:
    """Signatures of lines whose template recurs: ``sig``, ``docs`` and ``first``, the row that
    keeps it."""
    row = F.struct("_id", "_row")
    own = signed.select(row.alias("row"), F.explode(F.array_distinct(F.transform("lines", lambda x: x.dropFields("pos")))).alias("x"))
    own = own.select("row", "x.*")
    signatures = own.groupBy("sig", "leaf").agg(F.count(F.lit(1)).alias("docs"), F.min("row").alias("first"))
    signatures = stage(signatures, "signatures")
    fitting = stage(_fitting(_leaf_members(rows, signatures)), "fitting")

    shared = own.join(fitting, "sig").select("template", "row").distinct()
    shared = shared.groupBy("template").agg(F.count(F.lit(1)).alias("docs"), F.min("row").alias("first"))
    of_template = fitting.join(shared, "template").select("sig", "docs", "first")
    of_line = signatures.join(fitting, "sig", "left_anti").select("sig", "docs", "first")
    return of_template.union(of_line).filter(F.col("docs") >= min_docs)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    depth: int = DEPTH,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``docs`` with ``clean_text``, ``n_lines`` and ``n_dropped`` in place of the text.

    Lines end at line feeds; ``n_lines`` counts those that are not blank. A line is dropped if its
    template is found in ``min_docs`` documents or more, except in the one with the smallest
    identifier (null being smallest, of repeated rows one of them). A template that recurs only
    within one document stays. Blank lines stay, and kept lines are unchanged and in order. A null
    or empty text has no lines and the clean text ``''``. Columns of ``docs`` named like the
    results are replaced; an empty table gives no rows.
    """
    names = [c for c in docs.columns if c != text]
    rows = located(docs).withColumns(
        {"_id": F.col(id_col), "_text": F.col(text), "_row": F.xxhash64(*PLACE)}
    )
    body = rows.select("_id", "_row", "_text")
    signed = _signed(body, depth)
    found = stage(recurring(body, signed, depth, min_docs), "recurring")
    lines = signed.select("_id", "_row", F.explode("lines").alias("x")).select("_id", "_row", "x.pos", "x.sig")
    first = F.col("first._id").eqNullSafe(F.col("_id")) & (F.col("first._row") == F.col("_row"))
    dropped = lines.join(found, "sig").filter(~first)
    dropped = dropped.groupBy("_row", F.col("_id").alias("_of")).agg(F.collect_set("pos").alias("_drop"))
    dropped = dropped.withColumnRenamed("_row", "_at")
    same = (F.col("_row") == F.col("_at")) & F.col("_id").eqNullSafe(F.col("_of"))
    met = rows.join(dropped, same, "left")
    gone = F.coalesce("_drop", F.array().cast("array<int>"))
    line = _lines(F.col("_text"))
    clean = F.array_join(F.filter(line, lambda x, i: ~F.array_contains(gone, i)), "\n")
    results = {
        "clean_text": clean,
        "n_lines": F.size(F.filter(line, lambda x: F.btrim(x, F.lit(SPACE)) != "")),
        "n_dropped": F.size(gone),
    }
    return met.withColumns(results).select(*[n for n in names if n not in results], *results)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs)

