"""Where a row was read from, which tells repeated rows apart."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.sources.staging import stage

PLACE = ("_place_file", "_place_row")


# Nodes of a plan that give every row of a file at most once.
KEEPING = ("Project", "Filter", "SubqueryAlias")


def _read_once(docs: DataFrame) -> bool:
    """Whether ``docs`` is a scan of files, with nothing but projections and filters behind it.

    Behind an explode, a join or a union the place of a row is not its own any more.
    """
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in KEEPING:
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with the file and row each row was read from, the columns ``PLACE``.

    Frames other than scans of files have no such place, so they are staged first.
    """
    place = dict(zip(PLACE, (F.col("_metadata.file_path"), F.col("_metadata.row_index"))))
    if _read_once(docs):
        try:
            return docs.withColumns(place)
        except AnalysisException:
            pass  # files of another format have no row numbers
    return stage(docs, "located").withColumns(place)
