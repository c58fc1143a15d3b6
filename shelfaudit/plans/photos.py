"""Photo selection and export names (C11).

Documents are left-joined to their attachments (documents without files
are kept), each file is ranked inside its document by running count, the
files ranked below 4 (and the rank-0 rows: no file) are kept, and each
gets the name ``<file>_<agent><document><extension>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfaudit.functions.text import concat_strict
from shelfaudit.operators.ranking import top_by_running_count


def photo_candidates(docs: DataFrame, attachments: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Documents left-joined to attachments on ``(doc column, attachment column)`` pairs."""
    keys = {a for _, a in on}
    att = attachments.select(
        *[F.col(c).alias(f"_att_{c}") if c in keys else F.col(c) for c in attachments.columns]
    )
    cond = [docs[d] == att[f"_att_{a}"] for d, a in on]
    return docs.join(att, cond, "left").drop(*[f"_att_{a}" for a in keys])


def photo_selection(cands: DataFrame, part: str, file_col: str, below: int = 4) -> DataFrame:
    """Rows whose running-count rank inside ``part`` is below ``below``."""
    return top_by_running_count(cands, part, file_col, below=below, name="rnk")


def photo_names(df: DataFrame, file_col: str, agent_col: str, doc_col: str, extension: str,
                name: str = "file_name") -> DataFrame:
    """``CAST(file) + '_' + CAST(agent) + CAST(document) + extension``; NULL if any part is."""
    return df.withColumn(name, concat_strict(file_col, F.lit("_"), agent_col, doc_col, F.lit(extension)))


def export_photos(
    docs: DataFrame,
    attachments: DataFrame,
    on: Sequence[tuple[str, str]],
    part: str,
    file_col: str,
    agent_col: str,
    doc_col: str,
    data_col: str,
    target_dir: str,
    extension: str = ".jpg",
) -> DataFrame | None:
    """The whole photo export: guard, selection, names, one file per row.

    The guard is the original's existence probe: with no documents at all
    nothing is exported (``None``). Otherwise the returned DataFrame lists
    the files written once it is evaluated. The file bytes are joined only
    to the selected rows, so unselected attachments are never read.
    """
    from shelfaudit.sources.attachments import export_files

    if docs.isEmpty():
        return None
    cands = photo_candidates(docs, attachments.drop(data_col), on)
    named = photo_names(photo_selection(cands, part, file_col), file_col, agent_col, doc_col, extension)
    att_keys = [a for _, a in on]
    payload = attachments.select(*att_keys, F.col(file_col).alias("_pf"), F.col(data_col).alias("_pdata"))
    cond = [named[d] == payload[a] for d, a in on] + [named[file_col] == payload["_pf"]]
    with_data = named.join(payload, cond, "left")
    return export_files(with_data, "file_name", "_pdata", target_dir)
