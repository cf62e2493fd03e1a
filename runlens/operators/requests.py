"""Cancel requests: decode them and match them with the known stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from runlens.functions.text import decode_field
from runlens.operators.keyed import group_lists
from runlens.operators.skew import lookup_join

# The wording of answers.
NOT_DECODED = "Error decoding message"
CANCELLING = "Cancelling stage "
STAGE = "Stage "
NOT_FOUND = " not found"


def decode_requests(
    df: DataFrame, message: str, field: str = "stageId", name: str = "stage_id"
) -> DataFrame:
    """Add the requested stage id; null marks a message that does not decode."""
    return df.withColumn(name, decode_field(F.col(message), field))


def answer_requests(
    requests: DataFrame,
    known: DataFrame,
    keys: Sequence[str] = ("app_id", "stage_id"),
    key: str = "stage_id",
) -> DataFrame:
    """Add ``outcome`` (``error``, ``cancel`` or ``not found``) and its message.

    A request is matched on all ``keys``, since stage ids are those of an application.
    Answers never list the known ids, which :func:`known_ids` does.
    """
    ids = known.select(*keys).distinct()
    found = lookup_join(requests, ids.withColumn("_known", F.lit(True)), keys, "left")
    id_text = F.col(key).cast("string")
    outcome = (
        F.when(F.col(key).isNull(), "error")
        .when(F.col("_known"), "cancel")
        .otherwise("not found")
    )
    message = (
        F.when(F.col(key).isNull(), NOT_DECODED)
        .when(F.col("_known"), F.concat(F.lit(CANCELLING), id_text))
        .otherwise(F.concat(F.lit(STAGE), id_text, F.lit(NOT_FOUND)))
    )
    return found.withColumns({"outcome": outcome, "message": message}).drop("_known")


def known_ids(
    stages: DataFrame, by: list[str], key: str = "stage_id", run_rows: int = 10_000
) -> DataFrame:
    """Sorted distinct ids per group, in numbered runs of bounded length."""
    return group_lists(stages.select(*by, key).distinct(), by, key, run_rows)
