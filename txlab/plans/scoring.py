"""The batch scoring job: read, check, scale, score, store, summarise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..operators.scoring import score_batch, score_summary
from ..operators.prepare import scaled
from ..operators.validate import non_negative, project_required, quarantine
from ..sources.tables import write_parquet


def score_job(raw: DataFrame, key: str, required: list[str], scorer: Column | object, threshold: float | Column,
              stats: DataFrame | None = None, path: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(scored, rejected, summary)``. Extra columns are dropped, the key is kept, bad rows are set aside.

    With saved scaler statistics ``Amount_scaled`` and ``Time_scaled`` are added; without, they equal the raw values.
    """
    accepted, rejected = quarantine(project_required(raw, key, required), non_negative("Amount", "Time"))
    if stats is None:
        ready = accepted.withColumns({"Amount_scaled": accepted["Amount"], "Time_scaled": accepted["Time"]})
    else:
        ready = accepted.withColumns({f"{c}_scaled": v for c, v in scaled(stats, ["Amount", "Time"]).items()})
    out = score_batch(ready, scorer, threshold).drop("Amount_scaled", "Time_scaled")
    if path is not None:
        write_parquet(out, path)
        out = raw.sparkSession.read.parquet(path)
    return out, rejected, score_summary(out)
