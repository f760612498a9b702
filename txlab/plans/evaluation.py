"""Compare models, choose one and its threshold, and store what scoring needs."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame, functions as F

from ..operators.calibration import FOLDS, Sigmoids, calibrate, platt_cross_fit
from ..operators.metrics import MIN_RECALL, best_model, evaluate_models, leaderboard, long_metrics, score_curve
from ..operators.models import _union, fit_model, load_model, save_model, scored_rows
from ..operators.prepare import scale_fit
from ..operators.stages import ColumnScaler, Decision
from ..session import freeze
from ..sources.artefacts import record_runs, save_threshold, write_json


def unit(stages: list[Transformer], name: str, threshold: float, sigmoids: Sigmoids | None = None) -> PipelineModel:
    """One loadable pipeline: what produces a probability (scaler, model ...), its calibration and its threshold."""
    a, b = zip(*sigmoids.pairs) if sigmoids and sigmoids.pairs else ((), ())
    return PipelineModel([*stages, Decision(slopes=list(a), intercepts=list(b), threshold=float(threshold), model=name)])


def promote(stages: list[Transformer], name: str, folder: str, threshold: float, sigmoids: Sigmoids | None = None) -> str:
    """Store the winner as one unit below ``folder``, which is returned."""
    save_model(unit(stages, name, threshold, sigmoids), f"{folder}/unit")
    return folder


def score_promoted(df: DataFrame, folder: str) -> DataFrame:
    """Score with a promoted unit: calibrated probability, decision, threshold. Columns the unit scales are given unscaled, and come back so."""
    loaded = load_model(f"{folder}/unit")
    changed = [c for s in loaded.stages if isinstance(s, ColumnScaler) for c in s.getOrDefault("columns")]
    kept = df.withColumns({f"_raw_{c}": F.col(c) for c in changed})
    scored = loaded.transform(kept)
    return scored.withColumns({c: F.col(f"_raw_{c}") for c in changed}).drop(*[f"_raw_{c}" for c in changed])


def evaluate_calibrated(scored: DataFrame, min_recall: float = MIN_RECALL, folds: int = FOLDS, seed: int = 42,
                        digits: int | None = None) -> tuple[DataFrame, dict[tuple, Sigmoids]]:
    """``(results, sigmoids)`` of scored rows ``(model, key, label, score)``: each model is calibrated if that helps, then measured.

    ``results`` has the columns of ``evaluate_models`` over the final scores, and the model's two Brier scores, ``use_calibrated``
    and ``reason``. ``digits`` rounds final scores, so that equal ones are ties wherever they were computed.
    """
    fits = platt_cross_fit(scored, by=["model"], folds=folds, seed=seed)
    rows, choice = calibrate(scored, by=["model"], folds=folds, seed=seed, fits=fits)
    final = F.col("final") if digits is None else F.round("final", digits)
    final = freeze(rows.select("model", "key", "label", final.alias("score")), "final")
    results = evaluate_models(final, "label", "score", min_recall)
    return results.join(F.broadcast(choice), "model"), fits  # one row per model


def evaluation_job(train: DataFrame, test: DataFrame, names: list[str], features: list[str], key: str, label: str, folder: str,
                   min_recall: float = MIN_RECALL, params: dict[str, dict] | None = None, weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(leaderboard, chosen)``: fit, score held-out rows, calibrate, compare, choose a threshold, and promote the winner.

    The scaler is fitted on ``train``. ``folder`` gets the unit, metrics, threshold and run table; ``score_promoted`` applies it.
    """
    scaler = ColumnScaler.fitted(scale_fit(train, features))
    ready, held_out = freeze(scaler.transform(train), "train"), freeze(scaler.transform(test), "test")
    fitted = {n: fit_model(ready, n, features, label, (params or {}).get(n), weight) for n in names}
    scored = freeze(_union([scored_rows(held_out, m, n, key, label) for n, m in fitted.items()]), "scored")
    return compare_and_promote(scored, {n: [scaler, *m.stages] for n, m in fitted.items()}, folder, min_recall)


def compare_and_promote(scored: DataFrame, stages: dict[str, list[Transformer]], folder: str, min_recall: float = MIN_RECALL,
                        digits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(leaderboard, chosen)`` of scored rows ``(model, key, label, score)``; the winner's ``stages`` go into the unit below ``folder``."""
    results, fits = evaluate_calibrated(scored, min_recall, digits=digits)
    table = scored.sparkSession.createDataFrame(results.collect(), results.schema)  # one row per model
    ranked, chosen = _store(table, folder)
    best = chosen.first()
    used = table.where(F.col("model") == best["best_model"]).first()["use_calibrated"]
    promote(stages[best["best_model"]], best["best_model"], folder, best["threshold"], fits[best["best_model"],] if used else None)
    return ranked, chosen


def evaluate_and_store(scored: DataFrame, folder: str, min_recall: float = MIN_RECALL) -> tuple[DataFrame, DataFrame]:
    """``(leaderboard, chosen)`` of scored rows ``(model, key, label, score)``.

    Writes ``metrics`` and ``threshold`` as JSON and appends to the run table below ``folder``.
    """
    results = evaluate_models(scored, "label", "score", min_recall, curve=score_curve(scored, "label", "score", ["model"]))
    table = scored.sparkSession.createDataFrame(results.collect(), results.schema)  # one row per model
    return _store(table, folder)


def _store(table: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    ranked = leaderboard(table)
    chosen = best_model(table).join(
        table.select(F.col("model").alias("best_model"), "threshold"), "best_model")
    figures = [c for c, t in table.dtypes if t in ("double", "bigint", "int")]
    write_json(long_metrics(ranked.select("model", *figures, "rank")), f"{folder}/metrics")
    save_threshold(chosen.select("threshold", F.col("best_model").alias("model_name")), f"{folder}/threshold")
    record_runs(table, f"{folder}/runs", "model", figures)
    return ranked, chosen
