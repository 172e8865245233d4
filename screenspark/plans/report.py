"""The run's report in Markdown, from small tables, and the summary of its deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pyspark.sql import functions as F

from screenspark.operators import metacells
from screenspark.operators.counterfactual import DeltaModel
from screenspark.operators.diagnostics import disruption_verdict, run_verdict


def rendered(frame: DataFrame, most: int = 200) -> str:
    """A table of at most ``most`` rows."""
    rows = frame.limit(most).collect()
    show = lambda v: f"{v:.4g}" if isinstance(v, float) else "" if v is None else str(v)
    lines = [frame.columns, ["---"] * len(frame.columns), *[[show(v) for v in r] for r in rows]]
    return "\n".join("| " + " | ".join(cells) + " |" for cells in lines)


def report(dataset: str, sections: dict[str, DataFrame | str], warnings: list[str]) -> str:
    """Title, verdict, one section for each table or text, and the warnings."""
    parts = [f"# Report: {dataset}", f"Verdict: **{run_verdict(len(warnings))}** ({len(warnings)} warnings)"]
    for title, content in sections.items():
        parts += [f"## {title}", content if isinstance(content, str) else rendered(content)]
    parts += ["## Warnings", "\n".join(f"- {w}" for w in warnings) or "None."]
    return "\n\n".join(parts) + "\n"


def delta_summary(model: DeltaModel, sweep: DataFrame | None = None) -> dict:
    """The parameters of fitted deltas, and with a sweep the figures of their point."""
    spec = model.spec
    out = {"mode": spec.mode, "k": spec.neighbours, "n_pcs": spec.n_pcs, "metric": spec.metric, "auto_calibrated": sweep is not None, "systematic_pcs": list(model.systematic)}
    if sweep is not None:
        plain = spec.mode == "pc_decomposition"
        rows = sweep.filter((F.col("mode") == spec.mode) & (F.col("n_pcs") == spec.n_pcs))
        rows = rows if plain else rows.filter((F.col("k") == spec.neighbours) & (F.col("metric") == spec.metric))
        rows = rows.withColumn("rank_disruption", 1 - F.col("rank_preservation")).withColumn("verdict", disruption_verdict("rank_disruption"))
        for row in rows.limit(1).collect():
            out |= {"rank_disruption": row.rank_disruption, "verdict": row.verdict, "discrimination": row.discrimination, "signal_stability": row.stability}
    return out


def run_report(run, dataset: str, detection=None, outputs: tuple[str, ...] = (), downstream: str = "") -> str:
    """The nine sections of a run of ``plans.pipeline``: what was found, how many cells each
    stage kept, lines, metacells, calibration, files, warnings, verdict, what is ready."""
    spec, tables = run.model.spec, run.tables
    facts = lambda pairs: "\n".join(f"- {k}: {'none' if v is None or v == [] else v}" for k, v in pairs.items())
    found = {k: v for k, v in vars(detection).items()} if detection else {"detection": "skipped"}
    summary = delta_summary(run.model, tables.get("sweep"))
    flagged = tables["directions"].filter("parallel").count()
    wide = tables["variance"].filter("split = 'train'").agg(F.round(F.avg("inner_variance"), 4).alias("mean_inner_variance"), F.count_if("warn").alias("groups_flagged"))
    lines = tables["lines"].orderBy("cell_line")
    ready = tables["metacells"].groupBy("cell_line").pivot("split", ["train", "val", "test"]).agg(F.count(F.lit(1))).fillna(0).orderBy("cell_line")
    sections = {
        "1 Detection": facts({"control label": spec.control_label, "perturbation type": spec.perturbation_type} | found),
        "2 Cell counts": rendered(run.attrition().orderBy("step")),
        "3 Cell lines": rendered(lines) + f"\n\nPairs of lines that differ in one direction alone: {flagged}",
        "4 Metacells": rendered(metacells.rollup(tables["metacells"]).orderBy("cell_line", "split")) + "\n\n" + rendered(wide),
        "5 Calibration": facts(summary),
        "6 Output files": "\n".join(f"- {p}" for p in outputs) or "None.",
        "7 Warnings": "\n".join(f"- {w}" for w in run.warnings) or "None.",
        "8 Assessment": f"{run_verdict(len(run.warnings))}: {lines.count()} lines, deltas by {summary['mode']}",
        "9 Downstream readiness": rendered(ready) + (f"\n\nNext: {downstream}" if downstream else ""),
    }
    return "\n\n".join([f"# Report: {dataset}", *(f"## {title}\n\n{text}" for title, text in sections.items())]) + "\n"
