"""What a screen's tables seem to mean, as a configuration to start from."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenspark.operators import detect
from screenspark.spec import ScreenSpec


@dataclass(frozen=True)
class Detection:
    gene_id_format: str
    organism: str | None
    modality: str
    perturbation_column: str | None
    control_label: str | None
    batch_column: str | None
    cell_line_column: str | None
    is_combinatorial: bool
    separator: str | None
    perturbation_type: str


def detection(obs: DataFrame, var: DataFrame, assay: str | None = None, layers: tuple[str, ...] = (), notes: tuple[str, ...] = (), gene_like_test: bool = False) -> Detection:
    """Reads the metadata tables only, never the counts."""
    spark = obs.sparkSession
    ids = detect.gene_id_format(var).first()
    columns = detect.detect_columns(obs, gene_like_test)
    control, mixed, separator = None, False, None
    if columns.perturbation:
        labels = obs.select(F.col(columns.perturbation).alias("pert"))
        found = detect.control_label(spark, labels).first()
        control = found.control_label if found else None
        mixed, separator = detect.combinatorial(labels, ScreenSpec(control_label=control or ""), per_label=True).first()
    hints = [F.col(c) for c in obs.columns if "type" in c.lower() or "mode" in c.lower()]
    values = spark.createDataFrame([(n,) for n in notes], "value string")
    for column in hints:
        values = values.unionByName(obs.select(column.cast("string").alias("value")).distinct())
    return Detection(
        ids.format, ids.organism, detect.modality(var, assay, layers).first().modality, columns.perturbation, control, columns.batch, columns.cell_line,
        bool(mixed), separator, detect.perturbation_type(values).first().perturbation_type,
    )


def suggested_yaml(found: Detection) -> str:
    import yaml

    keep = ("perturbation_column", "control_label", "batch_column", "perturbation_type")
    return yaml.safe_dump({k: v for k, v in asdict(found).items() if k in keep and v is not None}, sort_keys=False)
