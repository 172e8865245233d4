"""Typed configuration with the values that take effect by default."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path


@dataclass(frozen=True)
class ScreenSpec:
    """Parameters of all stages; the letters name the stage that reads them."""

    dataset: str = "screen"
    perturbation_column: str = "gene"
    control_label: str = "non-targeting"
    batch_column: str = "gem_group"
    mt_prefix: str = "MT-"
    ribosomal_prefixes: tuple[str, ...] = ("RPS", "RPL")
    # detection
    separators: tuple[str, ...] = ("+", ",", "|", ";")
    combinatorial_share: float = 0.05
    # triage
    mt_threshold: float = 0.20
    skip_mt: bool = False
    min_genes: int = 200
    max_genes: int = 10_000
    min_counts: int = 500
    max_counts: int = 80_000
    # ambient
    flag_threshold: float = 0.80
    min_umi_percentile: float = 0.10
    remove_flagged: bool = False
    # doublets
    doublet_rate: float = 0.06
    remove_doublets: bool = True
    # escapers
    perturbation_type: str = "CRISPRi"
    escaper_direction: str = "auto"
    escaper_percentile: float = 10.0
    efficiency_threshold: float = 0.50
    min_cells_per_perturbation: int = 50
    # genes
    min_cells_expressing: int = 10
    cell_share: float = 0.05
    mean_umi: float = 0.25
    # splits
    seed: int = 42
    bins: int = 4
    test_ratio: float = 0.25
    val_ratio: float = 0.10
    # variable genes
    n_top_genes: int = 5000
    fit_cells: int = 100_000
    # normalisation
    target_sum: float | None = None
    log: bool = True
    # embedding
    n_components: int = 50
    clip: float = 10.0
    harmony_rounds: int = 20
    # lines
    min_cells_per_line: int = 500
    merge_cosine: float = 0.5
    min_cells_for_direction: int = 10
    # metacells
    base_target: int = 10
    variance_warning: float = 2.0
    min_cells_per_split: int = 50
    # counterfactual
    mode: str = "knn"
    neighbours: int = 20
    n_pcs: int = 50
    metric: str = "euclidean"
    systematic_cosine: float = 0.30
    neighbour_grid: tuple[int, ...] = (1, 3, 5, 10, 15, 20, 30, 50)
    percentile_floor: float = 30.0
    distance_weights: tuple[float, float, float] = (1.5, 1.0, 1.0)
    paths: dict = field(default_factory=dict)

    def activates(self) -> bool:
        """Whether perturbed cells are to express more of their target."""
        if self.escaper_direction == "auto":
            return "CRISPRa" in self.perturbation_type
        return self.escaper_direction == "activation"


def load_spec(path: str) -> ScreenSpec:
    """A YAML file of the fields above, nested in sections or not; unknown keys and
    keys without value are passed by, folders named under ``paths`` are made."""
    spec = parse_spec(Path(path).read_text())
    for folder in spec.paths.values():
        if isinstance(folder, str) and not Path(folder).suffix and "://" not in folder:
            Path(folder).mkdir(parents=True, exist_ok=True)
    return spec


def parse_spec(text: str) -> ScreenSpec:
    """The content of such a file, wherever it was read from; no folder is made."""
    import yaml

    known, found = {f.name for f in fields(ScreenSpec)}, {}
    todo = [yaml.safe_load(text) or {}]
    while todo:
        for key, value in todo.pop().items():
            if key in known and value is not None:
                found[key] = tuple(value) if isinstance(value, list) else value
            elif isinstance(value, dict):
                todo.append(value)
    return ScreenSpec(**found)
