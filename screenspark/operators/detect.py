"""Detection of what a screen's tables mean, and harmonisation."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from screenspark.spec import ScreenSpec

# The vocabularies, prefixes and patterns that detection goes by.
ID_PREFIXES = {"ENSG": "human", "ENSMUSG": "mouse", "ENSDARG": "zebrafish", "FBgn": "fly", "WBGene": "worm"}
PEAK = r"^chr\w+:\d+-\d+$"
GENE_LIKE = r"^[A-Z][A-Z0-9\-]{1,15}$"
CONTROL_WORDS = ("non-targeting", "non_targeting", "nontargeting", "control", "ctrl", "scramble", "scrambled", "negative", "NT", "ntc", "gfp", "lacz", "safe_harbor", "safe-harbor", "AAVS1", "INTERGENIC", "non targeting", "nontarget", "neg_ctrl", "neg_control", "CTRL", "NEGATIVE", "GFP")
PERTURBATION_WORDS = ("gene", "perturbation", "target", "guide", "knockout", "crispr", "sgrna", "guide_rna", "perturb", "perturbagen", "gene_target", "target_gene", "gene_name", "symbol", "pert", "pert_name", "gene_id", "guide_id", "perturbation_target", "CRISPR", "guide_assignment", "gene_symbol")
BATCH_WORDS = ("gem_group", "batch", "run", "lane", "library", "experiment", "sample", "replicate", "10x_run", "batch_id", "run_id", "sample_id", "library_id", "sequencing_run", "prep_batch", "gem")
LINE_WORDS = ("cell_line", "cell_type", "cellline", "cell_line_id", "line", "sample_type", "condition_cell", "clone", "subline", "tissue", "cell_line_name", "cell_origin", "sample_origin")
LINE_WORDS_OF_NAMES = ("cell_line", "cell_type", "cellline", "cell_line_id", "line", "sample_type", "cell_line_name", "condition", "clone", "subline", "tissue", "cell_origin")
LINE_NAMES = ("k562", "rpe1", "hesc", "h1", "jurkat", "ipsc", "hela", "a549", "293t", "hek293", "thp1", "mcf7", "u2os", "hct116", "pc9", "h358", "h1299", "h1792", "h2009", "lncap", "du145", "pc3", "hl60", "molt4", "ramos", "raji", "daudi", "hcc1954", "bt474", "skbr3", "t47d", "mbda231")


def gene_id_format(names: DataFrame) -> DataFrame:
    """One row (format, organism, share) by the first 200 gene names in order."""
    first = names.select("gene_name").orderBy("gene_name").limit(200)
    shares = [F.avg(F.col("gene_name").rlike(f"^{p}[0-9]+$").cast("double")).alias(p) for p in ID_PREFIXES]
    row = first.agg(*shares, F.avg(F.col("gene_name").rlike("^[0-9]+$").cast("double")).alias("digits"))
    fmt, organism, share = F.lit("symbol"), F.lit(None).cast("string"), F.lit(0.0)
    fmt, share = F.when(F.col("digits") > 0.5, F.lit("entrez")).otherwise(fmt), F.when(F.col("digits") > 0.5, F.col("digits")).otherwise(share)
    for prefix, name in reversed(ID_PREFIXES.items()):
        hit = F.col(prefix) > 0.5
        fmt, organism, share = F.when(hit, F.lit("ensembl")).otherwise(fmt), F.when(hit, F.lit(name)).otherwise(organism), F.when(hit, F.col(prefix)).otherwise(share)
    return row.select(fmt.alias("format"), organism.alias("organism"), F.coalesce(share, F.lit(0.0)).alias("share"))


def modality(var: DataFrame, assay: str | None = None, layers: tuple[str, ...] = (), mt_prefixes: tuple[str, ...] = ("MT-", "mt-")) -> DataFrame:
    """One row ``modality`` by ordered rules on features, side matrices and assay.

    ``var`` may have ``feature_type``.  With ``assay`` None a screen without
    mitochondrial genes is of either sort, ``scrna_seq_or_snrna_seq``.
    """
    kind = F.col("feature_type") if "feature_type" in var.columns else F.lit("Gene Expression")
    ordered = var.select("gene_name", kind.alias("kind")).orderBy("gene_name")
    mt = F.lit(False)
    for p in mt_prefixes:
        mt = mt | F.col("gene_name").startswith(p)
    flags = (
        var.select(kind.alias("kind")).agg(F.coalesce(F.bool_or(F.col("kind") == "Antibody Capture"), F.lit(False)).alias("antibody"))
        .crossJoin(ordered.limit(50).agg(F.avg(F.col("gene_name").rlike(PEAK).cast("double")).alias("peaks")))
        .crossJoin(ordered.limit(500).agg(F.coalesce(F.bool_or(mt), F.lit(False)).alias("mt")))
    )
    nuclear = assay is not None and any(w in assay.lower() for w in ("nucleus", "snrna", "snuc"))
    bare = F.lit("scrna_seq_or_snrna_seq") if assay is None else F.lit("snrna_seq" if nuclear else "scrna_seq")
    side = any("atac" in x.lower() or "peak" in x.lower() for x in layers)
    rule = F.when(F.col("antibody"), "cite_seq").when((F.col("peaks") > 0.3) | F.lit(side), "multiome").when(~F.col("mt"), bare).otherwise("scrna_seq")
    return flags.select(rule.alias("modality"))


def harmonise(var: DataFrame, symbols: DataFrame) -> DataFrame:
    """Var with names from ``symbols`` (gene_id, symbol), unknown ones as they
    are; the k-th repeat of a name, in order of the original one, gets the suffix _k."""
    named = var.withColumnRenamed("gene_name", "original_gene_id").join(
        symbols.filter("symbol IS NOT NULL").groupBy("gene_id").agg(F.min("symbol").alias("symbol")), F.col("original_gene_id") == F.col("gene_id"), "left"
    )
    name = F.coalesce("symbol", "original_gene_id")
    k = F.row_number().over(W.partitionBy(name).orderBy("original_gene_id")) - 1
    return named.withColumn("gene_name", F.when(k > 0, F.concat_ws("_", name, k.cast("string"))).otherwise(name)).drop("symbol", "gene_id")


def combinatorial(labels: DataFrame, spec: ScreenSpec, per_label: bool = False) -> DataFrame:
    """One row (is_combinatorial, separator): the first separator that enough
    non-control rows of (pert) hold; ``per_label`` counts each label once."""
    rows = labels.select("pert").filter((F.col("pert") != spec.control_label) & F.col("pert").isNotNull())
    rows = rows.distinct() if per_label else rows
    shares = rows.agg(*[F.avg(F.contains("pert", F.lit(s)).cast("double")).alias(f"s{i}") for i, s in enumerate(spec.separators)])
    found = F.coalesce(*[F.when(F.col(f"s{i}") >= spec.combinatorial_share, F.lit(s)) for i, s in enumerate(spec.separators)])
    return shares.select(found.isNotNull().alias("is_combinatorial"), found.alias("separator"))


def constituents(labels: DataFrame, separator: str, spec: ScreenSpec) -> DataFrame:
    """(gene): the parts of all non-control labels."""
    parts = F.expr("filter(transform(split(pert, {sep}), p -> trim(p)), p -> p <> '')".format(sep="concat('\\\\Q', '" + separator.replace("'", "''") + "', '\\\\E')"))
    return labels.filter(F.col("pert") != spec.control_label).select(F.explode(parts).alias("gene")).distinct()


def plain(label: F.Column) -> F.Column:
    return F.translate(F.lower(label), " _-", "")


def control_label(spark, labels: DataFrame) -> DataFrame:
    """P20: one row at most: the label that the first word of the vocabulary matches."""
    words = spark.createDataFrame(list(enumerate(CONTROL_WORDS)), "position int, word string")
    hits = labels.select("pert").distinct().join(F.broadcast(words), plain(F.col("pert")) == plain(F.col("word")))
    return hits.orderBy("position", "pert").limit(1).select(F.col("pert").alias("control_label"))


def perturbation_type(values: DataFrame) -> DataFrame:
    """One row ``perturbation_type`` by words in the distinct values of (value)."""
    low = F.lower("value")
    has = lambda *words: F.coalesce(F.bool_or(F.greatest(*[F.contains(low, F.lit(w)) for w in words]) if len(words) > 1 else F.contains(low, F.lit(words[0]))), F.lit(False))
    row = values.select("value").distinct().agg(has("crispra", "activation").alias("a"), has("crispri", "interference").alias("i"), has("knockout", "crispr-ko", "crisprko").alias("k"))
    return row.select(F.when(F.col("a"), "CRISPRa").when(F.col("i"), "CRISPRi").when(F.col("k"), "CRISPRko").otherwise("CRISPRi").alias("perturbation_type"))


def route_features(var: DataFrame) -> DataFrame:
    """Var with ``route``: antibodies, peaks or genes, by type or by name."""
    kind = F.col("feature_type") if "feature_type" in var.columns else F.lit("Gene Expression")
    return var.withColumn("route", F.when(kind == "Antibody Capture", "adt").when(F.col("gene_name").rlike(PEAK), "atac").otherwise("rna"))


@dataclass(frozen=True)
class Columns:
    """What detection finds: column names of obs, or None."""

    perturbation: str | None
    batch: str | None
    cell_line: str | None


def _hits(name: str, words: tuple[str, ...]) -> int:
    return sum(w.lower() in name.lower() for w in words)


def detect_columns(obs: DataFrame, gene_like_test: bool = True, known: Columns = Columns(None, None, None)) -> Columns:
    """The columns of perturbations, batches and cell lines by their names and
    values.  All string columns are summarised in one pass of bounded size; ``known``
    ones win.  Of the columns that can be lines the one of the best score, the first of
    equals, is taken, even without a hit in its name; without ``gene_like_test`` names
    alone are scored, and need a hit."""
    names = [f.name for f in obs.schema.fields if f.name != "cell_id"]
    text = [f.name for f in obs.schema.fields if isinstance(f.dataType, StringType)]
    if not names:
        return known
    counts = obs.agg(*[F.count_distinct(n).alias(n) for n in names]).first().asDict()
    fits = [n for n in text if _hits(n, PERTURBATION_WORDS) and 2 <= counts[n] <= 50_000]
    pert = known.perturbation or max(fits, key=lambda n: _hits(n, PERTURBATION_WORDS), default=None)
    batch = known.batch or next((n for n in names if n != pert and _hits(n, BATCH_WORDS) and 2 <= counts[n] <= 10_000), None)
    line, best = known.cell_line, -1 if gene_like_test else 0
    for n in text if line is None else []:
        if n in (pert, batch) or not 2 <= counts[n] <= 20:
            continue
        values = [r[0] for r in obs.select(n).filter(F.col(n).isNotNull()).distinct().orderBy(n).limit(20).collect()]
        if any(len(v) > 40 for v in values):
            continue
        score = _hits(n, LINE_WORDS_OF_NAMES)
        if gene_like_test:
            if counts[n] > 5 and sum(bool(re.match(GENE_LIKE, v)) for v in values) > 0.6 * len(values):
                continue
            score = 2 * _hits(n.replace("-", "_").replace(" ", "_"), LINE_WORDS) + sum(re.sub("[-_ ]", "", v.lower()) in LINE_NAMES for v in values)
        if score > best:
            line, best = n, score
    return Columns(pert, batch, line)
