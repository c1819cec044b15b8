"""Population models: ``m(model, tree, pop, pop_ix, sample, sample_ix)``, one row per member."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from allelespan.operators.sampling import draw, take_lowest

COLUMNS = ["model", "tree", "pop", "pop_ix", "sample", "sample_ix"]


def _numbered(members: DataFrame) -> DataFrame:
    """Recompute population and sample positions, keeping the given order.

    Windows are per model or population: tables as small as the cohort.
    """
    pops = members.groupBy("model", "pop").agg(F.min("pop_ix").alias("__p"))
    pops = pops.select(
        "model", "pop",
        (F.row_number().over(W.partitionBy("model").orderBy("__p", "pop")) - 1).cast("int").alias("pop_ix"),
    )
    inside = W.partitionBy("model", "pop").orderBy("sample_ix", "sample")
    return (
        members.drop("pop_ix")
        .join(pops, ["model", "pop"])
        .withColumn("sample_ix", (F.row_number().over(inside) - 1).cast("int"))
        .select(*COLUMNS)
    )


def model_create(
    spark: SparkSession, model: str, pops: dict[str, list[str]], tree: str | None = None
) -> DataFrame:
    """Model from name lists; repeated individuals of a population are kept once."""
    rows = [
        (model, tree, pop, i, name, j)
        for i, (pop, names) in enumerate(pops.items())
        for j, name in enumerate(dict.fromkeys(names))
    ]
    schema = "model string, tree string, pop string, pop_ix int, sample string, sample_ix int"
    return spark.createDataFrame(rows, schema)


def model_from_table(members: DataFrame, model: str, tree: str | None = None) -> DataFrame:
    """Model from a table ``pop, sample``; populations and samples are ordered by name."""
    t = members.select("pop", "sample").dropDuplicates()
    t = t.select(
        F.lit(model).alias("model"), F.lit(tree).cast("string").alias("tree"), "pop",
        F.lit(0).alias("pop_ix"), "sample", F.lit(0).alias("sample_ix"),
    )
    return _numbered(t)


def model_update_inds(
    m: DataFrame, model: str, pop: str, add: list[str] | None = None, remove: list[str] | None = None
) -> DataFrame:
    """Add and remove individuals of one population; a name on both sides is an error."""
    add, remove = list(add or []), list(remove or [])
    clash = set(add) & set(remove)
    if clash:
        raise ValueError(f"individuals both added and removed: {sorted(clash)}")
    here = (F.col("model") == model) & (F.col("pop") == pop)
    out = m.filter(~(here & F.col("sample").isin(remove))) if remove else m
    if add:
        last = 1 << 30
        new = m.sparkSession.createDataFrame([(n, last + i) for i, n in enumerate(add)], "sample string, sample_ix int")
        head = m.filter(here).groupBy("model", "tree", "pop", "pop_ix").agg(F.count("*").alias("n")).drop("n")
        new = head.withColumn("__k", F.lit(1)).join(new.withColumn("__k", F.lit(1)), "__k").select(*COLUMNS)
        known = m.filter(here).select("sample")
        out = out.unionByName(new.join(known, "sample", "left_anti").select(*COLUMNS))
    return _numbered(out)


def model_update_pops(
    m: DataFrame, model: str, add: dict[str, list[str]] | None = None, remove: list[str] | None = None
) -> DataFrame:
    """Add and remove whole populations of a model."""
    add, remove = dict(add or {}), list(remove or [])
    clash = set(add) & set(remove)
    if clash:
        raise ValueError(f"populations both added and removed: {sorted(clash)}")
    out = m.filter(~((F.col("model") == model) & F.col("pop").isin(remove))) if remove else m
    if add:
        new = model_create(m.sparkSession, model, add).withColumn("pop_ix", F.col("pop_ix") + (1 << 30))
        tree = m.filter(F.col("model") == model).agg(F.max("tree")).scalar()
        out = out.unionByName(new.withColumn("tree", tree).select(*COLUMNS))
    return _numbered(out.dropDuplicates(["model", "pop", "sample"]))


def model_set_tree(m: DataFrame, model: str, tree: str) -> DataFrame:
    """Assign a tree; every population of the model must occur in it."""
    absent = F.raise_error(F.concat(F.lit("population not in tree: "), "pop")).cast("string")
    checked = F.when(F.lit(tree).contains(F.col("pop")), F.lit(tree)).otherwise(absent)
    return m.withColumn("tree", F.when(F.col("model") == model, checked).otherwise(F.col("tree")))


def model_copy(m: DataFrame, model: str, name: str) -> DataFrame:
    """Add a copy of a model under a new name."""
    return m.unionByName(m.filter(F.col("model") == model).withColumn("model", F.lit(name)))


def model_rename(m: DataFrame, model: str, name: str) -> DataFrame:
    return m.withColumn("model", F.when(F.col("model") == model, F.lit(name)).otherwise(F.col("model")))


def model_counts(m: DataFrame) -> DataFrame:
    """Populations and individuals per model: ``model, n_pops, n_inds``."""
    return m.groupBy("model").agg(
        F.countDistinct("pop").alias("n_pops"), F.countDistinct("sample").alias("n_inds")
    )


def pop_counts(m: DataFrame) -> DataFrame:
    return m.groupBy("model", "pop").agg(F.countDistinct("sample").alias("n_inds"))


def model_check(m: DataFrame) -> DataFrame:
    """Populations whose members differ between models: ``pop, n_versions``."""
    sets = m.groupBy("model", "pop").agg(
        F.array_join(F.array_sort(F.collect_set("sample")), ",").alias("members")
    )
    return (
        sets.groupBy("pop").agg(F.countDistinct("members").alias("n_versions")).filter("n_versions > 1")
    )


def unique_individuals(m: DataFrame) -> DataFrame:
    return m.select("sample").distinct()


def exclude_individuals(m: DataFrame, names: DataFrame) -> DataFrame:
    """The model file's individuals minus a list (``sample``)."""
    return unique_individuals(m).join(names.select("sample"), "sample", "left_anti")


def pops_not_in_model(m: DataFrame, pops: DataFrame) -> DataFrame:
    return pops.select("pop").distinct().join(m.select("pop"), "pop", "left_anti")


def assign_population(samples: DataFrame, m: DataFrame, unknown: str | None = None) -> DataFrame:
    """Left join of the sample's population; ``unknown`` fills samples outside the model."""
    lookup = m.select("sample", "pop").dropDuplicates(["sample"])
    out = samples.drop("pop").join(lookup, "sample", "left")
    return out if unknown is None else out.withColumn("pop", F.coalesce("pop", F.lit(unknown)))


def sample_pops(
    m: DataFrame, n: int, pop: str | None = None, replace: bool = False, seed: int = 0, draw_col=None
) -> DataFrame:
    """``n`` individuals from one or each population of each model.

    With replacement, draw k of a population picks the member at position
    ``hash(seed, pop, k) mod size``.
    """
    if pop is not None:
        m = m.filter(F.col("pop") == pop)
    if not replace:
        u = draw(seed, "model", "pop", "sample") if draw_col is None else draw_col
        return take_lowest(m, n, u, ["sample"], by=["model", "pop"])
    sizes = m.groupBy("model", "pop").agg(F.count("*").alias("size"))
    draws = sizes.select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("k"))
    at = F.pmod(F.xxhash64(F.lit(seed), "model", "pop", "k") if draw_col is None else draw_col, F.col("size"))
    draws = draws.withColumn("sample_ix", at.cast("int")).select("model", "pop", "k", "sample_ix")
    return draws.join(m, ["model", "pop", "sample_ix"]).select("k", *COLUMNS)
