"""Model inputs: which columns, how gaps are filled, how values are scaled."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.expressions import finite, quoted
from ..operators.quantiles import exact_quantiles
from ..operators.slicing import DEFAULT_POLICY, SlicePolicy
from ..session import materialize, spread

# Identifiers, targets and model outputs are never inputs.
NEVER_INPUTS = frozenset(
    {
        "id_ordre_travail", "id_demande", "id_actif", "will_fail_within_30_days", "will_need_spare_parts",
        "anomaly_type_encoded", "spare_parts_cost_target", "intervention_duration_target", "days_to_next_failure",
        "iso_anomaly", "iso_score", "ocsvm_anomaly", "ocsvm_score", "anomaly_consensus", "anomaly_confidence",
    }
)
# Columns that give the parts target away.
PARTS_COLUMNS = frozenset(
    {"has_spare_parts", "spare_parts_cost_ratio", "num_spare_parts_requests", "total_parts_quantity", "total_parts_cost"}
)


def numeric_inputs(df: DataFrame, exclude: Iterable[str] = (), include_flags: bool = False) -> list[str]:
    """Numeric columns that may feed a model.  Booleans stay out unless ``include_flags`` is set."""
    barred = NEVER_INPUTS | set(exclude)
    kinds = (T.NumericType, T.BooleanType) if include_flags else (T.NumericType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in barred]


def zero_filled(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Missing and infinite inputs become 0."""
    return df.withColumns({name: F.coalesce(finite(quoted(name)), F.lit(0.0)) for name in names})


def scaling_pipeline(names: Sequence[str], output: str = "scaled") -> Pipeline:
    """Assemble and standardise.  MLlib divides by the sample deviation; rankings do not depend on it."""
    assembler = VectorAssembler(inputCols=list(names), outputCol=f"{output}_raw", handleInvalid="error")
    scaler = StandardScaler(inputCol=f"{output}_raw", outputCol=output, withMean=True, withStd=True)
    return Pipeline(stages=[assembler, scaler])


def model_matrix(df: DataFrame, names: Sequence[str], output: str = "scaled") -> tuple[DataFrame, PipelineModel]:
    """(df with the scaled vector column, fitted pipeline)."""
    filled = zero_filled(df, names)
    fitted = scaling_pipeline(names, output).fit(filled)
    return fitted.transform(filled).drop(f"{output}_raw"), fitted


@dataclass(frozen=True)
class Standardizer:
    """Median fill and standard scaling as plain column arithmetic; the parameters are one row per feature."""

    medians: Mapping[str, float]
    means: Mapping[str, float]
    deviations: Mapping[str, float]

    @property
    def names(self) -> list[str]:
        return list(self.medians)

    @classmethod
    def fit(cls, df: DataFrame, names: Sequence[str], policy: SlicePolicy = DEFAULT_POLICY) -> Standardizer:
        """Medians of all features in one pass over (feature, value) pairs, then means and deviations."""
        pairs = F.inline(
            F.array(*[F.struct(F.lit(n).alias("feature"), finite(quoted(n)).alias("value")) for n in names])
        )
        found = exact_quantiles(df.select(pairs), ["feature"], "value", {"median": 0.5}, policy=policy)
        medians = {name: 0.0 for name in names} | {row["feature"]: row["median"] for row in found.collect()}
        filled = df.select(*[_filled(name, medians[name]).alias(name) for name in names])
        stats = filled.agg(
            *[F.avg(quoted(n)).alias(f"mean_{i}") for i, n in enumerate(names)],
            *[F.stddev_pop(quoted(n)).alias(f"std_{i}") for i, n in enumerate(names)],
        ).first()
        means = {n: stats[f"mean_{i}"] or 0.0 for i, n in enumerate(names)}
        deviations = {n: stats[f"std_{i}"] or 1.0 for i, n in enumerate(names)}
        return cls(medians, means, deviations)

    def columns(self) -> list:
        """One scaled double column per feature, in order, named ``x0``, ``x1``, ..."""
        return [
            ((_filled(n, self.medians[n]) - F.lit(self.means[n])) / F.lit(self.deviations[n])).alias(f"x{i}")
            for i, n in enumerate(self.names)
        ]

    def to_table(self, spark) -> DataFrame:
        rows = [(i, n, self.medians[n], self.means[n], self.deviations[n]) for i, n in enumerate(self.names)]
        return spark.createDataFrame(rows, "position int, feature string, median double, mean double, deviation double")

    @classmethod
    def from_table(cls, table: DataFrame) -> Standardizer:
        rows = sorted(table.collect(), key=lambda row: row["position"])
        pick = lambda field: {row["feature"]: row[field] for row in rows}
        return cls(pick("median"), pick("mean"), pick("deviation"))


def _filled(name: str, median: float):
    return F.coalesce(finite(quoted(name)), F.lit(float(median)))


def project(df: DataFrame, names: Sequence[str], keep: Sequence[str], policy: SlicePolicy = DEFAULT_POLICY):
    """Two-dimensional principal-component view of the scaled features.

    Returns (rows with ``pc1`` / ``pc2``, explained variance shares).
    """
    df = spread(materialize(df.select(*dict.fromkeys([*keep, *names]))))
    scaler = Standardizer.fit(df, names, policy)
    scaled = df.select(*keep, F.array(*scaler.columns()).alias("_x"))
    vectors = scaled.select(*keep, array_to_vector("_x").alias("_vector"))
    fitted = PCA(k=2, inputCol="_vector", outputCol="_pc").fit(vectors)
    placed = fitted.transform(vectors).withColumn("_pc", vector_to_array("_pc"))
    rows = placed.select(*keep, F.col("_pc")[0].alias("pc1"), F.col("_pc")[1].alias("pc2"))
    return rows, [float(v) for v in fitted.explainedVariance.toArray()]
