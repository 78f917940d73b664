"""Features, training, evaluation, scenarios and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mairie.functions.mappings import MAIN_BLOCS
from mairie.functions.territory import TERRITORY_TYPES, territory_rank
from mairie.operators import joins
from mairie.operators.aggregates import crosstab
from mairie.operators.harmonise import add_missing, enforce_schema
from mairie.operators.medians import medians
from mairie.operators.windows import MAIN_SHARES, lag_features, trend_features
from mairie.plans import trees
from mairie.session import cut_lineage
from mairie.sources.schemas import table_schema

# Label order, feature lists, scenario years and learner settings.
LABELS = ["Centre", "Divers", "Droite", "ExtremeDroite", "Gauche"]
LAGS = [f"{c}_lag1" for c in MAIN_SHARES]
TRENDS = [f"{c}_trend" for c in MAIN_SHARES]
OCCUPATION = ["cadres_pct", "ouvriers_pct", "employes_pct", "artisans_pct"]
DIPLOMA = ["pct_bac_plus", "pct_sans_diplome"]
VITAL = ["nb_naissances", "nb_deces", "solde_naturel"]
INCOME = ["mediane_revenu_disp", "gini", "taux_pauvrete"]
FEATURES = LAGS + TRENDS + OCCUPATION + DIPLOMA + VITAL + ["typo_ord"] + INCOME + ["annee"]
PILOT_FEATURES = LAGS + TRENDS + OCCUPATION + DIPLOMA + VITAL + ["annee"]
TARGET_YEARS = [2025, 2026, 2027]
EARLIER_YEAR, BASE_YEAR, LAST_TRAIN_YEAR = 2017, 2022, 2017
STEP_YEARS = 5
FOREST = dict(numTrees=200, maxDepth=8, minInstancesPerNode=3, seed=42)
BOOSTING = dict(maxIter=200, maxDepth=4, stepSize=0.05, subsamplingRate=0.8, treesPerRound=4, seed=42)


def feature_names(scope: str = "national", leak_free: bool = False) -> list[str]:
    """Model inputs.  The trends contain the current result, that is the target itself;
    ``leak_free`` leaves them out."""
    names = PILOT_FEATURES if scope == "pilot" else FEATURES
    return [n for n in names if not (leak_free and n in TRENDS)]


def model_rows(gold: DataFrame) -> DataFrame:
    """Gold rows with lags, trends and the ordinal typology."""
    rows = trend_features(lag_features(gold))
    if "typologie_territoire" in rows.columns:
        rows = rows.withColumn("typo_ord", territory_rank("typologie_territoire"))
    return rows


def train_medians(train: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact medians of the training rows; features without any value are left out.

    One row of as many numbers as there are features reaches the driver.
    """
    row = medians(train, features, ()).first().asDict()
    return {c: v for c, v in row.items() if v is not None}


def fill_medians(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in values.items()})


def label_indexer(labels: Sequence[str] = LABELS, target: str = "bloc_dominant") -> StringIndexerModel:
    """Encoding over a fixed label list, independent of the data."""
    return StringIndexerModel.from_labels(list(labels), target, "label", handleInvalid="error")


def class_weights(df: DataFrame, label: str = "bloc_dominant", name: str = "poids") -> DataFrame:
    """Balanced weights ``n / (classes * n_class)``.

    Class counts come from one aggregate; they are as few as the classes, and the
    join needs no shuffle of the rows.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    overall = counts.agg(F.struct(F.sum("_n").cast("double"), F.count(F.lit(1)))).scalar()
    weights = counts.select(
        label, (overall["col1"] / (overall["col2"] * F.col("_n"))).alias(name)
    )
    return joins.left_enrich(df, weights, label, facts=True)


def territory_one_hot(df: DataFrame, column: str = "typologie_territoire", output: str = "typo_vec") -> DataFrame:
    """One-hot typology without its first level; unknown labels are all zeros.

    The encoder drops the last index, so the level to drop is indexed last; unknown
    labels get an extra index that the same rule keeps out.
    """
    first, *kept = sorted(TERRITORY_TYPES)
    indexer = StringIndexerModel.from_labels([*kept, first], column, "_typo", handleInvalid="keep")
    indexed = indexer.transform(df)
    # Known levels are 0..k-1 with the dropped one at k-1; an unknown label is k.
    known = F.least(F.col("_typo"), F.lit(float(len(kept))))
    encoder = OneHotEncoder(inputCol="_typo", outputCol=output, dropLast=True)
    fixed = indexed.withColumn("_typo", known)
    sizes = indexed.sparkSession.range(len(kept) + 1).select(F.col("id").cast("double").alias("_typo"))
    return encoder.fit(sizes).transform(fixed).drop("_typo")


@dataclass
class Trained:
    """A fitted classifier with the inputs it expects and the labels it has seen."""

    name: str
    model: trees.Ensemble
    features: list[str]
    fills: dict[str, float]
    labels: list[str]
    importances: list[tuple[str, float]] = field(default_factory=list)

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``bloc_predit`` and one probability per label, ``prob_<label>``; ties go to the first label."""
        values = [F.coalesce(F.col(c).cast("double"), F.lit(self.fills[c])) for c in self.features]
        out = df.withColumn("_p", self.model.column(*values))
        best = F.array_position("_p", F.array_max("_p")).cast("int") - 1
        columns = {"bloc_predit": F.get(F.array(*[F.lit(x) for x in self.labels]), best)}
        for i, label in enumerate(self.labels):
            columns[f"prob_{label.lower()}"] = F.get("_p", F.lit(i))
        return out.withColumns(columns).drop("_p")


ROW_KEY = ("code_commune", "annee")


def _training_blocks(train: DataFrame, features: Sequence[str], target: str, weighted: bool = True):
    """Binned rows with label index and weight, written once: every level of the trees passes over them.

    A row's key, which decides the samples it is drawn into, is a hash of ``ROW_KEY`` where the rows
    have these columns, else of the features and the label.
    """
    fills = train_medians(train, features)
    used = [f for f in features if f in fills]
    seen = [r[0] for r in train.select(target).distinct().where(F.col(target).isin(LABELS)).collect()]
    labels = [x for x in LABELS if x in seen]
    rows = train.where(F.col(target).isin(labels))
    rows = class_weights(rows, target) if weighted else rows.withColumn("poids", F.lit(1.0))
    values = [F.coalesce(F.col(c).cast("double"), F.lit(fills[c])) for c in used]
    key = [c for c in ROW_KEY if c in rows.columns] or [*used, target]
    label = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(target)).cast("int") - 1
    kept = rows.select(F.array(*values).alias("x"), label.alias("y"), F.col("poids").alias("w"), F.xxhash64(*key).alias("key"))
    return trees.prepare(cut_lineage(kept, "training"), len(used), len(labels)), used, fills, labels


def _ranked(used: Sequence[str], model: trees.Ensemble) -> list[tuple[str, float]]:
    return sorted(zip(used, map(float, model.gains), strict=True), key=lambda x: (-x[1], x[0]))


def train_forest(train: DataFrame, features: Sequence[str] = FEATURES, target: str = "bloc_dominant", **settings) -> Trained:
    """A random forest with balanced class weights; ``settings`` override ``FOREST``."""
    blocks, used, fills, labels = _training_blocks(train, features, target)
    s = {**FOREST, **settings}
    model = trees.grow_forest(blocks, s["numTrees"], s["maxDepth"], s["minInstancesPerNode"], seed=s["seed"])
    return Trained("RandomForest", model, used, fills, labels, _ranked(used, model))


def train_boosting(train: DataFrame, features: Sequence[str] = FEATURES, target: str = "bloc_dominant", **settings) -> Trained:
    """Multiclass boosted trees, ``maxIter`` per class; ``settings`` override ``BOOSTING``."""
    blocks, used, fills, labels = _training_blocks(train, features, target, weighted=False)
    s = {**BOOSTING, **settings}
    model = trees.boost(
        blocks, s["maxIter"], s["maxDepth"], s["stepSize"], s["subsamplingRate"], s["treesPerRound"], seed=s["seed"]
    )
    return Trained("GradientBoosting", model, used, fills, labels, _ranked(used, model))


def accuracy(predicted: DataFrame, target: str = "bloc_dominant", by: Sequence[str] = ()) -> DataFrame:
    """Share of right predictions, overall or per group (for example per typology)."""
    right = F.count_if(F.col(target) == F.col("bloc_predit"))
    n = F.count(F.lit(1))
    return predicted.groupBy(*by).agg(n.alias("n"), (right.cast("double") / n).alias("accuracy"))


def confusion_matrix(
    predicted: DataFrame, target: str = "bloc_dominant", labels: Sequence[str] = LABELS
) -> DataFrame:
    return crosstab(predicted, target, "bloc_predit", labels)


def classification_report(predicted: DataFrame, target: str = "bloc_dominant") -> DataFrame:
    """Precision, recall, F1 and support per class, then macro and weighted averages.

    The rows are counted once per (label, prediction); all figures are arithmetic
    on those few counts.  An empty denominator gives 0.
    """
    pairs = predicted.groupBy(F.col(target).alias("y"), F.col("bloc_predit").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("y").alias("classe"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("tp"),
                    F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predits"),
                ),
                F.struct(
                    F.col("p").alias("classe"), F.lit(0).cast("bigint").alias("tp"),
                    F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predits"),
                ),
            )
        )
    )
    by_class = sides.groupBy("classe").agg(
        F.sum("tp").cast("double").alias("tp"), F.sum("support").alias("support"), F.sum("predits").alias("predits")
    )
    precision = F.when(F.col("predits") > 0, F.col("tp") / F.col("predits")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    p, r = F.col("precision"), F.col("recall")
    scored = by_class.withColumns({"precision": precision, "recall": recall}).select(
        "classe", "precision", "recall",
        F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1"), "support",
    )
    # A dozen rows at most; averaged in class order so that the sums are reproducible.
    rows = F.array_sort(F.collect_list(F.struct("classe", "precision", "recall", "f1", "support")))
    listed = scored.agg(rows.alias("rows"), F.sum("support").alias("total"))

    def average(metric: str, weighted: bool):
        def add(acc, x):
            return acc + (x[metric] * x["support"] if weighted else x[metric])

        bottom = F.col("total") if weighted else F.size("rows")
        return F.aggregate("rows", F.lit(0.0), add) / bottom

    summaries = [
        F.struct(
            F.lit(name).alias("classe"),
            *[average(m, weighted).alias(m) for m in ("precision", "recall", "f1")],
            F.col("total").alias("support"),
        )
        for name, weighted in (("macro avg", False), ("weighted avg", True))
    ]
    return listed.select(F.inline(F.concat("rows", F.array(*summaries))))


def importances(trained: Trained, spark, top: int | None = 10) -> DataFrame:
    rows = [(i + 1, n, v) for i, (n, v) in enumerate(trained.importances[:top])]
    return spark.createDataFrame(rows, "rang int, variable string, importance double")


def accuracy_value(predicted: DataFrame, target: str = "bloc_dominant") -> float:
    return float(accuracy(predicted, target).first()["accuracy"] or 0.0)


def choose_model(first: Trained, first_accuracy: float, second: Trained, second_accuracy: float) -> Trained:
    """The better one; the first wins a tie."""
    return first if first_accuracy >= second_accuracy else second


def scenario_rows(
    rows: DataFrame,
    base_year: int = BASE_YEAR,
    earlier_year: int = EARLIER_YEAR,
    years: Sequence[int] = TARGET_YEARS,
    step: int = STEP_YEARS,
) -> DataFrame:
    """Model inputs for future years.

    The lag is the base-year share and the trend is the change since the earlier
    year scaled by the years ahead; births, deaths and balance are extrapolated the
    same way; everything else stays.  A municipality without an earlier row has
    trend 0.  The base rows are exploded into the literal years.
    """
    moving = [*MAIN_SHARES, *VITAL]
    base = rows.where(F.col("annee") == base_year)
    earlier = rows.where(F.col("annee") == earlier_year).select("code_commune", *moving)
    changed = joins.difference_to(base, earlier, moving, suffix="_delta")
    future = joins.for_each_year(changed, years, "_cible")
    scale = (F.col("_cible").cast("int") - base_year) / F.lit(float(step))
    out = {}
    for c in MAIN_SHARES:
        out[f"{c}_lag1"] = F.col(c).cast("double")
        out[f"{c}_trend"] = F.col(f"{c}_delta") * scale
    for c in VITAL:
        out[c] = F.col(c).cast("double") + F.col(f"{c}_delta") * scale
    out["annee"] = F.col("_cible")
    return future.withColumns(out).drop("_cible", *[f"{c}_delta" for c in moving])


def score(trained: Trained, scenarios: DataFrame, digits: int = 3) -> DataFrame:
    """The typed prediction table; classes the model never saw have null probabilities."""
    wanted = {f"prob_{b.lower()}": "double" for b in MAIN_BLOCS}
    predicted = add_missing(trained.predict(scenarios), wanted)
    rounded = predicted.withColumns({c: F.bround(c, digits) for c in wanted})
    return enforce_schema(
        rounded.withColumn("modele", F.lit(trained.name)), table_schema("predictions")
    )


def extrapolated_bloc(scenarios: DataFrame) -> DataFrame:
    """Rule-based prediction: the largest of lag + trend, ties in bloc order."""
    from mairie.functions.mappings import arg_max_label

    expected = [F.col(f"{c}_lag1") + F.col(f"{c}_trend") for c in MAIN_SHARES]
    return scenarios.withColumn("bloc_predit", arg_max_label(expected, MAIN_BLOCS))


def previous_bloc(rows: DataFrame) -> DataFrame:
    """Baseline prediction: the bloc of the previous election."""
    return rows.withColumn("bloc_predit", F.col("bloc_lag1"))
