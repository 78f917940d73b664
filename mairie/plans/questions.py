"""The twenty report questions and their bundles, over the gold and prediction tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mairie.functions.numbers import exact_mean, round_half_up
from mairie.operators import joins
from mairie.operators.aggregates import averages, count_by, median_and_average
from mairie.operators.ordering import top_groups, union_all
from mairie.operators.windows import share_of_total
from mairie.session import new_path

# Years of the reports, probability columns, and the ten large departments.
ACTUAL_YEAR, FIRST_YEAR, TARGET_YEAR = 2022, 2025, 2027
MAIN_PCT = ["pct_gauche", "pct_centre", "pct_droite", "pct_extremedroite"]
MAIN_PROB = ["prob_gauche", "prob_centre", "prob_droite", "prob_extremedroite"]
LARGE_DEPARTMENTS = ["59", "62", "69", "13", "75", "92", "93", "94", "06", "33"]


def question(
    df: DataFrame,
    aggregations: Mapping[str, Column],
    by: Sequence[str] = (),
    where: Mapping[str, object] | Column | None = None,
    order: Sequence[Column | str] = (),
    limit: int | None = None,
) -> DataFrame:
    """Generic report: named aggregates by keys, equality filters, order and limit."""
    if isinstance(where, Mapping):
        for column, value in where.items():
            df = df.where(F.col(column) == value)
    elif where is not None:
        df = df.where(where)
    out = df.groupBy(*by).agg(*[c.alias(n) for n, c in aggregations.items()])
    if order:
        out = out.orderBy(*order)
    return out if limit is None else out.limit(limit)


def filter_report(df: DataFrame, **choices) -> DataFrame:
    """Report parameters: each given one keeps the rows with that value, or one of several."""
    for column, wanted in choices.items():
        if wanted is None:
            continue
        values = [wanted] if isinstance(wanted, (str, int)) else list(wanted)
        df = df.where(F.col(column).isin(values))
    return df


class Report:
    """Questions over one pair of gold tables; the years default to the published ones."""

    def __init__(
        self,
        features: DataFrame,
        predictions: DataFrame,
        actual: int = ACTUAL_YEAR,
        first: int = FIRST_YEAR,
        target: int = TARGET_YEAR,
        departments: Sequence[str] = LARGE_DEPARTMENTS,
    ):
        self.f, self.p = features, predictions
        self.actual, self.first, self.target = actual, first, target
        self.departments = list(departments)

    def filtered(self, **choices) -> Report:
        """The same questions under report parameters (``annee``, ``code_dep``, ...)."""
        return Report(
            filter_report(self.f, **choices), filter_report(self.p, **choices),
            self.actual, self.first, self.target, self.departments,
        )

    @property
    def _now(self) -> DataFrame:
        return self.f.where(F.col("annee") == self.actual)

    @property
    def _then(self) -> DataFrame:
        return self.p.where(F.col("annee") == self.target)

    def q01(self):
        return averages(self.f, MAIN_PCT, ["annee"])

    def q02(self):
        return count_by(self.f, ["annee", "bloc_dominant"])

    def q03a(self):
        return count_by(self._now, ["bloc_dominant"])

    def q03b(self):
        return self._now.select("code_commune", "libelle", "code_dep", "bloc_dominant")

    def q04(self):
        columns = ["cadres_pct", "ouvriers_pct", "employes_pct", "artisans_pct"]
        return averages(self._now, columns, ["bloc_dominant"])

    def q05(self):
        return averages(self._now, ["pct_bac_plus", "pct_sans_diplome"], ["bloc_dominant"])

    def q06(self):
        return median_and_average(self._now, "mediane_revenu_disp", "taux_pauvrete", ["bloc_dominant"])

    def q07(self):
        return count_by(self._now, ["typologie_territoire", "bloc_dominant"])

    def q08(self):
        columns = ["pct_bac_plus", "cadres_pct", "mediane_revenu_disp"]
        return averages(self._now, columns, ["typologie_territoire"])

    def _top(self, rows: DataFrame, column: str, bloc: str, k: int) -> DataFrame:
        return top_groups(rows.where(F.col(column) == bloc), "code_dep", k)

    def q09(self):
        return self._top(self._now, "bloc_dominant", "Gauche", 10)

    def q10(self):
        return self._top(self._now, "bloc_dominant", "ExtremeDroite", 10)

    def q11(self):
        return count_by(self.p, ["annee", "bloc_predit"])

    def q12a(self):
        return count_by(self._then, ["bloc_predit", "typologie_territoire"])

    def q12b(self):
        return self._then.select("code_commune", "libelle", "code_dep", "bloc_predit", "typologie_territoire")

    def q13(self):
        return averages(self._then, MAIN_PROB)

    def q14(self):
        return count_by(self._then, ["typologie_territoire", "bloc_predit"])

    def q15(self):
        return averages(self._then, ["prob_extremedroite"], ["typologie_territoire"])

    def q16(self):
        return self._top(self._then, "bloc_predit", "ExtremeDroite", 20)

    def q17(self):
        pairs = joins.paired_years(self.p, self.first, self.target, ["code_dep", "bloc_predit"])
        moved = pairs.where(
            (F.col(f"bloc_predit_{self.first}") == "ExtremeDroite")
            & (F.col(f"bloc_predit_{self.target}") == "Centre")
        )
        return top_groups(
            moved.withColumnRenamed(f"code_dep_{self.first}", "code_dep"), "code_dep", 10, "nb_bascules"
        )

    def q18(self):
        def part(rows: DataFrame, label: str, bloc: str) -> DataFrame:
            rows = rows.where(F.col("code_dep").isin(self.departments))
            counts = rows.groupBy("code_dep", F.col(bloc).alias("bloc")).agg(F.count(F.lit(1)).alias("nb"))
            return counts.select(F.lit(label).alias("source"), "code_dep", "bloc", "nb")

        both = union_all(
            part(self._now, f"Reel {self.actual}", "bloc_dominant"),
            part(self._then, f"Predit {self.target}", "bloc_predit"),
        )
        return both.orderBy("code_dep", "source", F.desc("nb"), "bloc")

    def _fate(self, bloc: str) -> DataFrame:
        rows = self.f.where(F.col("bloc_dominant") == bloc)
        return joins.actual_with_predicted(rows, self.p, self.actual, self.target)

    def q19(self):
        counts = count_by(self._fate("ExtremeDroite"), ["bloc_predit"], "nb_communes")
        shares = share_of_total(counts, "nb_communes", "pct")
        return shares.withColumn("pct", round_half_up("pct", 1)).orderBy(F.desc("nb_communes"), "bloc_predit")

    def q20(self):
        rural = self._fate("Gauche").where(F.col("typologie_territoire") == "rural")
        return question(
            rural.select(
                "typologie_territoire",
                F.col("bloc_dominant").alias("bloc_2022"),
                F.col("bloc_predit").alias("bloc_2027"),
                "prob_extremedroite",
            ),
            {
                "nb_communes": F.count(F.lit(1)),
                "prob_xd_moy": round_half_up(exact_mean("prob_extremedroite"), 3),
            },
            by=["typologie_territoire", "bloc_2022", "bloc_2027"],
            order=[F.desc("nb_communes"), "bloc_2027"],
        )


# The questions of each report bundle.
BUNDLES: dict[str, list[str]] = {
    "vue_nationale": ["q01", "q02", "q11"],
    "analyse_sociodemographique": ["q04", "q05", "q06", "q08"],
    "typologie_territoire": ["q07", "q14", "q15"],
    "departements_cles": ["q09", "q10", "q16", "q17"],
    "predictions": ["q12a", "q13", "q16"],
    "comparaison": ["q18", "q19", "q20"],
}
# The parameters that each bundle offers.
BUNDLE_FILTERS: dict[str, list[str]] = {
    "vue_nationale": ["annee"],
    "analyse_sociodemographique": ["annee"],
    "typologie_territoire": ["annee", "typologie_territoire"],
    "departements_cles": ["code_dep"],
    "predictions": ["annee"],
    "comparaison": [],
}


def bundle(report: Report, name: str, **choices) -> dict[str, DataFrame]:
    """The questions of a bundle, after its report parameters."""
    unknown = set(choices) - set(BUNDLE_FILTERS[name])
    if unknown:
        raise ValueError(f"bundle {name} has no parameter {sorted(unknown)}")
    source = report.filtered(**choices) if choices else report
    ask: Callable[[str], DataFrame] = lambda q: getattr(source, q)()
    return {q: ask(q) for q in BUNDLES[name]}


def write_bundle(questions: Mapping[str, DataFrame], folder: str | None = None) -> dict[str, str]:
    """Each question of a bundle as a Parquet table; returns question -> path."""
    paths = {}
    for name, df in questions.items():
        base = folder or new_path(df.sparkSession, "bundle")
        paths[name] = f"{base}/{name}"
        df.write.mode("overwrite").parquet(paths[name])
    return paths
