"""The generic test tables in the shapes that the pipelines expect.

A municipality is the customer key modulo 150, its department the key modulo 10.
Election results are order lines, births and deaths are events, incomes are account
balances, occupations are ordered quantities by part type, diplomas are labelled
documents and population bands are counts of order lines.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mairie.functions.numbers import to_number
from mairie.operators.harmonise import enforce_schema
from mairie.operators.medians import medians
from mairie.plans import gold as gold_plan
from mairie.plans import modelling, silver
from mairie.plans.questions import Report
from mairie.session import new_path, shared_dir
from mairie.sources.schemas import PARTITIONS, table_schema
from mairie.sources.tables import write_table

COMMUNES = 150
DEPARTMENTS = [f"{d:02d}" for d in range(10)]
BASE, EARLIER = 2001, 1996
FUTURE = [2004, 2005, 2006]
INCOME_YEAR = SNAPSHOT = 2000
LARGE = ["01", "03", "05", "07", "09"]
TOWN_SIZES = (380, 420)
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
POPULATION_BANDS = {"P22_POP0014": (1, 2), "P22_POP1529": (3, 4), "P22_POP30P": (5, 99)}

# Columns of a line that occupations and population bands count.
LINE_COLUMNS = ["l_partkey", "l_linenumber", "l_quantity", "l_returnflag"]

_written: dict[tuple[str, ...], DataFrame] = {}


def code(key) -> F.Column:
    return F.lpad(key.cast("string"), 5, "0")


class Tables:
    """Lazy views over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def _key(self, name: str) -> tuple[str, ...]:
        return (shared_dir(self.spark), self.spark.sparkContext.applicationId, self.folder, name)

    def once(self, name: str, build, partition_by=(), rebalance: bool = True) -> DataFrame:
        """A stored table: built once per session and folder, in the shared folder."""
        key = self._key(name)
        if key not in _written:
            _written[key] = write_table(build(), new_path(self.spark, name), partition_by, rebalance)
        return _written[key]

    # Bronze shapes: every column is text.

    def bronze_referential(self) -> DataFrame:
        k = F.col("k")
        keys = self.read("customer").select((F.col("c_custkey") % COMMUNES).alias("k")).distinct()
        return keys.select(
            k.cast("string").alias("COM"),
            F.concat(F.lit("Commune "), k.cast("string")).alias("LIBELLE"),
            F.concat(F.lit("C"), k.cast("string")).alias("NCC"),
            (k % 10).cast("string").alias("DEP"),
            F.when(k % 4 == 0, "COM").when(k % 4 == 1, "ARM").when(k % 4 == 2, "COMA").alias("TYPECOM"),
        )

    def lines(self) -> DataFrame:
        orders, lineitem = self.read("orders"), self.read("lineitem")
        return orders.join(lineitem, F.col("o_orderkey") == F.col("l_orderkey")).withColumn(
            "k", F.col("o_custkey") % COMMUNES
        )

    def counted_lines(self) -> DataFrame:
        """The lines with the columns that occupations and population count, from the stored results if they are there."""
        stored = _written.get(self._key("result-lines"))
        return (self.lines() if stored is None else stored).select("k", *LINE_COLUMNS)

    def _vote_columns(self) -> dict:
        p, flag = F.col("o_orderpriority"), F.col("l_returnflag")
        return {
            "kind": F.when(F.col("o_orderstatus") == "F", "pres")
            .when(F.col("o_orderstatus") == "O", "legi")
            .otherwise("muni"),
            "tour": F.col("l_linenumber") % 2 + 1,
            "annee": F.year("o_orderdate"),
            "nuance": F.when(p == "1-URGENT", "SOC")
            .when(p == "2-HIGH", "REM")
            .when(p == "3-MEDIUM", "LR")
            .when(p == "5-LOW", "RN"),
            "nom": F.when(
                p == "4-NOT SPECIFIED",
                F.when(flag == "R", "MACRON").when(flag == "A", "Le Pen ").otherwise("INCONNU"),
            ),
            "voix": F.col("l_quantity").cast("bigint"),
        }

    def bronze_elections(self) -> DataFrame:
        c = self._vote_columns()

        def comma(name):
            return F.replace(F.col(name).cast("decimal(8,2)").cast("string"), F.lit("."), F.lit(","))

        return self.lines().select(
            F.col("k").cast("string").alias("code_commune"),
            F.concat(c["annee"].cast("string"), F.lit("_"), c["kind"], F.lit("_t"), c["tour"].cast("string")).alias(
                "id_election"
            ),
            c["nuance"].alias("nuance"),
            c["nom"].alias("nom"),
            c["voix"].cast("string").alias("voix"),
            comma("l_tax").alias("ratio_voix_inscrits"),
            comma("l_discount").alias("ratio_voix_exprimes"),
        )

    def bronze_vital(self) -> DataFrame:
        kind = F.col("event_type")
        rows = self.read("events").where(kind.isin("signup", "error"))
        return (
            rows.groupBy(
                (F.col("user_id") % COMMUNES).cast("string").alias("GEO"),
                (1996 + 2 * (F.day("ts") % 3)).cast("string").alias("TIME_PERIOD"),
                F.when(kind == "signup", "NAIS").otherwise("DECES").alias("EC_MEASURE"),
            )
            .agg(F.count(F.lit(1)).cast("string").alias("OBS_VALUE"))
        )

    def bronze_income(self) -> DataFrame:
        k = F.col("k")
        balances = self.read("customer").select((F.col("c_custkey") % COMMUNES).alias("k"), "c_acctbal")
        m = medians(balances, ["c_acctbal"], ["k"])

        def comma(c):
            return F.replace(c.cast("string"), F.lit("."), F.lit(","))

        known = ~((k % 10 == 3) | (k % 11 == 0))
        gini = ((20 + k % 30).cast("decimal(6,0)") / 100).cast("decimal(6,2)")
        return m.select(
            F.col("k").cast("string").alias("Libellé"),
            F.col("k").cast("string").alias("Code géographique"),
            comma(F.when(known, (F.col("c_acctbal") * 4).cast("decimal(12,2)"))).alias("[DISP] Médiane (€)"),
            comma(F.when(k % 7 == 0, gini)).alias("[DISP] Indice de Gini"),
        )

    def bronze_occupations(self) -> DataFrame:
        part = self.read("part")
        rows = self.counted_lines().join(part, F.col("l_partkey") == F.col("p_partkey"))
        columns = []
        for i, kind in enumerate(PART_TYPES, start=1):
            own = F.col("p_type") == kind
            employed = F.sum(F.when(own, F.col("l_quantity").cast("bigint")))
            jobless = F.count_if(own & (F.col("l_returnflag") == "R"))
            columns.append(employed.cast("string").alias(f"csx_rec{i}taxtypac_rec1rpop2022"))
            columns.append(jobless.cast("string").alias(f"csx_rec{i}taxtypac_rec2rpop2022"))
        return rows.groupBy("k").agg(*columns).select(
            F.lit("0").alias("DR"), F.col("k").cast("string").alias("CR"), *[c for c in self._csp_names()]
        )

    @staticmethod
    def _csp_names() -> list[str]:
        return list(silver.OCCUPATION_COLUMNS)

    def bronze_diplomas(self) -> DataFrame:
        rows = self.read("documents").select("doc_id").join(self.read("labels"), "doc_id", "left")

        def some(condition):
            return F.nullif(F.count_if(condition), F.lit(0)).cast("string")

        return rows.groupBy((F.col("doc_id") % COMMUNES).cast("string").alias("CODGEO")).agg(
            F.count("quality").cast("string").alias("P22_NSCOL15P"),
            F.count_if(F.col("quality") == 0).cast("string").alias("P22_NSCOL15P_DIPLMIN"),
            some((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("P22_NSCOL15P_SUP2"),
            some(F.col("toxic") == 1).alias("P22_NSCOL15P_SUP34"),
        )

    def bronze_population(self) -> DataFrame:
        bands = [
            F.nullif(F.count_if(F.col("l_linenumber").between(low, high)), F.lit(0)).cast("string").alias(name)
            for name, (low, high) in POPULATION_BANDS.items()
        ]
        return self.counted_lines().groupBy(F.col("k").cast("string").alias("CODGEO")).agg(*bands)

    # Silver tables, stored like those of the real pipeline.

    def referential(self) -> DataFrame:
        return self.once("referential", self.build_referential)

    def build_referential(self) -> DataFrame:
        return silver.referential(self.bronze_referential().drop("TYPECOM"), DEPARTMENTS)

    def elections(self) -> DataFrame:
        """Results partitioned by type and year: questions read only what they filter."""
        stored = _written.get(self._key("result-lines"))
        if stored is not None:
            return stored.drop("k", *LINE_COLUMNS)
        return self.once("elections", self.build_elections, PARTITIONS["elections"])

    def build_elections(self) -> DataFrame:
        return self.build_result_lines().drop("k", *LINE_COLUMNS)

    def build_result_lines(self) -> DataFrame:
        """Results with the line columns that other tables count: one join and one write serve all."""
        c = self._vote_columns()
        return self.lines().select(
            "k",
            *LINE_COLUMNS,
            code(F.col("k")).alias("code_commune"),
            c["annee"].cast("smallint").alias("annee"),
            c["kind"].alias("type_election"),
            c["tour"].cast("smallint").alias("tour"),
            c["nuance"].alias("nuance_liste"),
            c["nom"].alias("nom_candidat"),
            c["voix"].cast("int").alias("nb_voix"),
        )

    def votes(self) -> DataFrame:
        return gold_plan.votes_by_bloc(self.elections())

    def results(self) -> DataFrame:
        return gold_plan.election_results(self.elections())

    def births(self) -> DataFrame:
        return self.once("births", self.build_births)

    def build_births(self) -> DataFrame:
        return silver.vital_events(self.bronze_vital(), None, "nb_naissances", ["LVB", "NAIS"])

    def deaths(self) -> DataFrame:
        return self.once("deaths", self.build_deaths)

    def build_deaths(self) -> DataFrame:
        return silver.vital_events(self.bronze_vital(), None, "nb_deces", ["LDB", "DECES"])

    def income(self) -> DataFrame:
        return self.once("income", self.build_income)

    def build_income(self) -> DataFrame:
        return silver.income(self.bronze_income(), None, year=INCOME_YEAR)

    def occupations(self) -> DataFrame:
        return self.once("occupations", self.build_occupations)

    def build_occupations(self) -> DataFrame:
        return silver.occupations(self.bronze_occupations(), None, SNAPSHOT)

    def diplomas(self) -> DataFrame:
        return self.once("diplomas", self.build_diplomas)

    def build_diplomas(self) -> DataFrame:
        return silver.diplomas(self.bronze_diplomas(), None, SNAPSHOT)

    def typology(self) -> DataFrame:
        return self.once("typology", self.build_typology)

    def build_typology(self) -> DataFrame:
        return silver.population_typology(self.bronze_population(), TOWN_SIZES, metropolitan=False)

    def population(self) -> DataFrame:
        bands = list(POPULATION_BANDS)
        return self.bronze_population().select(
            code(F.col("CODGEO")).alias("code_commune"), *[to_number(b).alias(b) for b in bands]
        )

    # Gold tables.

    def store_silver(self) -> None:
        """Store the silver tables; their jobs overlap, but for those that count the stored results."""
        others = [self.income, self.diplomas, self.births, self.deaths, self.referential]
        with ThreadPoolExecutor(len(others) + 1) as pool:
            jobs = [pool.submit(build) for build in [self._results_and_counts, *others]]
            for job in jobs:
                job.result()

    def _results_and_counts(self) -> None:
        """Results, occupations and typology from one pass over orders and lines."""
        if self._key("elections") not in _written:
            # The join's tasks write their rows as they are: moving all lines once more costs more than it saves.
            self.once("result-lines", self.build_result_lines, PARTITIONS["elections"], rebalance=False)
        self.occupations()
        self.typology()

    def sources(self) -> dict[str, DataFrame]:
        self.store_silver()
        return {
            "referentiel_communes": self.referential(),
            "elections": self.elections(),
            "naissances": self.births(),
            "deces": self.deaths(),
            "revenus": self.income(),
            "csp": self.occupations(),
            "diplomes": self.diplomas(),
        }

    def build_gold(self) -> DataFrame:
        return gold_plan.features_communes(self.sources(), self.typology(), snapshot_year=SNAPSHOT)

    def unfilled(self) -> DataFrame:
        """Gold rows with every source, before imputation."""
        return self.once("unfilled", lambda: gold_plan.join_sources(self.sources(), self.typology(), snapshot_year=SNAPSHOT))

    def joined(self) -> DataFrame:
        """Election results with the nullable sources, before imputation."""
        return self.once("joined", self._joined)

    def _joined(self) -> DataFrame:
        from mairie.operators import joins

        ref = self.referential().select(F.col("code_insee").alias("code_commune"), "code_dep")
        df = joins.left_enrich(self.results(), ref, "code_commune")
        df = joins.nearest_year_join(df, self.income(), gold_plan.INCOME_FEATURES)
        vital = joins.natural_balance(self.births(), self.deaths())
        return joins.nearest_year_join(df, vital, gold_plan.VITAL_FEATURES)

    def gold(self) -> DataFrame:
        return self.once("features", self.build_gold)

    def model_rows(self) -> DataFrame:
        return modelling.model_rows(self.gold())

    def scenarios(self) -> DataFrame:
        return modelling.scenario_rows(self.model_rows(), BASE, EARLIER, FUTURE)

    def build_predictions(self) -> DataFrame:
        """Rule-based stand-in for a trained model: the largest extrapolated share."""
        rows = modelling.extrapolated_bloc(self.scenarios())
        chances = {
            f"prob_{b}": (F.col(f"pct_{b}_lag1") + F.col(f"pct_{b}_trend")) / 100
            for b in ("gauche", "centre", "droite", "extremedroite")
        }
        rows = rows.withColumns(chances).withColumn("modele", F.lit("Tendance"))
        return enforce_schema(rows, table_schema("predictions"))

    def predictions(self) -> DataFrame:
        return self.once("predictions", self.build_predictions)

    def report(self) -> Report:
        return Report(self.gold(), self.predictions(), BASE, FUTURE[0], FUTURE[-1], LARGE)
