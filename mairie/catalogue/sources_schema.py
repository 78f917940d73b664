"""SRC and SCH queries: files written from the test tables and read back, and schema work."""

from __future__ import annotations

from pyspark.sql import functions as F

from mairie.catalogue.adapters import DEPARTMENTS, SNAPSHOT, Tables
from mairie.catalogue.registry import query
from mairie.catalogue.sql import with_views
from mairie.functions.codes import commune_code
from mairie.functions.numbers import decimal_comma, sum_ignoring_nulls, to_integer, to_number
from mairie.operators import harmonise as h
from mairie.operators.ordering import first_rows, union_all
from mairie.plans import silver
from mairie.plans.questions import bundle, write_bundle
from mairie.session import cut_lineage, new_path
from mairie.sources import delimited, published, tables
from mairie.sources.schemas import table_schema


def as_text(t: Tables, df, name: str, sep: str = ";") -> str:
    path = new_path(t.spark, name)
    df.write.option("sep", sep).option("header", True).csv(path)
    return path


_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
_CUSTOMER_SQL = (
    "select cast(c_custkey as varchar) c_custkey, c_name, cast(c_nationkey as varchar) c_nationkey, c_mktsegment from customer"
)


@query("src01_delimited_scan", _CUSTOMER_SQL)
def src01(t):
    path = as_text(t, t.read("customer").select(*_CUSTOMER), "src01")
    return delimited.scan_delimited(t.spark, path)


@query("src01_folder_of_headers", _CUSTOMER_SQL.replace(", c_mktsegment", ", case when c_custkey % 2 = 0 then c_mktsegment end c_mktsegment"))
def src01_headers(t):
    """All customers from files of two layouts: other column order, a column less, one separator and encoding."""
    data, path = t.read("customer").select(*_CUSTOMER), new_path(t.spark, "src01")
    halves = (data.where("c_custkey % 2 = 0"), data.where("c_custkey % 2 = 1").select("c_nationkey", "c_custkey", "c_name"))
    for part in halves:
        part.write.mode("append").option("sep", "|").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return delimited.scan_folder(t.spark, path, "|", "ISO-8859-1").select(*_CUSTOMER)


@query(
    "src02_large_scan_filter_load",
    with_views(
        """select cast(substring(id_election, 1, 4) as smallint) annee, split_part(id_election, '_', 2) type_election,
        cast(right(id_election, 1) as smallint) tour, count(*) n, cast(sum(voix) as bigint) voix
        from v_elections where code_commune in (select code_commune from v_known) group by 1, 2, 3"""
    ),
)
def src02(t):
    raw = delimited.scan_delimited(t.spark, as_text(t, t.bronze_elections(), "src02"))
    known = silver.referential(t.bronze_referential(), DEPARTMENTS)
    stored = tables.create_table(silver.elections(raw, known), "elections", new_path(t.spark, "elections"))
    return stored.groupBy("annee", "type_election", "tour").agg(
        F.count(F.lit(1)).alias("n"), F.sum("nb_voix").alias("voix")
    )


@query("src03_header_peek", _CUSTOMER_SQL + " order by customer.c_custkey limit 5")
def src03(t):
    scan = delimited.scan_delimited(t.spark, as_text(t, t.read("customer").select(*_CUSTOMER), "src03"))
    names, _ = delimited.peek(scan)
    return first_rows(scan.select(*names), 5, [to_integer("c_custkey")])


@query(
    "src04_sheet_ingest",
    with_views(
        """select code_commune, cast(nscol15p as double) nscol15p, cast(sans_diplome as double) sans_diplome,
        cast(sup_bac2 as double) sup_bac2 from v_dipl"""
    ),
)
def src04(t):
    data = t.bronze_diplomas()
    path = new_path(t.spark, "src04")
    title = t.spark.range(5).select(F.concat(F.lit("Note "), F.col("id").cast("string")).alias("value"))
    header = t.spark.range(1).select(F.lit(";".join(data.columns)).alias("value"))
    cells = [F.coalesce(F.col(c), F.lit("")) for c in data.columns]
    for part in (title, header, data.select(F.concat_ws(";", *cells).alias("value"))):
        part.write.mode("append").text(path)
    sheet = delimited.scan_sheet(t.spark, path, "CODGEO")
    return sheet.select(
        commune_code("CODGEO").alias("code_commune"),
        to_number("P22_NSCOL15P").alias("nscol15p"),
        to_number("P22_NSCOL15P_DIPLMIN").alias("sans_diplome"),
        to_number("P22_NSCOL15P_SUP2").alias("sup_bac2"),
    )


@query(
    "src04_sheets_of_two_layouts",
    """select c_custkey, c_mktsegment, case when c_custkey % 2 = 0 then cast(c_nationkey as double) end nation from customer""",
)
def src04_layouts(t):
    """All customers from two sheets: notes above headers of other order, a column less, tabs between cells."""
    path, tab = new_path(t.spark, "src04"), "\t"
    halves = {0: ["c_mktsegment", "c_custkey", "c_nationkey"], 1: ["c_custkey", "c_mktsegment"]}
    for rest, names in halves.items():
        part = t.read("customer").where(f"c_custkey % 2 = {rest}").select(*names)
        lines = part.select(F.lit(2).alias("k"), F.concat_ws(tab, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]).alias("value"))
        top = t.spark.createDataFrame([(0, f"Note {rest}"), (1, tab.join(names))], "k int, value string")
        # One file a sheet: its lines are the test's data, not the reader's way.
        top.union(lines).coalesce(1).sortWithinPartitions("k").select("value").write.mode("append").text(path)
    sheet = delimited.scan_sheet(t.spark, path, "c_custkey", "^[0-9]+$", tab)
    return sheet.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_mktsegment", to_number("c_nationkey").alias("nation"))


@query(
    "src05_pushed_scan",
    "select l_orderkey, l_linenumber, l_extendedprice from lineitem where l_returnflag = 'R' and l_quantity >= 45",
)
def src05(t):
    wanted = (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 45)
    return tables.scan_table(
        t.spark, t.path("lineitem"), ["l_orderkey", "l_linenumber", "l_extendedprice"], wanted
    )


def _orders(t: Tables):
    return t.read("orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("prix"))


@query("src06_full_refresh", "select o_orderstatus, count(*) n, true refus, count(*) n_apres_refus from orders group by 1")
def src06(t):
    """All orders replace a first load of them; a third load with repeated keys is refused and changes nothing."""
    path, orders = new_path(t.spark, "src06"), _orders(t)
    published.refresh(orders.withColumn("prix", F.lit(0.0)), path, ["o_orderstatus"], ["o_orderkey"])
    stored = published.refresh(orders, path, ["o_orderstatus"], ["o_orderkey"], rules={"prix": F.col("prix") > 0})
    counted = cut_lineage(stored.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")), "src06")
    try:
        published.refresh(orders.union(orders), path, ["o_orderstatus"], ["o_orderkey"])
        refused = False
    except published.LoadRefused:
        refused = True
    after = published.scan(t.spark, path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_apres_refus"))
    return counted.withColumn("refus", F.lit(refused)).join(after, "o_orderstatus")


@query(
    "src07_append",
    "select o_orderstatus, count(*) n, cast(sum(o_orderkey) as bigint) cles from orders group by 1",
)
def src07(t):
    """Files of all statuses arrive one after the other; every append is run twice."""
    folder, path = new_path(t.spark, "src07-in"), new_path(t.spark, "src07")
    orders = t.read("orders").select("o_orderkey", "o_orderstatus")

    def read(files):
        raw = delimited.scan_delimited(t.spark, files)
        return raw.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus")

    for arrived in (F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "F"):
        orders.where(arrived).write.mode("append").option("sep", ";").option("header", True).csv(folder)
        for _ in range(2):
            stored = published.append_files(t.spark, path, folder, read, ["o_orderstatus"], ["o_orderkey"])
    return stored.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("cles"))


@query(
    "src08_keyed_update",
    """select o_orderkey, o_orderstatus, case when o_orderstatus = 'F' and o_orderkey % 3 = 0 then o_totalprice * 2 else o_totalprice end prix
    from orders""",
)
def src08(t):
    """New prices of some orders of one status; the folders of the other statuses are not written again."""
    path, orders = new_path(t.spark, "src08"), _orders(t)
    published.refresh(orders, path, ["o_orderstatus"])
    changed = orders.where("o_orderstatus = 'F' and o_orderkey % 3 = 0")
    return published.update(t.spark, path, changed.select("o_orderkey", (F.col("prix") * 2).alias("prix")), ["o_orderkey"], "prix")


@query(
    "src08_poverty_update",
    with_views(
        """select code_commune, annee, mediane_revenu_disp, gini,
        case when gini is null then taux_pauvrete else cast(gini * 100 as decimal(6,3)) end taux_pauvrete from v_income"""
    ),
)
def src08_poverty(t):
    stored = cut_lineage(
        t.income().select("code_commune", "annee", "mediane_revenu_disp", "gini", "taux_pauvrete"), "src08"
    )
    new = stored.where("gini is not null").select(
        "code_commune", (F.col("gini") * 100).cast("decimal(6,3)").alias("taux_pauvrete")
    )
    return tables.update_by_key(stored, new, ["code_commune"], "taux_pauvrete")


@query("src09_typed_table", with_views("select code_commune, annee, nb_naissances from v_births"))
def src09(t):
    return tables.create_table(t.births(), "naissances", new_path(t.spark, "naissances"))


@query(
    "src10_report_bundle",
    with_views(
        """select 'q02' question, cast(annee as varchar) cle, bloc_dominant bloc, count(*) n from v_gold group by 2, 3
        union all select 'q11', cast(annee as varchar), bloc_predit, count(*) from v_pred group by 2, 3"""
    ),
)
def src10(t):
    paths = write_bundle(bundle(t.report(), "vue_nationale"))

    def part(name, bloc):
        return t.spark.read.parquet(paths[name]).select(
            F.lit(name).alias("question"), F.col("annee").cast("string").alias("cle"), F.col(bloc).alias("bloc"), "n"
        )

    return union_all(part("q02", "bloc_dominant"), part("q11", "bloc_predit"))


@query(
    "src11_report_parameters",
    with_views(
        """select code_dep, count(*) n from v_gold where annee = 2001 and bloc_dominant = 'Gauche'
        and code_dep in ('01', '02', '05') group by 1"""
    ),
)
def src11(t):
    return bundle(t.report(), "departements_cles", code_dep=["01", "02", "05"])["q09"]


@query(
    "sch01_alias_rename",
    with_views(
        """select cast(k as varchar) code_insee, libelle, cast(k % 10 as varchar) code_dep, typecom "TYPECOM" from v_ref"""
    ),
)
def sch01(t):
    return h.rename_aliases(t.bronze_referential(), h.REFERENTIAL_ALIASES)


@query(
    "sch02_keep_existing",
    with_views("select cast(k as varchar) code_insee, libelle, cast(k % 10 as varchar) code_dep from v_ref"),
)
def sch02(t):
    named = h.rename_aliases(t.bronze_referential(), h.REFERENTIAL_ALIASES)
    return h.keep_existing(named, table_schema("referentiel_communes").fieldNames())


@query(
    "sch03_add_missing",
    with_views(
        """select cast(k as varchar) code_insee, libelle, cast(k % 10 as varchar) code_dep,
        cast(null as varchar) code_reg, cast(null as varchar) statut, cast(null as varchar) arr from v_ref"""
    ),
)
def sch03(t):
    wanted = {f.name: f.dataType for f in table_schema("referentiel_communes").fields}
    return h.add_missing(sch02(t), wanted)


@query(
    "sch04_find_all_keywords",
    with_views("select code_commune, cast(mediane as double) mediane, cast(gini as double) gini from v_income_raw"),
)
def sch04(t):
    raw = t.bronze_income()
    found = {
        "mediane": h.find_all_keywords(raw.columns, ["DISP", "DIAN"], ["DISP", "MEDI"]),
        "gini": h.find_all_keywords(raw.columns, ["DISP", "GINI"]),
    }
    return raw.select(
        commune_code(h.quoted("Code géographique")).alias("code_commune"),
        *[decimal_comma(h.quoted(c)).alias(n) for n, c in found.items()],
    )


def order_years(t: Tables) -> list[int]:
    """The years of all orders, a handful, as the header of a wide file names them."""
    return [r[0] for r in t.read("orders").select(F.year("o_orderdate").alias("y")).distinct().orderBy("y").collect()]


def wide_income(t: Tables, years):
    """Order values per municipality, one column per measure and year."""
    price = F.col("o_totalprice").cast("decimal(14,2)")
    columns = []
    for year in years:
        own = F.when(F.year("o_orderdate") == year, price)
        for label, c in ((f"REV D5 {year}", F.sum(own)), (f"REV D1 {year}", F.min(own)), (f"REV D9 {year}", F.max(own))):
            columns.append(F.replace(c.cast("string"), F.lit("."), F.lit(",")).alias(label))
    key = commune_code(F.col("o_custkey") % 150).alias("code_commune")
    return t.read("orders").groupBy(key).agg(*columns)


_WIDE = """select code_commune, cast(y as smallint) annee, cast(sum(case when year(o_orderdate) = y then p end) as double) med,
    cast(min(case when year(o_orderdate) = y then p end) as double) d1, cast(max(case when year(o_orderdate) = y then p end) as double) d9
    from (select lpad(cast(o_custkey % 150 as varchar), 5, '0') code_commune, o_orderdate, cast(o_totalprice as decimal(14,2)) p from orders),
    (select distinct year(o_orderdate) y from orders) group by 1, 2"""


@query("sch05_find_any_keyword_and_year", f"select code_commune, annee, med, d1 from ({_WIDE})")
def sch05(t):
    """The columns that hold a keyword and a year, for every year of the orders."""
    years = order_years(t)
    raw = wide_income(t, years)

    def one(year):
        m = h.find_any_keyword(raw.columns, ["D5", "MED", "MEDI"], str(year))
        d = h.find_any_keyword(raw.columns, ["D1"], str(year))
        found = [decimal_comma(h.quoted(m)).alias("med"), decimal_comma(h.quoted(d)).alias("d1")]
        return raw.select("code_commune", F.lit(year).cast("smallint").alias("annee"), *found)

    return union_all(*[one(y) for y in years])


@query("sch06_find_key_column", with_views("select cast(k as varchar) code, count(*) n from v_income_raw group by 1"))
def sch06(t):
    raw = t.bronze_income()
    key = h.find_key_column(raw.columns)
    assert key in h.geographic_columns(raw.columns)
    return raw.groupBy(h.quoted(key).alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "sch07_fixed_mapping",
    with_views(
        """select code_commune, cast(nscol15p as double) nscol15p, cast(sans_diplome as double) sans_diplome,
        null::double bepc_brevet, null::double cap_bep, null::double bac, cast(sup_bac2 as double) sup_bac2,
        cast(sup_bac34 as double) sup_bac34, null::double sup_bac5 from v_dipl"""
    ),
)
def sch07(t):
    raw = t.bronze_diplomas().withColumn("code_commune", commune_code("CODGEO"))
    return h.map_columns(raw, silver.DIPLOMA_COLUMNS, to_number, keep=["code_commune"])


@query(
    "sch08_prefix_columns",
    with_views("select code_commune, cast(pop as double) population from v_typo"),
)
def sch08(t):
    raw = t.bronze_population()
    bands = h.columns_with_prefix(raw, silver.POPULATION_PREFIX)
    total = sum_ignoring_nulls(*[to_number(b) for b in bands])
    return raw.select(commune_code("CODGEO").alias("code_commune"), total.alias("population"))


@query(
    "sch09_wide_to_long",
    f"""select code_commune, annee, med mediane_revenu_disp, d1 q1_revenu_disp, d9 q9_revenu_disp, null::double gini,
    null::double taux_pauvrete, null::double mediane_revenu_dec
    from ({_WIDE})""",
)
def sch09(t):
    return h.wide_to_long(wide_income(t, order_years(t)), ["code_commune"])


@query(
    "sch10_typed_schema",
    with_views(
        "select code_commune, cast(2000 as smallint) annee, "
        + ", ".join(
            f"cast({c} as decimal(12,4)) {c}"
            for c in ("nscol15p", "sans_diplome", "sup_bac2", "sup_bac34")
        )
        + ", "
        + ", ".join(f"cast(null as decimal(12,4)) {c}" for c in ("bepc_brevet", "cap_bep", "bac", "sup_bac5"))
        + " from v_dipl"
    ),
)
def sch10(t):
    return h.enforce_schema(sch07(t).withColumn("annee", F.lit(SNAPSHOT)), table_schema("diplomes"))


@query(
    "sch11_constant_columns",
    "select s_suppkey, cast(2022 as int) annee, 'RandomForest' modele, true charge from supplier",
)
def sch11(t):
    df = h.with_constants(t.read("supplier").select("s_suppkey"), "created_at", annee=2022, modele="RandomForest")
    return df.withColumn("charge", F.col("created_at").isNotNull()).drop("created_at")


@query("sch12_rename_drop", "select s_suppkey fournisseur, s_name nom, s_nationkey from supplier")
def sch12(t):
    return h.rename_drop(t.read("supplier"), {"s_suppkey": "fournisseur", "s_name": "nom"}, ["s_acctbal"])


@query(
    "set02_concat_years",
    f"""select code_commune, annee, med, d1, d9 from ({_WIDE})""",
)
def set02(t):
    years = order_years(t)
    raw = wide_income(t, years)

    def one(year):
        return raw.select(
            "code_commune", F.lit(year).cast("smallint").alias("annee"),
            *[decimal_comma(h.quoted(f"REV {m} {year}")).alias(n) for m, n in (("D5", "med"), ("D1", "d1"), ("D9", "d9"))],
        )

    return union_all(*[one(y) for y in years])
