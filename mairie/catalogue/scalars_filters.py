"""SCL and FLT queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mairie.catalogue.adapters import DEPARTMENTS
from mairie.catalogue.registry import query
from mairie.catalogue.sql import LABELS4, MAIN, arg_max, dec, half_even, with_views
from mairie.functions import codes, mappings, numbers, poverty, territory
from mairie.operators import selection as s
from mairie.operators.aggregates import count_by, overall_median
from mairie.plans import gold, silver

# ---- identifiers


@query(
    "scl01_zfill",
    """select c_custkey, case when length(k) < 5 then lpad(k, 5, '0') else k end code5, c_name nom5
    from (select c_custkey, cast(c_custkey as varchar) k, c_name from customer)""",
)
def scl01(t):
    return t.read("customer").select(
        "c_custkey", codes.zfill(F.col("c_custkey").cast("string"), 5).alias("code5"), codes.zfill("c_name", 5).alias("nom5")
    )


_RAW_DEP = "case c_custkey % 4 when 0 then cast(c_nationkey as varchar) when 1 then lpad(cast(c_nationkey as varchar), 3, '0') when 2 then concat(' ', c_nationkey, ' ') else '2a' end"
_Z2 = "case when length({0}) < 2 then lpad({0}, 2, '0') else {0} end"


@query(
    "scl02_department_code",
    f"""select c_custkey, case when regexp_matches(u, '^[0-9]+$') then {_Z2.format('u')} else u end national, {_Z2.format('z')} pilote
    from (select c_custkey, upper(trim(raw)) u, ltrim(trim(raw), '0') z from (select c_custkey, {_RAW_DEP} raw from customer))""",
)
def scl02(t):
    nation = F.col("c_nationkey").cast("string")
    turn = F.col("c_custkey") % 4
    raw = (
        F.when(turn == 0, nation).when(turn == 1, F.lpad(nation, 3, "0"))
        .when(turn == 2, F.concat(F.lit(" "), nation, F.lit(" "))).otherwise("2a")
    )
    df = t.read("customer").select("c_custkey", raw.alias("raw"))
    return df.select(
        "c_custkey", codes.department_code("raw").alias("national"), codes.department_code("raw", "pilot").alias("pilote")
    )


@query(
    "scl03_composite_code",
    """select c_custkey, concat(lpad(upper(trim(dr)), 2, '0'), case when length(cr) < 3 then lpad(cr, 3, '0') else cr end) code
    from (select c_custkey, case when c_nationkey = 7 then ' 2a' else cast(c_nationkey as varchar) end dr, cast(c_custkey % 150 as varchar) cr from customer)""",
)
def scl03(t):
    dr = F.when(F.col("c_nationkey") == 7, " 2a").otherwise(F.col("c_nationkey").cast("string"))
    cr = (F.col("c_custkey") % 150).cast("string")
    return t.read("customer").select("c_custkey", codes.composite_code(dr, cr).alias("code"))


_IDS = """with ids as (select concat(year(o_orderdate), '_', lower(o_orderpriority), '_t', o_custkey % 3) id from orders
    union all select o_orderpriority from orders)"""


def identifiers(t):
    """Election-like identifiers, some without a year, a type or a round."""
    orders = t.read("orders")
    full = F.concat(
        F.year("o_orderdate").cast("string"), F.lit("_"), F.lower("o_orderpriority"), F.lit("_t"),
        (F.col("o_custkey") % 3).cast("string"),
    )
    return orders.select(full.alias("id")).unionAll(orders.select("o_orderpriority"))


@query("scl04_election_year", _IDS + " select id, try_cast(nullif(regexp_extract(id, '[0-9]{4}'), '') as smallint) annee, count(*) n from ids group by 1")
def scl04(t):
    return identifiers(t).groupBy("id", codes.election_year("id").alias("annee")).agg(F.count(F.lit(1)).alias("n"))


@query("scl05_election_type", _IDS + " select id, case when contains(id, '_') then split_part(id, '_', 2) end type_election, count(*) n from ids group by 1, 2")
def scl05(t):
    return identifiers(t).groupBy("id", codes.election_type("id").alias("type_election")).agg(F.count(F.lit(1)).alias("n"))


@query("scl06_election_round", _IDS + " select id, try_cast(nullif(regexp_extract(id, 't([0-9])', 1), '') as smallint) tour, count(*) n from ids group by 1, 2")
def scl06(t):
    return identifiers(t).groupBy("id", codes.election_round("id").alias("tour")).agg(F.count(F.lit(1)).alias("n"))


_TEXT_NUMBER = "case o_orderstatus when 'P' then concat(o_custkey, 'd') when 'O' then concat(' ', cast(o_totalprice as decimal(12,2))) else replace(cast(cast(o_totalprice as decimal(12,2)) as varchar), '.', ',') end"


def text_numbers(t):
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    text = (
        F.when(F.col("o_orderstatus") == "P", F.concat(F.col("o_custkey").cast("string"), F.lit("d")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit(" "), price))
        .otherwise(F.replace(price, F.lit("."), F.lit(",")))
    )
    return t.read("orders").select("o_orderkey", text.alias("texte"))


@query("scl07_to_number", f"select o_orderkey, case when o_orderstatus = 'O' then try_cast(trim({_TEXT_NUMBER}) as double) end valeur from orders")
def scl07(t):
    return text_numbers(t).select("o_orderkey", numbers.to_number("texte").alias("valeur"))


@query("scl08_decimal_comma", f"select o_orderkey, case when o_orderstatus <> 'P' then try_cast(replace(trim({_TEXT_NUMBER}), ',', '.') as double) end valeur from orders")
def scl08(t):
    return text_numbers(t).select("o_orderkey", numbers.decimal_comma("texte").alias("valeur"))


@query("scl09_department_prefix", with_views("select substring(code_commune, 1, 2) code_dep, count(*) n from v_elections group by 1"))
def scl09(t):
    return count_by(t.elections().withColumn("code_dep", codes.department_of("code_commune")), ["code_dep"])


@query("scl10_upper_trim", with_views("select upper(trim(nom)) nom, count(*) n from v_elections group by 1"))
def scl10(t):
    return t.bronze_elections().groupBy(codes.upper_trim("nom").alias("nom")).agg(F.count(F.lit(1)).alias("n"))


# ---- arithmetic


@query("scl11_null_safe_sum", with_views("select code_commune, cast(total as decimal(17,4)) total_emploi from v_csp_total"))
def scl11(t):
    total = numbers.sum_ignoring_nulls(*[f"{o}_emploi" for o in silver.OCCUPATIONS])
    return t.occupations().select("code_commune", total.cast("decimal(17,4)").alias("total_emploi"))


@query("scl12_row_sum", with_views("select code_commune, cast(pop as double) population_totale from v_typo"))
def scl12(t):
    return t.typology().select("code_commune", "population_totale")


@query(
    "scl13_guarded_percentage",
    with_views(
        """select code_commune, case when nscol15p > 0 then cast(sans_diplome as double)/nscol15p*100 end pct_sans_diplome,
        case when nscol15p > 0 then cast(coalesce(sup_bac2, 0) + coalesce(sup_bac34, 0) as double)/nscol15p*100 end pct_bac_plus from v_dipl"""
    ),
)
def scl13(t):
    return gold.diploma_shares(t.diplomas(), 2000, digits=None)


@query("scl14_territory_type", with_views("select code_commune, typologie_territoire from v_typo"))
def scl14(t):
    return t.typology().select("code_commune", "typologie_territoire")


@query(
    "scl15_territory_density",
    with_views(
        """select code_commune, case when d >= 150 then 'urbain' when d >= 80 then 'periurbain' else 'rural' end typologie_territoire
        from (select code_commune, cast(pop as double) / (cast(code_commune as int) % 7 + 1) d from v_typo)"""
    ),
)
def scl15(t):
    area = F.col("code_commune").cast("int") % 7 + 1
    kind = territory.territory_type(F.col("population_totale") / area, "density", (80, 150))
    return t.typology().select("code_commune", kind.alias("typologie_territoire"))


@query("scl16_poverty_rate", with_views("select code_commune, taux from v_rates"))
def scl16(t):
    df = t.income()
    rate = poverty.poverty_rate("mediane_revenu_disp", "gini", overall_median(df, "mediane_revenu_disp"))
    return df.select("code_commune", rate.alias("taux"))


@query("scl17_clamp", "select c_custkey, greatest(0.0::double, least(50.0::double, c_acctbal)) v from customer")
def scl17(t):
    return t.read("customer").select("c_custkey", numbers.clamp("c_acctbal", 0.0, 50.0).alias("v"))


@query(
    "scl18_interpolate",
    "select c_custkey, 40.0::double + (c_acctbal - 8000.0::double) / (10000.0::double - 8000.0::double) * -15.0::double v from customer",
)
def scl18(t):
    return t.read("customer").select("c_custkey", numbers.interpolate("c_acctbal", 8000, 10000, 40, 25).alias("v"))


@query(
    "scl19_round_half_even",
    f"select c_custkey, cast({half_even('c_acctbal', 1)} as decimal(10,1)) v from customer",
)
def scl19(t):
    return t.read("customer").select("c_custkey", numbers.round_half_even("c_acctbal", 1).cast("decimal(10,1)").alias("v"))


# ---- blocs

_NUANCE = "case nuance when 'SOC' then 'Gauche' when 'REM' then 'Centre' when 'LR' then 'Droite' when 'RN' then 'ExtremeDroite' end"
_NAME = "case upper(trim(nom)) when 'MACRON' then 'Centre' when 'LE PEN' then 'ExtremeDroite' end"


@query("scl20_code_map", with_views(f"select nuance, {_NUANCE} bloc, count(*) n from v_elections group by 1, 2"))
def scl20(t):
    bloc = mappings.map_codes("nuance", mappings.nuance_table())
    return t.bronze_elections().groupBy("nuance", bloc.alias("bloc")).agg(F.count(F.lit(1)).alias("n"))


@query("scl21_fallback_map", with_views(f"select nuance, nom, coalesce({_NUANCE}, {_NAME}) bloc, count(*) n from v_elections group by 1, 2, 3"))
def scl21(t):
    by_name = mappings.map_codes(codes.upper_trim("nom"), dict(mappings.CANDIDATES))
    bloc = F.coalesce(mappings.map_codes("nuance", mappings.nuance_table()), by_name)
    return t.bronze_elections().groupBy("nuance", "nom", bloc.alias("bloc")).agg(F.count(F.lit(1)).alias("n"))


_RULES = "case " + " ".join(
    f"when contains(x, upper('{k}')) or contains(upper('{k}'), x) then '{b}'" for k, b in mappings.CANDIDATES
) + " end"


_TITLED = """(select unnest([n, concat('MR ', n), split_part(n, ' ', 1)]) x from (select upper(trim(nom)) n from v_elections where nom is not null)
    union all select null from v_elections, generate_series(1, 3) where nom is null)"""


@query("scl22_contains_fallback", with_views(f"select x, {_RULES} bloc, count(*) n from {_TITLED} group by 1, 2"))
def scl22(t):
    nom = codes.upper_trim("nom")
    prefixed = F.when(nom.isNotNull(), F.concat(F.lit("MR "), nom))
    names = t.bronze_elections().select(F.explode(F.array(nom, prefixed, F.substring_index(nom, " ", 1))).alias("x"))
    return names.groupBy("x", mappings.contains_rule("x").alias("bloc")).agg(F.count(F.lit(1)).alias("n"))


@query("scl23_default_label", with_views(f"select coalesce({_NUANCE}, {_NAME}, 'Divers') bloc, count(*) n, cast(sum(voix) as bigint) voix from v_elections group by 1"))
def scl23(t):
    bloc = mappings.bloc_of("nuance_liste", "nom_candidat").alias("bloc")
    return t.elections().groupBy(bloc).agg(F.count(F.lit(1)).alias("n"), F.sum("nb_voix").alias("voix"))


@query("scl24_arg_max_label", with_views(f"select code_commune, annee, {arg_max([f'n_{b}' for b in MAIN], LABELS4)} bloc_dominant from v_sums where tot > 0"))
def scl24(t):
    return t.results().select("code_commune", "annee", "bloc_dominant")


@query("scl25_territory_rank", with_views("select code_commune, case typologie_territoire when 'urbain' then 2 when 'periurbain' then 1 else 0 end typo_ord from v_typo"))
def scl25(t):
    return t.typology().select("code_commune", territory.territory_rank("typologie_territoire").alias("typo_ord"))


@query(
    "scl26_department_name",
    """select c_custkey, case c_nationkey when 5 then 'Paris' when 22 then 'Hauts-de-Seine' when 23 then 'Seine-Saint-Denis'
    when 24 then 'Val-de-Marne' else lpad(cast(70 + c_nationkey as varchar), 3, '0') end nom from customer""",
)
def scl26(t):
    code = F.lpad((70 + F.col("c_nationkey")).cast("string"), 3, "0")
    return t.read("customer").select("c_custkey", codes.department_name(code).alias("nom"))


@query(
    "scl27_bin_label",
    with_views(
        """select case when taux > 0 and taux <= 5 then '<5%' when taux > 5 and taux <= 10 then '5-10%' when taux > 10 and taux <= 15 then '10-15%'
        when taux > 15 and taux <= 20 then '15-20%' when taux > 20 and taux <= 30 then '20-30%' when taux > 30 and taux <= 50 then '>30%' end tranche,
        count(*) n from v_rates where taux is not null group by 1"""
    ),
)
def scl27(t):
    df = s.drop_nulls(scl16(t), "taux")
    label = numbers.bin_label("taux", poverty.RATE_BINS, poverty.RATE_BIN_LABELS)
    return df.groupBy(label.alias("tranche")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "scl28_like_pattern",
    """select id, count(*) n from (select concat(case o_orderstatus when 'F' then 'PR' else 'LG' end, year(o_orderdate), 'T', o_custkey % 2 + 1) id from orders)
    where id like 'PR%T1' group by 1""",
)
def scl28(t):
    kind = F.when(F.col("o_orderstatus") == "F", "PR").otherwise("LG")
    tour = (F.col("o_custkey") % 2 + 1).cast("string")
    ids = t.read("orders").select(F.concat(kind, F.year("o_orderdate").cast("string"), F.lit("T"), tour).alias("id"))
    return count_by(ids.where(codes.is_presidential_first_round_id("id")), ["id"])


@query(
    "scl29_report_rounding",
    f"select c_custkey, cast(round({dec('c_acctbal', 28, 10)}, 1) as decimal(20,1)) v from customer",
)
def scl29(t):
    return t.read("customer").select("c_custkey", numbers.round_half_up("c_acctbal", 1).cast("decimal(20,1)").alias("v"))


# ---- row selection


@query("flt01_in_list", with_views("select code_commune, libelle, code_dep from v_ref where code_dep in ('01', '03', '05')"))
def flt01(t):
    df = s.keep_in(t.referential(), "code_dep", ["01", "03", "05"])
    return df.select(F.col("code_insee").alias("code_commune"), "libelle", "code_dep")


@query("flt02_semi_filter", with_views("select code_commune, count(*) n from v_elections where code_commune in (select code_commune from v_known) group by 1"))
def flt02(t):
    known = silver.referential(t.bronze_referential(), DEPARTMENTS)
    return count_by(s.semi_filter(t.elections(), known, "code_commune", "code_insee"), ["code_commune"])


@query(
    "flt03_metropolitan_range",
    """select code, count(*) n from (select concat(case when c_nationkey = 3 then '2A' when c_nationkey = 4 then '2B' else lpad(cast((c_nationkey * 5) % 100 as varchar), 2, '0') end, lpad(cast(c_custkey % 150 as varchar), 3, '0')) code from customer)
    where ((substring(code, 1, 2) between '01' and '95') or substring(code, 1, 2) in ('2A', '2B')) and substring(code, 1, 2) not in ('97', '98', '99') group by 1""",
)
def flt03(t):
    n = F.col("c_nationkey")
    prefix = F.when(n == 3, "2A").when(n == 4, "2B").otherwise(F.lpad(((n * 5) % 100).cast("string"), 2, "0"))
    code = F.concat(prefix, F.lpad((F.col("c_custkey") % 150).cast("string"), 3, "0"))
    df = t.read("customer").select(code.alias("code"))
    return count_by(df.where(s.is_metropolitan("code")), ["code"])


@query("flt04_member_or_null", with_views("select cast(k as varchar) code from v_ref where code_commune in (select code_commune from v_known)"))
def flt04(t):
    return t.bronze_referential().where(s.member_or_null("TYPECOM")).select(F.col("COM").alias("code"))


@query("flt05_prefer_measure", with_views("select code_commune, cast(annee as varchar) annee, mesure, cast(n as varchar) n from v_vital_rows where mesure = 'NAIS'"))
def flt05(t):
    kept = s.prefer_measure(t.bronze_vital(), "EC_MEASURE", s.PILOT_BIRTH_MEASURES)
    return kept.select(
        codes.commune_code("GEO").alias("code_commune"), F.col("TIME_PERIOD").alias("annee"),
        F.col("EC_MEASURE").alias("mesure"), F.col("OBS_VALUE").alias("n"),
    )


@query("flt06_first_round", with_views("select cast(substring(id_election, 1, 4) as smallint) annee, count(*) n, cast(sum(voix) as bigint) voix from v_elections where id_election like '%pres_t1' and voix is not null group by 1"))
def flt06(t):
    rows = s.first_round_presidential(t.elections())
    return rows.groupBy("annee").agg(F.count(F.lit(1)).alias("n"), F.sum("nb_voix").alias("voix"))


@query("flt07_temporal_split", with_views("select case when annee <= 1999 then 'train' else 'test' end jeu, annee, count(*) n from v_rows where bloc_lag1 is not null and (annee <= 1999 or annee = 2001) group by 1, 2"))
def flt07(t):
    train, test = s.temporal_split(t.model_rows(), 1999, 2001)
    return count_by(
        train.withColumn("jeu", F.lit("train")).unionByName(test.withColumn("jeu", F.lit("test"))), ["jeu", "annee"]
    )


@query("flt08_keep_first", "select user_id, event_type, event_id, value from (select *, row_number() over (partition by user_id, event_type order by event_id) r from events) where r = 1")
def flt08(t):
    df = t.read("events").select("user_id", "event_type", "event_id", "value")
    return s.keep_first(df, ["user_id", "event_type"], ["event_id"])


@query("flt09_drop_nulls", with_views("select code_commune, m, g from v_rates where m is not null and g is not null"))
def flt09(t):
    df = t.income().select(
        "code_commune", F.col("mediane_revenu_disp").cast("double").alias("m"), F.col("gini").cast("double").alias("g")
    )
    return s.drop_nulls(df, "m", "g")
