"""WIN, SRT, SET and DQ queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mairie.catalogue.adapters import BASE, FUTURE, LARGE
from mairie.catalogue.registry import query
from mairie.catalogue.sql import MAIN, mean, with_views
from mairie.operators import ordering, quality, windows
from mairie.operators.aggregates import count_by
from mairie.operators.selection import keep_first
from mairie.session import new_path
from mairie.sources import published, tables
from mairie.sources.schemas import KEYS, LAYERS, REQUIRED

_LAGS = ", ".join(f"pct_{b}_lag1" for b in MAIN)


@query("win01_previous_row", with_views(f"select code_commune, annee, {_LAGS}, bloc_lag1, annee_lag1 from v_rows"))
def win01(t):
    df = windows.lag_features(t.gold())
    return df.select("code_commune", "annee", *[f"pct_{b}_lag1" for b in MAIN], "bloc_lag1", "annee_lag1")


@query(
    "win02_difference_to_previous",
    with_views(
        "select code_commune, annee, "
        + ", ".join(f"cast(pct_{b} - pct_{b}_lag1 as decimal(7,3)) pct_{b}_trend" for b in MAIN)
        + ", cast(annee - annee_lag1 as smallint) intervalle from v_rows"
    ),
)
def win02(t):
    df = t.model_rows()
    return df.select("code_commune", "annee", *[f"pct_{b}_trend" for b in MAIN], "intervalle")


@query(
    "win03_share_of_grand_total",
    with_views("select bloc, n, cast(n as double) * 100 / cast(sum(n) over () as double) pct from (select bloc, count(*) n from v_votes group by 1)"),
)
def win03(t):
    return windows.share_of_total(count_by(t.votes(), ["bloc"]), "n")


@query(
    "win04_first_row_per_key",
    "select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) r from orders) where r = 1",
)
def win04(t):
    df = t.read("orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return keep_first(df, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("srt01_mixed_order", with_views("select code_dep, bloc_dominant, count(*) n from v_gold group by 1, 2"))
def srt01(t):
    return count_by(t.gold(), ["code_dep", "bloc_dominant"]).orderBy("code_dep", F.desc("n"), "bloc_dominant")


@query("srt02_top_groups", "select o_custkey, count(*) n from orders group by 1 order by n desc, o_custkey limit 10")
def srt02(t):
    return ordering.top_groups(t.read("orders"), "o_custkey", 10)


@query("srt03_first_rows", "select event_id, ts, user_id from events order by ts, event_id limit 5")
def srt03(t):
    return ordering.first_rows(t.read("events").select("event_id", "ts", "user_id"), 5, ["ts", "event_id"])


@query("srt04_seeded_sample", "select event_id, event_type from events order by md5(concat('42|', event_id)), event_id limit 5")
def srt04(t):
    return ordering.sample_rows(t.read("events").select("event_id", "event_type"), 5, ["event_id"])


@query(
    "set01_union_all",
    with_views(
        """select 'Reel' source, code_dep, bloc_dominant bloc, count(*) nb from v_gold where annee = 2001 and code_dep in ('01', '03', '05', '07', '09') group by 2, 3
        union all select 'Predit', code_dep, bloc_predit, count(*) from v_pred where annee = 2006 and code_dep in ('01', '03', '05', '07', '09') group by 2, 3"""
    ),
)
def set01(t):
    def part(df, year, label, bloc):
        rows = df.where((F.col("annee") == year) & F.col("code_dep").isin(LARGE))
        return count_by(rows.select(F.lit(label).alias("source"), "code_dep", F.col(bloc).alias("bloc")), ["source", "code_dep", "bloc"], "nb")

    return ordering.union_all(
        part(t.gold(), BASE, "Reel", "bloc_dominant"), part(t.predictions(), FUTURE[-1], "Predit", "bloc_predit")
    )


@query(
    "dq01_duplicate_keys",
    "select 'lineitem' table_name, count(*) doublons from (select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1) union all select 'events', count(*) from (select user_id, event_type from events group by 1, 2 having count(*) > 1)",
)
def dq01(t):
    def row(df, name, keys):
        return quality.duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("doublons")).select(F.lit(name).alias("table_name"), "doublons")

    return row(t.read("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]).unionByName(
        row(t.read("events"), "events", ["user_id", "event_type"])
    )


@query("dq01_gold_keys", with_views("select code_commune, annee, count(*) n from v_gold group by 1, 2 having count(*) > 1"))
def dq01_gold(t):
    return quality.duplicate_keys(t.gold(), KEYS["features_communes"])


@query(
    "dq02_required_columns",
    with_views(
        """select 'code_commune' colonne, count(*) - count(code_commune) nuls, count(*) = count(code_commune) ok from v_pred
        union all select 'annee', count(*) - count(annee), count(*) = count(annee) from v_pred
        union all select 'bloc_predit', count(*) - count(bloc_predit), count(*) = count(bloc_predit) from v_pred"""
    ),
)
def dq02(t):
    return quality.null_violations(t.predictions(), REQUIRED["predictions"])


@query("dq03_load_check", "select 'orders' table_name, count(*) attendues, count(*) ecrites, true ok from orders")
def dq03(t):
    source = t.read("orders").select("o_orderkey", "o_orderstatus")
    return quality.load_check(source, tables.write_table(source, new_path(t.spark, "dq03")), "orders")


@query(
    "dq04_coverage_check",
    with_views(
        f"""select 'taux_pauvrete' colonne, count(*) total, count(taux_pauvrete) non_null,
        cast(count(taux_pauvrete) as double) / count(*) * 100 >= 90 couverture_ok, {mean('taux_pauvrete')} moyenne,
        {mean('taux_pauvrete')} between 12 and 16 moyenne_ok from v_income"""
    ),
)
def dq04(t):
    return quality.coverage_check(t.income(), "taux_pauvrete", 90, (12, 16))


@query(
    "dq05_table_counts",
    with_views(
        """select 'silver' couche, 'naissances' table_name, count(*) n from v_births union all select 'silver', 'deces', count(*) from v_deaths
        union all select 'silver', 'revenus', count(*) from v_income union all select 'silver', 'elections', count(*) from v_elections
        union all select 'gold', 'features_communes', count(*) from v_gold union all select 'gold', 'predictions', count(*) from v_pred"""
    ),
)
def dq05(t):
    """The tables are published below one folder and listed from there, without a scan."""
    out = new_path(t.spark, "dq05")
    built = {
        "naissances": t.births(), "deces": t.deaths(), "revenus": t.income(), "elections": t.elections(),
        "features_communes": t.gold(), "predictions": t.predictions(),
    }
    for name, df in built.items():
        published.refresh(df, f"{out}/{LAYERS[name]}/{name}", keys=KEYS.get(name, ()))
    return published.listed(t.spark, out, ["silver", "gold"])
