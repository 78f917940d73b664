"""SQL counterparts: shared views as common table expressions over the test tables."""

from __future__ import annotations

import re

MAIN = ["gauche", "centre", "droite", "extremedroite"]
FIVE = MAIN + ["divers"]
JOBS = ["agriculteurs", "artisans", "cadres", "prof_interm", "employes", "ouvriers"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def dec(x: str, p: int, s: int) -> str:
    """Decimal of the shortest text of a double, halves away from zero."""
    return f"cast(cast({x} as varchar) as decimal({p},{s}))"


def half_even(x: str, digits: int) -> str:
    """Half-even rounding of the shortest text of a double."""
    v = f"({dec(x, 30, 14)} * {10 ** digits})"
    tie = f"abs({v} - floor({v})) = 0.5"
    whole = f"case when {tie} then 2 * round(cast({v} as double) / 2) else floor({v} + 0.5) end"
    step = "1" if digits == 0 else "0." + "0" * (digits - 1) + "1"
    return f"(cast({whole} as bigint) * {step})"


def med(x: str) -> str:
    """Mean of the two middle values."""
    values = f"list_sort(list({x}) filter (where {x} is not null))"
    return f"(({values})[(count({x}) + 1) // 2] + ({values})[count({x}) // 2 + 1]) * 0.5::double"


def mean(x: str) -> str:
    return f"cast(sum({x}) as double) / nullif(count({x}), 0)"


def arg_max(columns: list[str], labels: list[str]) -> str:
    out = "case"
    for i, (c, label) in enumerate(zip(columns, labels)):
        rest = [f"{c} >= {o}" for o in columns[i + 1:]]
        out += f" when {' and '.join(rest)} then '{label}'" if rest else f" else '{label}'"
    return out + " end"


LABELS4 = ["Gauche", "Centre", "Droite", "ExtremeDroite"]
LINES = "orders join lineitem on o_orderkey = l_orderkey"
_CODE = "lpad(cast({k} as varchar), 5, '0')"
IMPUTED = [
    "nb_naissances", "nb_deces", "solde_naturel", "mediane_revenu_disp", "gini", "taux_pauvrete",
    "cadres_pct", "ouvriers_pct", "employes_pct", "artisans_pct", "pct_bac_plus", "pct_sans_diplome",
]


def poverty(m: str, g: str, n: str) -> str:
    t = f"({n}*0.6::double)"
    usual = f"(-5.0::double + ({g} - 0.20::double)*100.0::double)"
    usual = (
        f"case when {m}/{n} < 0.75::double then {usual}*1.4::double"
        f" when {m}/{n} > 1.25::double then {usual}*0.6::double else {usual} end"
    )
    one = f"greatest(0.0::double, least(50.0::double, case when {m} < {t} then 35.0::double + ({g} - 0.25::double)*80.0::double else {usual} end))"
    low = f"({t}*0.80::double)"
    return (
        f"case when {m} is null then null when {g} is not null then {one}"
        f" when {m} < {low} then 40.0::double"
        f" when {m} < {t} then 40.0::double + ({m} - {low})/({t} - {low})*(-15.0::double)"
        f" when {m} < {n}*0.9::double then 15.0::double when {m} < {n}*1.1::double then 10.0::double"
        f" when {m} < {n}*1.3::double then 6.0::double else 3.0::double end"
    )


VIEWS = {
    "v_ref": f"""select {_CODE.format(k='k')} code_commune, concat('Commune ', k) libelle, lpad(cast(k % 10 as varchar), 2, '0') code_dep, k,
        case k % 4 when 0 then 'COM' when 1 then 'ARM' when 2 then 'COMA' end typecom from (select distinct c_custkey % 150 k from customer)""",
    "v_known": "select code_commune from v_ref where typecom is null or typecom in ('COM', 'COMD', 'ARM')",
    "v_elections": f"""select {_CODE.format(k='o_custkey % 150')} code_commune, o_custkey % 150 k,
        concat(year(o_orderdate), '_', case o_orderstatus when 'F' then 'pres' when 'O' then 'legi' else 'muni' end, '_t', l_linenumber % 2 + 1) id_election,
        case o_orderpriority when '1-URGENT' then 'SOC' when '2-HIGH' then 'REM' when '3-MEDIUM' then 'LR' when '5-LOW' then 'RN' end nuance,
        case when o_orderpriority = '4-NOT SPECIFIED' then case l_returnflag when 'R' then 'MACRON' when 'A' then 'Le Pen ' else 'INCONNU' end end nom,
        cast(l_quantity as bigint) voix, cast(l_tax as decimal(8,2)) r_ins, cast(l_discount as decimal(8,2)) r_exp,
        o_orderkey, l_linenumber
        from {LINES}""",
    "v_votes": """select code_commune, cast(substring(id_election, 1, 4) as smallint) annee,
        coalesce(case nuance when 'SOC' then 'Gauche' when 'REM' then 'Centre' when 'LR' then 'Droite' when 'RN' then 'ExtremeDroite' end,
                 case upper(trim(nom)) when 'MACRON' then 'Centre' when 'LE PEN' then 'ExtremeDroite' end, 'Divers') bloc, voix
        from v_elections where id_election like '%pres_t1'""",
    "v_sums": "select code_commune, annee, cast(sum(voix) as bigint) tot, "
    + ", ".join(
        f"cast(sum(case when bloc = '{b}' then voix else 0 end) as bigint) n_{b.lower()}"
        for b in LABELS4 + ["Divers"]
    )
    + " from v_votes group by 1, 2",
    "v_results": "select code_commune, annee, "
    + ", ".join(f"cast(n_{b} as double)/tot*100 pct_{b}" for b in FIVE)
    + ", "
    + arg_max([f"n_{b}" for b in MAIN], LABELS4)
    + " bloc_dominant from v_sums where tot > 0",
    "v_vital_rows": f"""select {_CODE.format(k='user_id % 150')} code_commune, cast(1996 + 2 * (day(ts) % 3) as smallint) annee,
        case event_type when 'signup' then 'NAIS' else 'DECES' end mesure, count(*) n
        from events where event_type in ('signup', 'error') group by 1, 2, 3""",
    "v_births": "select code_commune, annee, cast(n as int) nb_naissances from v_vital_rows where mesure = 'NAIS'",
    "v_deaths": "select code_commune, annee, cast(n as int) nb_deces from v_vital_rows where mesure = 'DECES'",
    "v_vital": """select code_commune, annee, nb_naissances, nb_deces,
        coalesce(nb_naissances, 0) - coalesce(nb_deces, 0) solde_naturel
        from v_births full join v_deaths using (code_commune, annee)""",
    "v_income_raw": f"""select k, {_CODE.format(k='k')} code_commune,
        case when k % 10 = 3 or k % 11 = 0 then null else {dec('4*m', 12, 2)} end mediane,
        case when k % 7 = 0 then cast(20 + k % 30 as decimal(6,0)) * 0.01 end gini
        from (select c_custkey % 150 k, {med('c_acctbal')} m from customer group by 1)""",
    "v_national": f"select {med('cast(mediane as double)')} n from v_income_raw",
    "v_rates": f"""select k, code_commune, cast(mediane as double) m, cast(gini as double) g, n,
        {poverty('cast(mediane as double)', 'cast(gini as double)', 'n')} taux
        from v_income_raw, v_national""",
    "v_income": f"""select code_commune, cast(2000 as smallint) annee, cast(m as decimal(10,2)) mediane_revenu_disp,
        cast(g as decimal(6,4)) gini, cast({half_even('taux', 1)} as decimal(6,3)) taux_pauvrete from v_rates""",
    "v_csp": f"select {_CODE.format(k='o_custkey % 150')} code_commune, "
    + ", ".join(
        f"sum(case when p_type = '{t}' then cast(l_quantity as bigint) end) {j}_emploi, "
        f"count(case when p_type = '{t}' and l_returnflag = 'R' then 1 end) {j}_chomeurs"
        for j, t in zip(JOBS, TYPES)
    )
    + f" from {LINES} join part on l_partkey = p_partkey group by 1",
    "v_csp_total": "select *, cast(" + " + ".join(f"coalesce({j}_emploi, 0)" for j in JOBS) + " as double) total from v_csp",
    "v_csp_pct": "select code_commune, "
    + ", ".join(
        f"case when total > 0 then cast({half_even(f'cast({j}_emploi as double)/total*100', 3)} as decimal(6,3)) end {j}_pct"
        for j in ("cadres", "ouvriers", "employes", "artisans")
    )
    + " from v_csp_total",
    "v_dipl": f"""select {_CODE.format(k='d.doc_id % 150')} code_commune, count(quality) nscol15p,
        count(case when quality = 0 then 1 end) sans_diplome,
        nullif(count(case when quality = 1 and toxic = 0 then 1 end), 0) sup_bac2,
        nullif(count(case when toxic = 1 then 1 end), 0) sup_bac34
        from documents d left join labels l on d.doc_id = l.doc_id group by 1""",
    "v_dipl_pct": f"""select code_commune,
        case when nscol15p > 0 then cast({half_even('cast(coalesce(sup_bac2, 0) + coalesce(sup_bac34, 0) as double)/nscol15p*100', 3)} as decimal(6,3)) end pct_bac_plus,
        case when nscol15p > 0 then cast({half_even('cast(sans_diplome as double)/nscol15p*100', 3)} as decimal(6,3)) end pct_sans_diplome
        from v_dipl""",
    "v_pop": f"""select {_CODE.format(k='o_custkey % 150')} code_commune,
        nullif(count(case when l_linenumber between 1 and 2 then 1 end), 0) p1,
        nullif(count(case when l_linenumber between 3 and 4 then 1 end), 0) p2,
        nullif(count(case when l_linenumber >= 5 then 1 end), 0) p3
        from {LINES} group by 1""",
    "v_typo": """select code_commune, pop, case when pop >= 420 then 'urbain' when pop >= 380 then 'periurbain' else 'rural' end typologie_territoire
        from (select code_commune, coalesce(p1, 0) + coalesce(p2, 0) + coalesce(p3, 0) pop from v_pop)""",
    "v_near": """select y annee, (select fy from (select distinct annee fy from v_vital) order by abs(fy - y), fy limit 1) fy
        from (select distinct annee y from v_results)""",
    "v_joined": """select r.*, e.libelle, e.code_dep, nb_naissances, nb_deces, solde_naturel,
        mediane_revenu_disp, gini, taux_pauvrete
        from v_results r left join v_ref e using (code_commune)
        left join v_near n on n.annee = r.annee
        left join v_vital v on v.code_commune = r.code_commune and v.annee = n.fy
        left join v_income i on i.code_commune = r.code_commune""",
    "v_gold0": """select j.*, cadres_pct, ouvriers_pct, employes_pct, artisans_pct, pct_bac_plus, pct_sans_diplome,
        coalesce(typologie_territoire, 'rural') typologie_territoire
        from v_joined j left join v_csp_pct using (code_commune) left join v_dipl_pct using (code_commune)
        left join v_typo using (code_commune)""",
    "v_dep_medians": "select code_dep, "
    + ", ".join(f"{med(f'cast({c} as double)')} {c}" for c in IMPUTED)
    + " from v_gold0 where code_dep is not null group by 1",
    "v_gold1": "select g.* replace ("
    + ", ".join(f"coalesce(cast(g.{c} as double), m.{c}) as {c}" for c in IMPUTED)
    + ") from v_gold0 g left join v_dep_medians m using (code_dep)",
    "v_nat_medians": "select " + ", ".join(f"{med(c)} {c}" for c in IMPUTED) + " from v_gold1",
    "v_gold2": "select g.* replace ("
    + ", ".join(f"coalesce(g.{c}, m.{c}) as {c}" for c in IMPUTED)
    + ") from v_gold1 g, v_nat_medians m",
    "v_gold": "select code_commune, libelle, code_dep, annee, "
    + ", ".join(f"{dec(f'pct_{b}', 6, 3)} pct_{b}" for b in FIVE)
    + ", bloc_dominant, "
    + ", ".join(
        f"{dec(c, 6, 3)} {c}"
        for c in ("cadres_pct", "ouvriers_pct", "employes_pct", "artisans_pct", "pct_bac_plus", "pct_sans_diplome")
    )
    + ", "
    + ", ".join(f"cast(round({c}) as int) {c}" for c in ("nb_naissances", "nb_deces", "solde_naturel"))
    + f", {dec('mediane_revenu_disp', 10, 2)} mediane_revenu_disp, {dec('gini', 6, 4)} gini"
    + f", {dec('taux_pauvrete', 6, 3)} taux_pauvrete, typologie_territoire from v_gold2",
    "v_future": "select 2004 y union all select 2005 union all select 2006",
    "v_scen": "select a.code_commune, a.libelle, a.code_dep, a.typologie_territoire, y, (y - 2001)/5.0::double f, "
    + ", ".join(
        f"cast(a.pct_{b} as double) pct_{b}_lag1, "
        f"case when b.code_commune is null then 0.0::double else cast(a.pct_{b} as double) - cast(b.pct_{b} as double) end d_{b}"
        for b in MAIN
    )
    + ", "
    + ", ".join(
        f"cast(a.{c} as double) {c}, case when b.code_commune is null then 0.0::double else cast(a.{c} as double) - cast(b.{c} as double) end d_{c}"
        for c in ("nb_naissances", "nb_deces", "solde_naturel")
    )
    + " from v_gold a left join v_gold b on a.code_commune = b.code_commune and b.annee = 1996, v_future where a.annee = 2001",
    "v_expected": "select *, " + ", ".join(f"pct_{b}_lag1 + d_{b}*f e_{b}" for b in MAIN) + " from v_scen",
    "v_pred": "select code_commune, libelle, code_dep, cast(y as smallint) annee, "
    + arg_max([f"e_{b}" for b in MAIN], LABELS4)
    + " bloc_predit, "
    + ", ".join(f"{dec(f'(e_{b}/100)', 6, 4)} prob_{b}" for b in MAIN)
    + ", typologie_territoire from v_expected",
    "v_rows": "select *, "
    + ", ".join(f"lag(pct_{b}) over w pct_{b}_lag1" for b in MAIN)
    + ", lag(bloc_dominant) over w bloc_lag1, lag(annee) over w annee_lag1"
    + " from v_gold window w as (partition by code_commune order by annee)",
}


def with_views(body: str) -> str:
    """``body`` preceded by the views it uses, directly or through others."""
    needed: list[str] = []

    def visit(text: str):
        for name in re.findall(r"\bv_[a-z0-9_]+\b", text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{n} as materialized ({VIEWS[n]})" for n in needed)
    return f"with {ctes}\n{body}"
