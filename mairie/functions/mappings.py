"""Political blocs: lookup tables and the columns built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mairie.functions.codes import _col, upper_trim

# Bloc names.  The four main blocs are in tie-break order.
MAIN_BLOCS = ["Gauche", "Centre", "Droite", "ExtremeDroite"]
OTHER_BLOC = "Divers"
BLOCS = MAIN_BLOCS + [OTHER_BLOC]

# Nuance codes of each bloc, national table.
NUANCES = {
    "Gauche": [
        "EXG", "LEXG", "LXG", "DXG", "COM", "LCOM", "SOC", "LSOC", "DVG", "LDVG", "FG", "LFG",
        "NUP", "LFI", "FI", "ECO", "LECO", "VEC", "LVEC", "LCR", "LO", "PG", "LPG",
        "BC-EXG", "BC-DVG", "BC-FG", "BC-SOC", "BC-FI", "BC-COM", "BC-VEC", "BC-ECO", "BC-PG",
        "BC-UCG", "GAU", "PREP", "MELE", "HOLL", "ROYA", "BUFF", "VOYN", "BESA", "ARTH", "POUT",
        "GLUC", "HUE", "JOSP", "BOVE", "TAUB", "JOLY", "MAME",
    ],
    "Centre": [
        "ENS", "REM", "LREM", "BC-REM", "BC-MDM", "BAYR", "LCOP", "UDF", "LUDF", "MODM", "LMDM",
        "MDM", "MDC", "UDI", "LUDI", "BC-UDI", "LUD", "UG", "LUG", "LUC", "LUGE", "DVC", "LDVC",
        "LCMD", "BC-UC", "BC-UCD", "NCE", "M", "M-NC", "BC-DVC", "CHEV", "LEPAGE", "LASA",
    ],
    "Droite": [
        "UMP", "LUMP", "BC-UMP", "LR", "LLR", "BC-LR", "RPR", "RPF", "DVD", "LDVD", "BC-DVD",
        "DLF", "LDLF", "BC-DLF", "MPF", "UDFD", "SARK", "CHIR", "MADE", "PECA", "FILL", "VILL",
        "NIHO", "SCHI", "BOUT", "DUPO", "CHEM", "SAIN", "LAGU", "CPNT",
    ],
    "ExtremeDroite": [
        "FN", "LFN", "RN", "LRN", "BC-RN", "MNR", "MEGR", "LEPA", "EXD", "LEXD", "LXD", "BC-EXD",
        "BC-FN", "REC", "LREC", "DTE", "FRN", "MNA", "UXD",
    ],
    "Divers": [
        "DIV", "LDIV", "LDV", "AUT", "LAUT", "BC-DIV", "REG", "LDD", "DSV", "BC-RDG", "RDG",
        "PRG", "PRV", "ALLI", "LAGE", "LDR",
    ],
}

# The five codes that the pilot area puts elsewhere.
PILOT_NUANCES = {
    "UDI": "Droite", "LDVC": "Divers", "LXD": "Divers", "LFG": "Divers", "BC-UC": "Divers",
}

# Presidential candidates, used where a row has no known nuance.
# The order matters for the substring match of the pilot area.
CANDIDATES = [
    ("ARTHAUD", "Gauche"), ("POUTOU", "Gauche"), ("MELENCHON", "Gauche"), ("MÉLENCHON", "Gauche"),
    ("JADOT", "Gauche"), ("HIDALGO", "Gauche"), ("ROUSSEL", "Gauche"), ("HAMON", "Gauche"),
    ("HOLLANDE", "Gauche"), ("ROYAL", "Gauche"), ("JOSPIN", "Gauche"), ("BUFFET", "Gauche"),
    ("VOYNET", "Gauche"), ("BESANCENOT", "Gauche"), ("GLUCKSTEIN", "Gauche"), ("HUE", "Gauche"),
    ("MAMERE", "Gauche"), ("BOVÉ", "Gauche"), ("TAUBIRA", "Gauche"), ("JOLY", "Gauche"),
    ("MACRON", "Centre"), ("BAYROU", "Centre"), ("CHEVENEMENT", "Centre"), ("LEPAGE", "Centre"),
    ("LASSALLE", "Centre"),
    ("SARKOZY", "Droite"), ("CHIRAC", "Droite"), ("FILLON", "Droite"), ("PÉCRESSE", "Droite"),
    ("MADELIN", "Droite"), ("de VILLIERS", "Droite"), ("NIHOUS", "Droite"),
    ("SCHIVARDI", "Droite"), ("BOUTIN", "Droite"), ("DUPONT-AIGNAN", "Droite"),
    ("SAINT-JOSSE", "Droite"), ("LAGUILLER", "Droite"), ("ASSELINEAU", "Droite"),
    ("CHEMINADE", "Divers"),
    ("LE PEN", "ExtremeDroite"), ("ZEMMOUR", "ExtremeDroite"), ("MEGRET", "ExtremeDroite"),
]


def nuance_table(scope: str = "national") -> dict[str, str]:
    """Nuance code -> bloc for the ``national`` or the ``pilot`` area."""
    table = {code: bloc for bloc, codes in NUANCES.items() for code in codes}
    if scope == "pilot":
        table.update(PILOT_NUANCES)
    elif scope != "national":
        raise ValueError(f"unknown scope {scope!r}")
    return table


def dictionary(spark: SparkSession, table: dict[str, str], key: str, label: str) -> DataFrame:
    """A literal table as a two-column DataFrame."""
    rows = [F.struct(F.lit(k).alias(key), F.lit(v).alias(label)) for k, v in table.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def map_codes(c: Column | str, table: dict[str, str]) -> Column:
    """Label of ``c`` in a literal table, null when absent.

    One hash-set test per label inside codegen: no join and nothing to broadcast.
    """
    c = _col(c)
    members: dict[str, list[str]] = {}
    for code, label in table.items():
        members.setdefault(label, []).append(code)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for label, codes in members.items():
        out = out.when(c.isin(codes), label)
    return out


def contains_rule(name: Column | str, rules=CANDIDATES) -> Column:
    """Label of the first rule whose key contains the name or is contained in it.

    Both the key and the name are compared in upper case.  The rules are a short
    literal list, so this is a chain of conditions on the row, not a join.
    """
    name = _col(name)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for key, label in rules:
        key = F.lit(key.upper())
        out = out.when(F.contains(name, key) | F.contains(key, name), label)
    return out


def bloc_of(nuance: Column | str, candidate: Column | str, scope: str = "national") -> Column:
    """Bloc of a result row: nuance, else candidate name, else ``Divers``.

    The pilot area also tries a substring match in both directions for names
    that are not empty; the national table needs an exact name.
    """
    candidate = _col(candidate)
    name = upper_trim(candidate)
    steps = [map_codes(nuance, nuance_table(scope)), map_codes(name, dict(CANDIDATES))]
    if scope == "pilot":
        steps.append(F.when(candidate != "", contains_rule(name)))
    return F.coalesce(*steps, F.lit(OTHER_BLOC))


def share_column(bloc: str) -> str:
    return f"pct_{bloc.lower()}"


def arg_max_label(columns: list[str | Column], labels: list[str]) -> Column:
    """Label of the largest column; on a tie the first one wins; null when all are null."""
    values = F.array(*[_col(c) for c in columns])
    position = F.array_position(values, F.array_max(values))
    return F.get(F.array(*[F.lit(x) for x in labels]), (position - 1).cast("int"))


def dominant_bloc(prefix: str = "pct_") -> Column:
    return arg_max_label([prefix + b.lower() for b in MAIN_BLOCS], MAIN_BLOCS)
