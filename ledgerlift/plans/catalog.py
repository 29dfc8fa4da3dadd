"""What the filings hold and what is taken out of them, as data.

Everything in this module is a fixed value: field paths, section contents,
post codes and form variables. The operators read these tables; no logic here.
"""

from __future__ import annotations

from typing import NamedTuple

# --------------------------------------------------------------- fixed values
# Where the lists of posts sit inside a filing, with the theme each belongs to.


class PostList(NamedTuple):
    path: str
    hovedtema: str
    undertema: str


POST_LISTS: dict[str, PostList] = {
    "salgsinntekt": PostList("resultatregnskap.driftsinntekt.salgsinntekt.inntekt", "resultatregnskap", "driftsinntekt"),
    "annenDriftsinntekt": PostList("resultatregnskap.driftsinntekt.annenDriftsinntekt.inntekt", "resultatregnskap", "driftsinntekt"),
    "varekostnad": PostList("resultatregnskap.driftskostnad.varekostnad.kostnad", "resultatregnskap", "driftskostnad"),
    "loennskostnad": PostList("resultatregnskap.driftskostnad.loennskostnad.kostnad", "resultatregnskap", "driftskostnad"),
    "annenDriftskostnad": PostList("resultatregnskap.driftskostnad.annenDriftskostnad.kostnad", "resultatregnskap", "driftskostnad"),
    "finansinntekt": PostList("resultatregnskap.finansinntekt.inntekt", "resultatregnskap", "finansinntekt"),
    "finanskostnad": PostList("resultatregnskap.finanskostnad.kostnad", "resultatregnskap", "finanskostnad"),
    "balanseverdiForAnleggsmiddel": PostList("balanseregnskap.anleggsmiddel.balanseverdiForAnleggsmiddel.balanseverdi", "balanseregnskap", "anleggsmiddel"),
    "balanseverdiForOmloepsmiddel": PostList("balanseregnskap.omloepsmiddel.balanseverdiForOmloepsmiddel.balanseverdi", "balanseregnskap", "omloepsmiddel"),
    "langsiktigGjeld": PostList("balanseregnskap.gjeldOgEgenkapital.langsiktigGjeld.gjeld", "balanseregnskap", "gjeldOgEgenkapital"),
    "kortsiktigGjeld": PostList("balanseregnskap.gjeldOgEgenkapital.kortsiktigGjeld.gjeld", "balanseregnskap", "gjeldOgEgenkapital"),
    "egenkapital": PostList("balanseregnskap.gjeldOgEgenkapital.egenkapital.kapital", "balanseregnskap", "gjeldOgEgenkapital"),
    "gjeldInnenBankOgForsikring": PostList("balanseregnskap.gjeldOgEgenkapital.gjeldInnenBankOgForsikring.gjeld", "balanseregnskap", "gjeldOgEgenkapital"),
}

# Where the scalar sums sit.
SUMS: dict[str, str] = {
    "sumDriftsinntekt": "resultatregnskap.driftsinntekt.sumDriftsinntekt",
    "sumDriftskostnad": "resultatregnskap.driftskostnad.sumDriftskostnad",
    "sumFinansinntekt": "resultatregnskap.sumFinansinntekt",
    "sumFinanskostnad": "resultatregnskap.sumFinanskostnad",
    "aarsresultat": "resultatregnskap.aarsresultat",
    "sumBalanseverdiForAnleggsmiddel": "balanseregnskap.anleggsmiddel.sumBalanseverdiForAnleggsmiddel",
    "sumBalanseverdiForOmloepsmiddel": "balanseregnskap.omloepsmiddel.sumBalanseverdiForOmloepsmiddel",
    "sumBalanseverdiForEiendel": "balanseregnskap.sumBalanseverdiForEiendel",
    "sumEgenkapital": "balanseregnskap.gjeldOgEgenkapital.sumEgenkapital",
    "sumLangsiktigGjeld": "balanseregnskap.gjeldOgEgenkapital.sumLangsiktigGjeld",
    "sumKortsiktigGjeld": "balanseregnskap.gjeldOgEgenkapital.sumKortsiktigGjeld",
    "sumGjeldOgEgenkapital": "balanseregnskap.sumGjeldOgEgenkapital",
    "sumGjeldInnenBankOgForsikring": "balanseregnskap.gjeldOgEgenkapital.sumGjeldInnenBankOgForsikring",
}

# Named amounts of the inventory specification.
INVENTORY_AMOUNTS = (
    "raavareOgInnkjoeptHalvfabrikata",
    "vareUnderTilvirkning",
    "ferdigTilvirketVare",
    "innkjoeptVareForVideresalg",
    "buskap",
    "selvprodusertVareBenyttetIEgenProduksjon",
    "reinPelsdyrOgPelsdyrskinnPaaLager",
    "sumVerdiAvVarelager",
)

# ------------------------------------------------------------------- sections
# A section is a set of branches (post lists and scalar sums) and a row shape.
MAIN = ("inntektsaar", "id", "felt", "beloep", "registreringstidspunkt", "sekvensnummer")
THEME = ("felt", "beloep", "sekvensnummer")
THEME_KEY_FIRST = ("sekvensnummer", "felt", "beloep")

RESULT_SUMS = ("sumDriftsinntekt", "sumDriftskostnad", "sumFinansinntekt", "sumFinanskostnad", "aarsresultat")
BALANCE_SUMS = (
    "sumBalanseverdiForAnleggsmiddel",
    "sumBalanseverdiForOmloepsmiddel",
    "sumBalanseverdiForEiendel",
    "sumEgenkapital",
    "sumLangsiktigGjeld",
    "sumKortsiktigGjeld",
    "sumGjeldOgEgenkapital",
)
INCOME_LISTS = (
    "salgsinntekt",
    "annenDriftsinntekt",
    "varekostnad",
    "loennskostnad",
    "annenDriftskostnad",
    "finansinntekt",
    "finanskostnad",
)
BALANCE_LISTS = (
    "balanseverdiForAnleggsmiddel",
    "balanseverdiForOmloepsmiddel",
    "langsiktigGjeld",
    "kortsiktigGjeld",
    "egenkapital",
)


class Section(NamedTuple):
    branches: tuple[str, ...]
    columns: tuple[str, ...]
    scheduled: bool = True  # written by a collection run


SECTIONS: dict[str, Section] = {
    "naering": Section(INCOME_LISTS + RESULT_SUMS + BALANCE_SUMS, MAIN),
    "driftsinntekt": Section(("salgsinntekt", "annenDriftsinntekt"), THEME),
    "driftskostnad": Section(("varekostnad", "loennskostnad", "annenDriftskostnad"), THEME),
    "finansinntekt": Section(("finansinntekt",), THEME),
    "finanskostnad": Section(("finanskostnad",), THEME),
    "sum_resultatregnskap": Section(RESULT_SUMS, THEME),
    "balanseregnskap": Section(BALANCE_LISTS + BALANCE_SUMS, MAIN),
    "sum-balanseregnskap-anleggsmiddel": Section(("sumBalanseverdiForAnleggsmiddel",), THEME),
    "balanseverdi-anleggsmiddel": Section(("balanseverdiForAnleggsmiddel",), THEME_KEY_FIRST),
    "sum-balanseregnskap-omloepsmiddel": Section(("sumBalanseverdiForOmloepsmiddel",), THEME_KEY_FIRST),
    "balanseverdi-omloepsmiddel": Section(("balanseverdiForOmloepsmiddel",), THEME_KEY_FIRST),
    "sum-langsiktig-gjeld": Section(("sumLangsiktigGjeld",), THEME_KEY_FIRST),
    "sum-kortsiktig-gjeld": Section(("sumKortsiktigGjeld",), THEME_KEY_FIRST),
    "sum-egenkapital": Section(("sumEgenkapital",), THEME_KEY_FIRST),
    "langsiktig-gjeld": Section(("langsiktigGjeld",), THEME_KEY_FIRST),
    "kortsiktig-gjeld": Section(("kortsiktigGjeld",), THEME_KEY_FIRST),
    "egenkapital": Section(("egenkapital",), THEME_KEY_FIRST),
    "sum-gjeld-innen-bank-og-forsikring": Section(("sumGjeldInnenBankOgForsikring",), THEME_KEY_FIRST, False),
    "gjeld-innen-bank-og-forsikring": Section(("gjeldInnenBankOgForsikring",), THEME_KEY_FIRST, False),
    "sum-eiendel": Section(("sumBalanseverdiForEiendel",), THEME_KEY_FIRST, False),
    "sum-gjeld-og-egenkapital": Section(("sumGjeldOgEgenkapital",), THEME_KEY_FIRST, False),
}

FORESTRY_ACCOUNTS_PREFIX = "skogbruk-skog-og-toemmerkonto"
FORESTRY_FUND_PREFIX = "skogbruk-skogfond"
SNAPSHOT_PREFIX = "opprinnelig-struktur"

# ------------------------------------------------------------- business filter
BUSINESS_TYPES = ("enkeltpersonforetak", "selskapMedDeltakerfastsetting", "samvirkeforetak")
ACCOUNTING_DUTIES = ("ingenRegnskapsplikt", "begrensetRegnskapsplikt")

# ---------------------------------------------------------------- derivations
# Post objects: form variable -> the post codes it adds up. A code may feed
# several variables and a variable may add several codes.
POST_VARIABLES: dict[str, dict[str, tuple[str, ...]]] = {
    "salgsinntekt": {
        "O_7360": ("3000",), "O_7362": ("3100",), "O_7364": ("3200",), "O_15843": ("3300",),
    },
    "annenDriftsinntekt": {
        "O_7368": ("3400",), "O_39729": ("3410",), "O_7370": ("3600",), "O_17163": ("3650",),
        "O_32864": ("3695",), "O_7374": ("3700",), "O_737475": ("3710",), "O_13676": ("3890",),
        "O_7266": ("3895",), "O_7376": ("3900",), "O_37279": ("3910", "7911"),
    },
    "varekostnad": {
        "O_7378": ("4005",), "O_7380": ("4295",), "O_7382": ("4500",), "O_7384": ("4995",),
    },
    "loennskostnad": {
        "O_15844": ("5000",), "O_15845": ("5300",), "O_15846": ("5400",), "O_7392": ("5420",),
        "O_7396": ("5900",), "O_27426": ("5950",),
    },
    "annenDriftskostnad": {
        "O_15847": ("6000",), "O_7400": ("6100",), "O_15848": ("6200",), "O_7404": ("6300",),
        "O_7408": ("6340",), "O_7406": ("6395",), "O_15849": ("6400",), "O_2812175": ("6440",),
        "O_15850": ("6500",), "O_7269": ("6600",), "O_15836": ("6695",), "O_7414": ("6700",),
        "O_7416": ("6995",), "O_3283675": ("6998",), "O_7418": ("7000",), "O_7422": ("7020",),
        "O_15851": ("7040",), "O_7273": ("7080",), "O_15801": ("7099",), "O_7424": ("7155",),
        "O_7426": ("7165",), "O_7428": ("7295",), "O_7275": ("7330",), "O_7277": ("7350",),
        "O_727975": ("7400",), "O_728075": ("7420",), "O_11334": ("7500",), "O_7430": ("7565",),
        "O_7432": ("7600",), "O_15837": ("7700",), "O_1202": ("7890",), "O_3405675": ("7830",),
        "O_3405875": ("7860",), "O_7283": ("7897",), "O_37281": ("7910",), "O_757911": ("7911",),
    },
    "finansinntekt": {
        "O_38885": ("8005",), "O_38887": ("8050",), "O_38888": ("8074",), "O_15852": ("8060",),
        "O_15853": ("8079",), "O_38889": ("8090",), "O_88888": ("8091",),
    },
    "finanskostnad": {
        "O_758105": ("8105",), "O_38891": ("8150",), "O_15854": ("8160",), "O_38890": ("8174",),
        "O_7441": ("8179",),
    },
    "balanseverdiForAnleggsmiddel": {
        "O_7445": ("1000",), "O_2400": ("1020",), "O_7447": ("1080",), "O_15796": ("1105",),
        "O_15795": ("1115",), "O_36968": ("1117",), "O_32838": ("1120",), "O_7451": ("1130",),
        "O_7454": ("1150",), "O_7456": ("1160",), "O_15792": ("1205",), "O_15793": ("1221",),
        "O_15794": ("1225",), "O_15791": ("1238",), "O_37283": ("1239",), "O_15790": ("1280",),
        "O_26535": ("1290",), "O_7306": ("1295",), "O_15838": ("1296",), "O_37285": ("1298",),
        "O_38915": ("1350",), "O_38916": ("1360", "1350"), "O_38917": ("1370",),
        "O_38918": ("1380",), "O_38919": ("1390",),
    },
    "balanseverdiForOmloepsmiddel": {
        "O_1576875": ("1400",), "O_140175": ("1401",), "O_18116": ("1500",), "O_26537": ("1530",),
        "O_38924": ("1565",), "O_38925": ("1570",), "O_7471": ("1780",), "O_38927": ("1800",),
        "O_51810": ("1810",), "O_38928": ("1830",), "O_7474": ("1880",), "O_15789": ("1895",),
        "O_15812": ("1900",), "O_7477": ("1920",), "O_7315": ("1950",),
    },
    "Egenkapital": {
        "O_7479": ("2015",), "O_7481": ("2050",), "O_7483": ("2080",), "O_1471": ("2095",),
        "O_15839": ("2096",), "O_15803": ("2097",), "O_37287": ("2098",), "O_38936": ("2000",),
    },
    "LangsiktigGjeld": {
        "O_7485": ("2220",), "O_7327": ("2290",), "O_7487": ("2280", "2289"), "O_38945": ("2250",),
        "O_38947": ("2290",),
    },
    "KortsiktigGjeld": {
        "O_7489": ("2380",), "O_7491": ("2400",), "O_7493": ("2600",), "O_7495": ("2740",),
        "O_7497": ("2770",), "O_7499": ("2790",), "O_29065": ("2800",), "O_7501": ("2900",),
        "O_7503": ("2910",), "O_7505": ("2949",), "O_7507": ("2950",), "O_750975": ("2990",),
    },
}

# The post list each post object is read from, where the two names differ.
OBJECT_LISTS = {"Egenkapital": "egenkapital", "LangsiktigGjeld": "langsiktigGjeld", "KortsiktigGjeld": "kortsiktigGjeld"}

# Amount objects: form variable -> (amount, amount to subtract or None).
AMOUNT_VARIABLES: dict[str, dict[str, tuple[str, str | None]]] = {
    "spesifikasjonAvVarelager": {
        "O_15764": ("raavareOgInnkjoeptHalvfabrikata", None),
        "O_15765": ("vareUnderTilvirkning", None),
        "O_15766": ("ferdigTilvirketVare", None),
        "O_15767": ("innkjoeptVareForVideresalg", None),
        "O_9669": ("buskap", None),
        "O_17165": ("selvprodusertVareBenyttetIEgenProduksjon", None),
        "O_31625": ("reinPelsdyrOgPelsdyrskinnPaaLager", None),
        "O_15768": ("sumVerdiAvVarelager", None),
    },
    "sum_resultatregnskap": {
        "O_15799": ("sumDriftsinntekt", None),
        "O_7286": ("sumDriftskostnad", None),
        "O_6686": ("sumDriftsinntekt", "sumDriftskostnad"),
        "O_13962": ("sumFinansinntekt", None),
        "O_13964": ("sumFinanskostnad", None),
        "O_6675": ("aarsresultat", None),
    },
    "sum_balanseregnskap": {
        "O_15797": ("sumBalanseverdiForEiendel", None),
        "O_75250": ("sumEgenkapital", None),
        "O_38948": ("sumLangsiktigGjeld", None),
        "O_38958": ("sumKortsiktigGjeld", None),
        "O_7511": ("sumGjeldOgEgenkapital", None),
        "O_38920": ("sumBalanseverdiForAnleggsmiddel", None),
        "O_38934": ("sumBalanseverdiForOmloepsmiddel", None),
        "kontroll": ("sumBalanseverdiForEiendel", "sumGjeldOgEgenkapital"),
    },
}

# Copied as they are, one row per input row.
DATE_VARIABLES = {"virksomhet": {"O_15805": "start", "O_15806": "slutt"}}

# Objects without an active variable: they come down to their keys, and are not stored.
KEY_OBJECTS = ("spesifikasjonAvSkattemessigVerdiPaaFordring", "fordeltBeregnetNaeringsinntekt")

# All objects in the order of the form.
OBJECTS = (
    "virksomhet",
    "spesifikasjonAvVarelager",
    "spesifikasjonAvSkattemessigVerdiPaaFordring",
    "salgsinntekt",
    "annenDriftsinntekt",
    "varekostnad",
    "loennskostnad",
    "annenDriftskostnad",
    "finansinntekt",
    "finanskostnad",
    "balanseverdiForAnleggsmiddel",
    "balanseverdiForOmloepsmiddel",
    "Egenkapital",
    "LangsiktigGjeld",
    "KortsiktigGjeld",
    "sum_resultatregnskap",
    "sum_balanseregnskap",
    "fordeltBeregnetNaeringsinntekt",
)
STORED_OBJECTS = tuple(name for name in OBJECTS if name not in KEY_OBJECTS)
# ---------------------------------------------------------- end of fixed values


def object_list(name: str) -> str:
    """The post list a post object is read from."""
    return OBJECT_LISTS.get(name, name)


def list_codes(post_list: str) -> tuple[str, ...]:
    """Post codes the form knows for a list, each once, in form order."""
    for name, variables in POST_VARIABLES.items():
        if object_list(name) == post_list:
            return tuple(dict.fromkeys(code for codes in variables.values() for code in codes))
    return ()
