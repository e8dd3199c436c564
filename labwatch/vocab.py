"""Spellings, codes and thresholds the results depend on."""

# Pathogens, in output order.
PATHOGENS = ["DENV", "ZIKV", "CHIKV", "YFV", "MAYV", "OROV", "WNV"]
RESULT_COLUMNS = [f"{p.lower()}_test_result" for p in PATHOGENS]
RESULT_OF = dict(zip(PATHOGENS, RESULT_COLUMNS))

# Result codes of a line and their text after a sample is collapsed.
POSITIVE, NEGATIVE, NOT_TESTED, UNRECOGNISED, INDETERMINATE = 1, 0, -1, -2, -3
RESULT_TEXT = {POSITIVE: "Pos", NEGATIVE: "Neg", NOT_TESTED: "NT"}

# Text used in summaries where a value is missing.
MISSING = "NOT REPORTED"

# Kit -> method.
KIT_METHODS = {
    "arbo_pcr_3": "PCR multiplex",
    "chikv_pcr": "PCR singleplex",
    "denv_pcr": "PCR singleplex",
    "igg_serum": "Sorologia (IgG)",
    "igm_serum": "Sorologia (IgM)",
    "mayv_pcr": "PCR singleplex",
    "ns1_antigen": "Antígeno singleplex",
    "orov_pcr": "PCR singleplex",
    "yfv_pcr": "PCR singleplex",
    "zikv_pcr": "PCR singleplex",
}

# Kits that count for the positivity of one pathogen.
DENV_KITS = ["arbo_pcr_3", "ns1_antigen", "denv_pcr"]
CHIKV_KITS = ["arbo_pcr_3", "chikv_pcr", "igm_serum"]
OTHER_KITS = ["arbo_pcr_3", "igm_serum", "orov_pcr", "mayv_pcr", "yfv_pcr", "zikv_pcr"]

# Age bands, both ends included.
AGE_BANDS = [
    ("00-04", -1, 4),
    ("05-09", 5, 9),
    ("10-19", 10, 19),
    ("20-29", 20, 29),
    ("30-39", 30, 39),
    ("40-49", 40, 49),
    ("50-59", 50, 59),
    ("60-69", 60, 69),
    ("70-79", 70, 79),
    ("80+", 80, 1000),
]

# Month abbreviations, and the first epidemiological week shown under each of them.
MONTHS = ["Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez"]
MONTH_FIRST_WEEK = [1, 5, 9, 13, 18, 22, 26, 31, 35, 39, 44, 48]

# State abbreviation -> (name, region, numeric code).
STATES = {
    "AC": ("Acre", "NORTE", 12),
    "AL": ("Alagoas", "NORDESTE", 27),
    "AP": ("Amapá", "NORTE", 16),
    "AM": ("Amazonas", "NORTE", 13),
    "BA": ("Bahia", "NORDESTE", 29),
    "CE": ("Ceará", "NORDESTE", 23),
    "DF": ("Distrito Federal", "CENTRO-OESTE", 53),
    "ES": ("Espírito Santo", "SUDESTE", 32),
    "GO": ("Goiás", "CENTRO-OESTE", 52),
    "MA": ("Maranhão", "NORDESTE", 21),
    "MT": ("Mato Grosso", "CENTRO-OESTE", 51),
    "MS": ("Mato Grosso do Sul", "CENTRO-OESTE", 50),
    "MG": ("Minas Gerais", "SUDESTE", 31),
    "PA": ("Pará", "NORTE", 15),
    "PB": ("Paraíba", "NORDESTE", 25),
    "PR": ("Paraná", "SUL", 41),
    "PE": ("Pernambuco", "NORDESTE", 26),
    "PI": ("Piauí", "NORDESTE", 22),
    "RJ": ("Rio de Janeiro", "SUDESTE", 33),
    "RN": ("Rio Grande do Norte", "NORDESTE", 24),
    "RS": ("Rio Grande do Sul", "SUL", 43),
    "RO": ("Rondônia", "NORTE", 11),
    "RR": ("Roraima", "NORTE", 14),
    "SC": ("Santa Catarina", "SUL", 42),
    "SP": ("São Paulo", "SUDESTE", 35),
    "SE": ("Sergipe", "NORDESTE", 28),
    "TO": ("Tocantins", "NORTE", 17),
}

# Region code -> display name.
REGIONS = {
    "NORTE": "Norte",
    "NORDESTE": "Nordeste",
    "CENTRO-OESTE": "Centro-Oeste",
    "SUDESTE": "Sudeste",
    "SUL": "Sul",
}
REGION_NAMES = ["Centro-Oeste", "Nordeste", "Norte", "Sudeste", "Sul"]

# Thresholds and horizons.
MIN_TESTS = 50
SUMMARY_START = "2022-01-01"
COUNTRY = "Brasil"
LOCAL_ZONE = "America/Sao_Paulo"
