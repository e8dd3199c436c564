"""The eight laboratory feeds: headers, code lists and rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.feeds.spec import LabSpec
from labwatch.functions.dates import completed_years
from labwatch.functions.results import (
    age_days_years,
    age_units,
    band_result,
    classify,
    comma_number,
    cutoff_result,
    lookup,
    plausible_age,
    prefix_pattern,
)
from labwatch.functions.text import drop_punctuation, normalize_sex, plain_upper, state_name
from labwatch.operators.shaping import any_present, none_of

POS, NEG = vocab.POSITIVE, vocab.NEGATIVE
UNKNOWN_KIT = "UNKNOWN"


def one_of(name: str, *values: str) -> Column:
    return F.col(name).isin(*values)


def no_case(name: str, text: str) -> Column:
    return F.col(name).ilike(text)


def multiplex_or(exam: str, exam_name: str, detail: str) -> Column:
    """The analyte is part of the key, except that one multiplex exam is a single sample."""
    return F.when(no_case(exam, exam_name), "MULTIPLEX").otherwise(F.col(detail))


def floor_date(text: str) -> Column:
    return F.lit(text).cast("date")


# --- EINSTEIN -------------------------------------------------------------------------------
# Analyte spellings, kits, result words.
EINSTEIN_KITS = {
    "VÍRUS DENGUE:": "arbo_pcr_3",
    "VÍRUS CHIKUNGUNYA:": "arbo_pcr_3",
    "VÍRUS ZIKA:": "arbo_pcr_3",
    "DENGUE IGG": "igg_serum",
    "DENGUE IGG, TESTE RÁPIDO": "igg_serum",
    "DENGUE IGM": "igm_serum",
    "DENGUE IGM, TESTE RÁPIDO": "igm_serum",
    "DENGUE NS1, TESTE RÁPIDO": "ns1_antigen",
    "ANTÍGENO NS1 DO VIRUS DA DENGUE": "ns1_antigen",
    "NS1 EUROIMMUN": "ns1_antigen",
}
# The analytes that tell of each pathogen.
EINSTEIN_CODES = {
    "DENV": [
        "VÍRUS DENGUE:",
        "DENGUE IGG",
        "DENGUE IGG, TESTE RÁPIDO",
        "DENGUE IGM",
        "DENGUE IGM, TESTE RÁPIDO",
        "DENGUE NS1, TESTE RÁPIDO",
        "ANTÍGENO NS1 DO VIRUS DA DENGUE",
        "NS1 EUROIMMUN",
    ],
    "ZIKV": ["VÍRUS ZIKA:"],
    "CHIKV": ["VÍRUS CHIKUNGUNYA:"],
}
EINSTEIN_RESULTS = {"DETECTADO": POS, "NÃO DETECTADO": NEG}

EINSTEIN = LabSpec(
    lab_id="EINSTEIN",
    columns={
        "test_id": "accession",
        "sex": "sexo",
        "age": "idade",
        "exame": "exame",
        "detalhe_exame": "detalhe_exame",
        "date_testing": "dh_coleta",
        "location": "municipio",
        "state": "estado",
        "pathogen": "patogeno",
        "result": "resultado",
    },
    dates={"date_testing": ("d/M/yyyy", "yyyy-MM-dd HH:mm:ss")},
    casts={"age": "int"},
    distinct_raw=True,
    key=lambda: [
        F.col("test_id"),
        F.col("exame"),
        multiplex_or("exame", "PCR MULTIPLEX ZIKA, DENGUE E CHIKUNGUNYA", "detalhe_exame"),
    ],
    rules={
        "detalhe_exame": lambda: F.upper("detalhe_exame"),
        "test_kit": lambda: lookup(F.upper("detalhe_exame"), EINSTEIN_KITS, UNKNOWN_KIT),
        "sex": lambda: normalize_sex("sex", "UNKNOWN"),
        "location": lambda: drop_punctuation("location"),
        "state": lambda: drop_punctuation("state"),
        "result": lambda: lookup("result", EINSTEIN_RESULTS),
    },
    keep=lambda: none_of("test_id", ["2024234005520"]) & (F.col("date_testing") >= floor_date("2025-08-01")),
    code="detalhe_exame",
    codes=EINSTEIN_CODES,
    format="workbook",
    sheet="itps_dengue",
    glob="*.xlsx",
)

# --- SABIN ----------------------------------------------------------------------------------
SABIN_MULTIPLEX = "PCR para Zika, Chikungunya e Dengue"
# Codes per kit.
SABIN_MULTIPLEX_CODES = ["PCRCHIK", "PCRDE", "VIRUSZICA"]
SABIN_IGG = ["DENGIGG", "DENGUEGI", "ZIKAGINDICE", "ZIKAIGG2", "RCHIKUNGMELISAIGG"]
SABIN_IGM = ["DENGUEMELISA", "DENGUEMIC", "DENGIGM", "ZIKAM1", "ZIKAM2", "RCHIKUNGMELISAIGM"]
SABIN_NS1 = ["NS1ELISA", "NS1IMUNOCRO"]
# Fixed values: (code, exam pattern) pairs of the dengue PCR.
SABIN_DENV_PCR = [
    ("PCRDE", "DETECÇÃO MOLECULAR DO V_RUS DENGUE "),
    ("PCRDE", "DETECÇÃO MOLECULAR DO VÍRUS DENGUE COM GENOTIPAGEM"),
    ("DENV", "DETECÇÃO MOLECULAR DO VÍRUS DENGUE COM GENOTIPAGEM"),
    ("PCRD", "DETECÇÃO E TIPAGEM DO VÍRUS DA DENGUE"),
]
SABIN_CHIKV_PCR = ["CHIKVPCR-BIOMOL", "PCRCHIKCT", "CHIKUPCR", "CHICK"]
SABIN_ZIKV_PCR = ["ZIKAPCRBIO", "ZIKAV"]
SABIN_OROV_PCR = ["OROVPCR"]
SABIN_MAYV_PCR = ["RESMAYARO", "MAYARO"]
SABIN_YFV = ("YFV", "FEBRE AMARELA PCR")
# Codes per pathogen.
SABIN_CODES = {
    "DENV": [
        "PCRDE", "DENGIGG", "DENGUEGI", "DENGUEMELISA", "DENGUEMIC", "DENGIGM", "DNS1", "DENGUEMI",
        "NS1ELISA", "NS1IMUNOCRO", "PCRDECT", "PCRD", "DENV",
    ],
    "ZIKV": [
        "VIRUSZICA", "ZIKAGINDICE", "ZIKAM1", "ZIKAM2", "ZIKAIGG2", "ZIKAPCRBIO", "VIRUSZICACT", "ZIKAV",
    ],
    "CHIKV": [
        "PCRCHIK", "RCHIKUNGMELISAIGG", "RCHIKUNGMELISAIGM", "CHIKVPCR-BIOMOL", "PCRCHIKCT", "CHIKUPCR",
        "CHICK",
    ],
    "YFV": ["YFIC", "YFV"],
    "MAYV": ["MAYROVIGG", "MAYVIGM", "RESMAYARO", "MAYARO"],
    "OROV": ["DEVORO", "OROVPCR"],
}
# Result texts.
SABIN_POSITIVE = [
    "DETECTADO (PRESENCA DO MATERIAL GENETICO DO VIRUS DENGUE)",
    "DETECTADO (PRESENCA DE MATERIAL GENETICO DO VIRUS DENGUE).",
    "PRESENCA DE MATERIAL GENETICO DO VIRUS DENGUE.",
    "DETECTADO (PRESENCA DO MATERIAL GENETICO DO VIRUS ZIKA)",
    "DETECTADO (PRESENCA DO MATERIAL GENETICO DO VIRUS CHIKUNGUNYA)",
    "DETECTADO DENGUE SOROTIPO 2",
    "PRESENCA DE MATERIAL GENETICO DO VIRUS DENGUE,",
    "DETECTADO VIRUS DENGUE TIPO 1",
    "DETECTADO VIRUS DENGUE TIPO 2",
    "DETECTADO VIRUS DENGUE TIPO 3",
    "DETECTADO VIRUS DENGUE TIPO 4",
    "DETECTAVEL",
    "POSITIVO",
    "REAGENTE",
    "REAGENTE 1:200",
    "REAGENTE'",
    "REAGEN",
    "DETECTADO",
]
SABIN_NEGATIVE = [
    "NAO DETECTADO (AUSENCIA DE MATERIAL GENETICO DO VIRUS CHIKUNGUNYA)",
    "NAO DETECTADO (AUSENCIA DO MATERIAL GENETICO DO VIRUS CHIKUNGUNYA)",
    "NAO DETECTADO (AUSENCIA DO MATERIAL GENETICO DO VIRUS DENGUE)",
    "NAO DETECTADO (AUSENCIA DO MATERIAL GENETICO DO VIRUS ZIKA)",
    "NAO DETECTADO RNA DO VIRUS MAYARO",
    "NAO DETECTADO RNA DO VIRUS DA DENGUE",
    "NAO DETECTADO",
    "AUSENCIA DE MATERIAL GENETICO DO VIRUS ZIKA,",
    "NAO",
    "INDETECTAVEL",
    "'",
    "NAO REAGENTE",
    "NAO RE",
    "NEGATIVO",
]
# Text patterns of deliveries before 2024.
SABIN_LEGACY_END = "2024-01-01"
SABIN_LEGACY = [
    ("NAO REA%", NEG),
    ("NAO REGENTE", NEG),
    ("NAO DETECTADO%", NEG),
    ("INFERIOR A%", NEG),
    ("AUSENCIA DE MATERIAL GENETICO%", NEG),
    ("REAGEN%", POS),
    ("PRESENCA DE MATERIAL GENETICO%", POS),
    ("DETECTADO %", POS),
]
# Result texts without information.
SABIN_VOID_RESULTS = [
    "INDETERMINADO", "INCONCLUSIVO", "INCONCLUSIVE", "INCONCLUSIVO, VIDE NOTA.", "-", "*", "E", "", "TESTE",
    "XXXXXX", "XXXXXXX", "XXXXXXXX", "XXXXXXXXX",
]
SABIN_CUTOFF = 0.80
# Only these codes are used; every code a delivery marks as redundant is outside this list. The
# chikungunya Ct code stays in, as in the deliveries' published results.
SABIN_ALLOWED = [
    *SABIN_MULTIPLEX_CODES, *SABIN_IGG, *SABIN_IGM, *SABIN_NS1, "DENV", "PCRD", *SABIN_CHIKV_PCR,
    *SABIN_ZIKV_PCR, *SABIN_OROV_PCR, *SABIN_MAYV_PCR, "YFV",
]


# Codes that decide the kit alone.
SABIN_KITS = {
    **dict.fromkeys(SABIN_IGG, "igg_serum"),
    **dict.fromkeys(SABIN_IGM, "igm_serum"),
    **dict.fromkeys(SABIN_NS1, "ns1_antigen"),
    **dict.fromkeys(SABIN_CHIKV_PCR, "chikv_pcr"),
    **dict.fromkeys(SABIN_ZIKV_PCR, "zikv_pcr"),
    **dict.fromkeys(SABIN_OROV_PCR, "orov_pcr"),
    **dict.fromkeys(SABIN_MAYV_PCR, "mayv_pcr"),
}
SABIN_WORDS = {**dict.fromkeys(SABIN_POSITIVE, POS), **dict.fromkeys(SABIN_NEGATIVE, NEG)}


def sabin_kit() -> Column:
    code = F.col("detalhe_exame")
    dengue = F.lit(False)
    for own, exam in SABIN_DENV_PCR:
        dengue = dengue | ((code == own) & no_case("exame", exam))
    return classify(
        [
            (code.isin(*SABIN_MULTIPLEX_CODES) & no_case("exame", SABIN_MULTIPLEX), "arbo_pcr_3"),
            (dengue, "denv_pcr"),
            ((code == SABIN_YFV[0]) & (F.col("exame") == SABIN_YFV[1]), "yfv_pcr"),
        ],
        lookup(code, SABIN_KITS, UNKNOWN_KIT),
    )


def plain_result(raw: Column) -> Column:
    return plain_upper(F.btrim(raw, F.lit(" ")))


def sabin_result() -> Column:
    text = F.col("result")
    legacy = F.col("date_testing") < floor_date(SABIN_LEGACY_END)
    negative, positive = ([p for p, code in SABIN_LEGACY if code == kind] for kind in (NEG, POS))
    return F.coalesce(
        lookup(text, SABIN_WORDS),
        cutoff_result(text, SABIN_CUTOFF),
        F.when(legacy & text.rlike(prefix_pattern(negative)), NEG),
        F.when(legacy & text.rlike(prefix_pattern(positive)), POS),
        F.lit(vocab.UNRECOGNISED),
    )


def sabin(month_first: bool = True) -> LabSpec:
    """Day and month change places between deliveries, so the order is a parameter."""
    order = "M/d/yyyy" if month_first else "d/M/yyyy"
    return LabSpec(
        lab_id="SABIN",
        columns={
            "test_id": "OS",
            "state": "Estado",
            "location": "Municipio",
            "date_testing": "DataAtendimento",
            "birth_date": "DataNascimento",
            "sex": "Sexo",
            "exame": "Descricao",
            "detalhe_exame": "Parametro",
            "result": "Resultado",
        },
        dates={"date_testing": (order,), "birth_date": (order,)},
        converters={"result": plain_result},
        key=lambda: [F.col("test_id"), F.col("exame"), multiplex_or("exame", SABIN_MULTIPLEX, "detalhe_exame")],
        rules={
            "test_kit": sabin_kit,
            "sex": lambda: normalize_sex("sex"),
            "age": lambda: completed_years("date_testing", "birth_date"),
            "location": lambda: drop_punctuation("location"),
            "state": lambda: drop_punctuation("state"),
            "result": sabin_result,
        },
        keep=lambda: none_of("result", SABIN_VOID_RESULTS)
        & ~((F.col("detalhe_exame") == "YFV") & no_case("exame", "PAINEL MOLECULAR PARA DENGUE %"))
        & one_of("detalhe_exame", *SABIN_ALLOWED),
        code="detalhe_exame",
        codes=SABIN_CODES,
        # (kept analyte, analyte that repeats it)
        redundant=(("DENGIGG", "DENGUEGI"), ("NS1ELISA", "NS1IMUNOCRO")),
        format="workbook",
        glob="*.xlsx",
        drop_footer=True,
        all_sheets=True,
    )


SABIN = sabin()

# --- FLEURY ---------------------------------------------------------------------------------
# Analyte -> kit.
FLEURY_KITS = {
    "CHIKUNGUNYA, ANTICORPOS, IGG": "igg_serum",
    "CHIKUNGUNYA, ANTICORPOS, IGM": "igm_serum",
    "CHIKUNGUNYA, PCR": "chikv_pcr",
    "DENGUE, ANTIGENO NS1, TESTE RAPIDO": "ns1_antigen",
    "DENGUE, IGG": "igg_serum",
    "DENGUE, IGG, TESTE RAPIDO": "igg_serum",
    "DENGUE, IGM": "igm_serum",
    "DENGUE, IGM, TESTE RAPIDO": "igm_serum",
    "DENGUE, NS1": "ns1_antigen",
    "ZIKA VIRUS, DETECCAO NO RNA": "zikv_pcr",
    "ZIKA VIRUS - IGG": "igg_serum",
    "ZIKA VIRUS - IGM": "igm_serum",
    "FEBRE AMARELA, ANTICORPOS, IGG": "igg_serum",
    "FEBRE AMARELA, ANTICORPOS, IGM": "igm_serum",
    "FEBRE AMARELA, PCR": "yfv_pcr",
    "MAYARO, ANTICORPOS, IGM": "igm_serum",
    "MAYARO, ANTICORPOS, IGG": "igg_serum",
    "MAYARO, DETECCAO DO RNA POR PCR": "mayv_pcr",
    "OROPOUCHE, ANTICORPOS, IGG": "igg_serum",
    "OROPOUCHE, ANTICORPOS, IGM": "igm_serum",
    "OROPOUCHE, DETECCAO DO RNA POR PCR": "orov_pcr",
}
# The analytes that tell of each pathogen.
FLEURY_CODES = {
    "DENV": [
        "DENGUE, ANTIGENO NS1, TESTE RAPIDO",
        "DENGUE, IGG",
        "DENGUE, IGG, TESTE RAPIDO",
        "DENGUE, IGM",
        "DENGUE, IGM, TESTE RAPIDO",
        "DENGUE, NS1",
    ],
    "ZIKV": [
        "ZIKA VIRUS, DETECCAO NO RNA",
        "ZIKA VIRUS - IGG",
        "ZIKA VIRUS - IGM",
    ],
    "CHIKV": [
        "CHIKUNGUNYA, ANTICORPOS, IGG",
        "CHIKUNGUNYA, ANTICORPOS, IGM",
        "CHIKUNGUNYA, PCR",
    ],
    "YFV": [
        "FEBRE AMARELA, ANTICORPOS, IGG",
        "FEBRE AMARELA, ANTICORPOS, IGM",
        "FEBRE AMARELA, PCR",
    ],
    "MAYV": [
        "MAYARO, ANTICORPOS, IGM",
        "MAYARO, ANTICORPOS, IGG",
        "MAYARO, DETECCAO DO RNA POR PCR",
    ],
    "OROV": [
        "OROPOUCHE, ANTICORPOS, IGG",
        "OROPOUCHE, ANTICORPOS, IGM",
        "OROPOUCHE, DETECCAO DO RNA POR PCR",
    ],
}
# Result patterns, in order.
FLEURY_RESULTS = [
    ("INDETECTAVEL", NEG),
    ("NAO REAGENT%", NEG),
    ("NAO DETECTADO (NEGATIVO)", NEG),
    ("NEGATIVO", NEG),
    ("REAGENT%", POS),
    ("DETECTADO (POSITIVO)", POS),
    ("POSITIVO", POS),
    ("DETECTAVEL", POS),
]
FLEURY_INDEX_EXAMS = ["DENGUEG", "DENGUEM", "DENGUENS1"]
FLEURY_INDEX_BELOW = ["INFERIOR A 0,9", "INFERIOR A 0,5"]
FLEURY_INDEX_BAND = (0.9, 1.1)
# Respiratory exams, void results, bad ids.
FLEURY_RESPIRATORY = [
    "2019NCOV", "AGCOVIDNS", "AGSINCURG", "COVID19GX", "COVID19SALI", "COVIDFLURSVGX", "INFLUENZAPCR",
    "VIRUSMOL", "VRSAG", "AGINFLU", "COVID19POCT", "FLUABRSVGX", "2019NCOVTE",
]
FLEURY_VOID_RESULTS = ["INDETERMINADO", "INDETERMINADA", "*", "INCONCLUSIVO"]
FLEURY_VOID_PATTERNS = [
    "RECOMENDAMOS A REPETICAO DESTE EXAME APOS UMA SEMANA%",
    "1/%",
    "INFERIOR A 1/%",
    "SUPERIOR A 1/%",
]
FLEURY_BAD_IDS = ["6330770357_400", "2020054349_200", "2020055814_200", "8950225454_100"]


def fleury_result() -> Column:
    text = F.col("result")
    indexed = one_of("exame", *FLEURY_INDEX_EXAMS)
    number = indexed & text.rlike("^[0-9]+(,[0-9]+)?$")
    negative, positive = ([p for p, code in FLEURY_RESULTS if code == kind] for kind in (NEG, POS))
    return classify(
        [
            (text.rlike(prefix_pattern(negative)), NEG),
            (text.rlike(prefix_pattern(positive)), POS),
            (indexed & text.isin(*FLEURY_INDEX_BELOW), NEG),
            (number, band_result(comma_number(text), *FLEURY_INDEX_BAND, between=None)),
        ],
        vocab.UNRECOGNISED,
    )


def fleury_keep() -> Column:
    text = F.col("result")
    void = text.rlike(prefix_pattern([*FLEURY_VOID_RESULTS, *FLEURY_VOID_PATTERNS]))
    zika_index = one_of("pathogen", "ZIKA VIRUS - IGM", "ZIKA VIRUS - IGG") & text.rlike("^[0-9]+,[0-9]+$")
    return (
        F.col("date_testing").isNotNull()
        & text.isNotNull()
        & none_of("exame", FLEURY_RESPIRATORY)
        & ~void
        & none_of("test_id", FLEURY_BAD_IDS)
        & ~zika_index
    )


FLEURY = LabSpec(
    lab_id="FLEURY",
    columns={
        "test_id": "CODIGO REQUISICAO",
        "date_testing": "DATA COLETA",
        "patient_id": "PACIENTE",
        "sex": "SEXO",
        "age": "IDADE",
        "location": "MUNICIPIO",
        "state_code": "ESTADO",
        "exame": "EXAME",
        "pathogen": "PATOGENO",
        "result": "RESULTADO",
    },
    dates={"date_testing": ("d/M/yyyy",)},
    normalise=("pathogen", "result"),
    key=lambda: [F.col("test_id"), F.col("exame"), F.col("pathogen")],
    rules={
        "age": lambda: age_days_years("age"),
        "test_kit": lambda: lookup("pathogen", FLEURY_KITS, UNKNOWN_KIT),
        "result": fleury_result,
        "state": lambda: state_name("state_code"),
    },
    keep=fleury_keep,
    keep_fixed=lambda: F.col("result").isNotNull(),
    code="pathogen",
    codes=FLEURY_CODES,
    separator="\t",
    encoding="ISO-8859-1",
    glob="*.tsv",
)

# --- HILAB ----------------------------------------------------------------------------------
# Exams, kits, result words.
HILAB_KITS = {
    "Dengue IgM": "igm_serum",
    "Dengue IgG": "igg_serum",
    "Dengue NS1": "ns1_antigen",
    "Zika IgG": "igg_serum",
    "Zika IgM": "igm_serum",
}
HILAB_CODES = {
    "DENV": ["Dengue IgM", "Dengue IgG", "Dengue NS1"],
    "ZIKV": ["Zika IgG", "Zika IgM"],
}
HILAB_RESULTS = {"Não Reagente": NEG, "Reagente": POS}
HILAB_RESPIRATORY = ["Influenza A", "Influenza B", "Covid-19 Antígeno", "IgG", "IgM"]

HILAB = LabSpec(
    lab_id="HILAB",
    columns={
        "test_id": "Código Da Cápsula",
        "state_code": "Estado",
        "location": "Cidade",
        "date_testing": "Data Do Exame",
        "exame": "Exame",
        "result": "Resultado",
        "age": "Idade",
        "patient_id": "Paciente",
        "sex": "Sexo",
    },
    dates={"date_testing": ("d/M/yyyy",)},
    casts={"age": "int"},
    raw_filter=lambda: none_of("Exame", HILAB_RESPIRATORY) & none_of("Resultado", ["Inválido"]),
    key=lambda: [F.col("test_id"), F.col("exame"), F.col("patient_id")],
    first_line_only=True,
    rules={
        "location": lambda: drop_punctuation("location"),
        "test_kit": lambda: lookup("exame", HILAB_KITS),
        "result": lambda: lookup("result", HILAB_RESULTS),
        "state": lambda: state_name("state_code"),
        "age": lambda: plausible_age("age"),
        "sex": lambda: normalize_sex("sex"),
    },
    keep=lambda: ~F.col("exame").like("COVID%"),
    code="exame",
    codes=HILAB_CODES,
    single_line=True,
)

# --- HLAGYN ---------------------------------------------------------------------------------
# Result words and header variants.
HLAGYN_RESULTS = {"Detectado": POS, "Não Detectado": NEG}
HLAGYN_ALIASES = {
    "Cidade": ("Cidade (Inst Saúde)", "Cidade  (Inst Saúde)"),
    "UF": ("UF (Inst Saúde)", "UF  (Inst Saúde)"),
    "Zika vírus": ("VIRUS_ZIKA",),
    "Dengue vírus": ("VIRUS_DENGUE",),
    "Chikungunya vírus": ("VIRUS_CHIKU",),
}

HLAGYN = LabSpec(
    lab_id="HLAGYN",
    columns={
        "age": "Idade",
        "sex": "Sexo",
        "test_id": "Pedido",
        "date_testing": "Data Coleta",
        "zika_result": "Zika vírus",
        "dengue_result": "Dengue vírus",
        "chikungunya_result": "Chikungunya vírus",
        "location": "Cidade",
        "state_code": "UF",
    },
    dates={"date_testing": ("yyyy-M-d", "yyyy-MM-dd HH:mm:ss", "d/M/yyyy")},
    casts={"age": "int"},
    key=lambda: [F.col("test_id"), F.col("date_testing"), F.col("age"), F.col("sex")],
    rules={
        "sex": lambda: normalize_sex("sex"),
        "dengue_result": lambda: lookup("dengue_result", HLAGYN_RESULTS),
        "zika_result": lambda: lookup("zika_result", HLAGYN_RESULTS),
        "chikungunya_result": lambda: lookup("chikungunya_result", HLAGYN_RESULTS),
        "state": lambda: state_name("state_code"),
        "test_kit": lambda: F.lit("arbo_pcr_3"),
    },
    keep=lambda: any_present("zika_result", "dengue_result", "chikungunya_result"),
    wide={"DENV": "dengue_result", "ZIKV": "zika_result", "CHIKV": "chikungunya_result"},
    single_line=True,
    format="workbook",
    glob="*.xlsx",
    aliases=HLAGYN_ALIASES,
    tagged_prefix="Resultado",
)

# --- DBMOL ----------------------------------------------------------------------------------
DBMOL_MAYARO = "ESTUDO SOROLOGICO VIRUS MAYARO - ANTICORPOS IGG E IGM"
DBMOL_CHIK_BOTH = "ANTICORPOS ANTI CHIKUNGUNYA IGG E IGM"
# Exam -> kit, and the exams whose kit depends on the analyte.
DBMOL_KITS = {
    "ZIKA VIRUS DETECCAO POR PCR - PLASMA": "zikv_pcr",
    "ZIKA VIRUS ANTICORPOS IGM": "igm_serum",
    "ZIKA VIRUS ANTICORPOS IGG": "igg_serum",
    "PESQUISA MOLECULAR DO VIRUS CHIKUNGUNYA": "chikv_pcr",
    "PAINEL DE ARBOVIROSES (DENGUE, ZIKA E CHIKUNGUNYA)": "arbo_pcr_3",
    "DETECCAO MOLECULAR DO ZIKA VIRUS": "zikv_pcr",
    "DETECCAO E TIPAGEM DO VIRUS DA DENGUE": "denv_pcr",
    "DENGUE NS1": "ns1_antigen",
    "DENGUE - ANTICORPOS IGM": "igm_serum",
    "DENGUE - ANTICORPOS IGG": "igg_serum",
    "CHIKUNGUNYA VIRUS IGM": "igm_serum",
    "CHIKUNGUNYA VIRUS IGG": "igg_serum",
}
DBMOL_KITS_BY_ANALYTE = {
    DBMOL_MAYARO: {"IGG": "igg_serum", "IGM": "igm_serum"},
    DBMOL_CHIK_BOTH: {"AACHIG": "igg_serum", "AACHIM": "igm_serum"},
}
# Fixed values: (exam, analyte) -> analyte code used from here on.
DBMOL_RECODED = {
    (DBMOL_MAYARO, "IGG"): "MAYV_IGG",
    (DBMOL_MAYARO, "IGM"): "MAYV_IGM",
    ("CHIKUNGUNYA VIRUS IGM", "RESUL"): "CHIKV_IGM",
    ("CHIKUNGUNYA VIRUS IGG", "RESUL"): "CHIKV_IGG",
}
# Analytes per pathogen.
DBMOL_CODES = {
    "DENV": ["DENGG", "DENGM", "DENGUE", "DNS1", "TDENGE"],
    "ZIKV": ["ZICAG", "ZICAM", "ZIKA", "ZIKAP", "ZIKAV"],
    "CHIKV": ["AACHIG", "AACHIM", "CHIKUN", "CHIKV", "CHIKV_IGG", "CHIKV_IGM"],
    "MAYV": ["MAYV_IGG", "MAYV_IGM"],
}
# How each group of analytes reports.
DBMOL_INDEXED = ["DENGM", "DENGG", "AACHIG", "AACHIM", "ZICAM", "ZICAG", "CHIKUNG"]
DBMOL_INDEXED_EXAMS = ["CHIKUNGUNYA VIRUS IGM", "CHIKUNGUNYA VIRUS IGG"]
DBMOL_WORDED = ["DNS1", "ZIKA", "TDENGE", "CHIKV", "ZIKAP"]
DBMOL_PANEL = "PAINEL DE ARBOVIROSES%"
DBMOL_PANEL_ANALYTES = ["CHIKUN", "DENGUE", "ZIKAV"]
DBMOL_BAND = (0.80, 1.00)
DBMOL_BELOW = "INFERIOR A %"
DBMOL_WORDS = {
    "POSITIVO": POS,
    "POSITIVA": POS,
    "DETECTADO": POS,
    "NEGATIVO": NEG,
    "NEGATIVA": NEG,
    "NAO DETECTADO": NEG,
}
DBMOL_MAYARO_WORDS = {"POSITIVO": POS, "DETECTADO": POS, "NEGATIVO": NEG, "NAO DETECTADO": NEG}
# Procedures used, analytes and results left out.
DBMOL_PROCEDURES = [
    "DENGM", "DENGG", "AACHI", "ZICAM", "ZICAG", "DNS1", "CHIKUNM", "CHIKUNG", "PZDC", "ZIKAP", "CHIKV",
    "MAYA", "TDENGE", "ZIKA",
]
DBMOL_OTHER_ANALYTES = ["MAT", "MATERIAL", "METODO", "SOROTI", "TITG", "TITM"]


def dbmol_kit() -> Column:
    nested = [
        (F.col("exame") == exam, lookup("detalhe_exame", kits, UNKNOWN_KIT))
        for exam, kits in DBMOL_KITS_BY_ANALYTE.items()
    ]
    return classify(nested, lookup("exame", DBMOL_KITS, UNKNOWN_KIT))


def dbmol_analyte() -> Column:
    recoded = [
        ((F.col("exame") == exam) & (F.col("detalhe_exame") == analyte), code)
        for (exam, analyte), code in DBMOL_RECODED.items()
    ]
    return classify(recoded, F.col("detalhe_exame"))


def dbmol_result() -> Column:
    text, unknown = F.col("result"), vocab.UNRECOGNISED
    number = text.try_cast("double")
    by_index = classify(
        [
            (text.rlike("^[0-9]"), band_result(number, *DBMOL_BAND, vocab.INDETERMINATE, unknown)),
            (text.ilike(DBMOL_BELOW), NEG),
        ],
        unknown,
    )
    mayaro = classify([(text.ilike(DBMOL_BELOW), NEG)], lookup(text, DBMOL_MAYARO_WORDS, unknown))
    indexed = one_of("detalhe_exame", *DBMOL_INDEXED) | (
        one_of("exame", *DBMOL_INDEXED_EXAMS) & (F.col("detalhe_exame") == "RESUL")
    )
    worded = one_of("detalhe_exame", *DBMOL_WORDED) | (
        no_case("exame", DBMOL_PANEL) & one_of("detalhe_exame", *DBMOL_PANEL_ANALYTES)
    )
    return classify(
        [
            (indexed, by_index),
            (worded, lookup(text, DBMOL_WORDS, unknown)),
            (F.col("exame") == DBMOL_MAYARO, mayaro),
        ],
        unknown,
    )


DBMOL = LabSpec(
    lab_id="DBMOL",
    columns={
        "test_id": "NumeroPedido",
        "sex": "Sexo",
        "exame": "Procedimento",
        "procedure": "CodigoProcedimento",
        "detalhe_exame": "Parametro",
        "date_testing": "DataCadastro",
        "birth_date": "DataNascimento",
        "location": "Cidade",
        "state": "UF",
        "result": "Resultado",
    },
    dates={"date_testing": ("yyyy-M-d",), "birth_date": ("yyyy-M-d",)},
    ids=("test_id",),
    normalise=("exame", "procedure", "detalhe_exame", "result"),
    key=lambda: [
        F.col("test_id"),
        F.col("exame"),
        F.when(one_of("exame", *DBMOL_KITS_BY_ANALYTE), F.col("detalhe_exame")).otherwise(""),
    ],
    rules={
        "sex": lambda: F.when(one_of("sex", "F", "M"), F.col("sex")),
        "age": lambda: plausible_age(completed_years("date_testing", "birth_date"), low=None),
        "test_kit": dbmol_kit,
        "detalhe_exame": dbmol_analyte,
        "state": lambda: state_name("state", unknown="missing"),
        "result": dbmol_result,
    },
    keep=lambda: one_of("procedure", *DBMOL_PROCEDURES)
    & none_of("detalhe_exame", DBMOL_OTHER_ANALYTES)
    & none_of("result", ["RESULTADO CONFERIDO E LIBERADO."])
    & ~no_case("result", "%RESULTADO FORMATADO%"),
    keep_fixed=lambda: F.col("result") != vocab.INDETERMINATE,
    code="detalhe_exame",
    codes=DBMOL_CODES,
)

# --- HPARDINI -------------------------------------------------------------------------------
# Fixed values: (pathogen, method) -> kit, result words, respiratory pathogens.
HPARDINI_KITS = {
    ("DENV", "IMUNOENSAIO ENZIMATICO"): "denv_serum",
    ("DENV", "IMUNOCROMATOGRAFIA"): "ns1_antigen",
    ("DENV", "PCR EM TEMPO REAL"): "denv_pcr",
    ("CHIKV", "PCR EM TEMPO REAL"): "chikv_pcr",
}
HPARDINI_RESULTS = {"POSITIVO": POS, "NEGATIVO": NEG}
HPARDINI_RESPIRATORY = ["SARS-COV-2", "INFLUENZA B", "INFLUENZA A", "RSV"]

HPARDINI = LabSpec(
    lab_id="HPARDINI",
    columns={
        "test_id": "CODIGO",
        "date_testing": "DATACOLETA",
        "pathogen": "PATÓGENO",
        "detalhe_exame": "MÉTODO",
        "location": "CIDADE",
        "state": "UF",
        "sex": "SEXO",
        "age": "IDADE",
        "result": "RESULTADO",
    },
    dates={"date_testing": ("yyyy-M-d", "yyyy-MM-dd HH:mm:ss", "d/M/yyyy")},
    casts={"age": "bigint"},
    normalise=("pathogen", "detalhe_exame", "location", "state", "result"),
    key=lambda: [F.col("test_id")],
    rules={
        "sex": lambda: normalize_sex("sex"),
        "age": lambda: plausible_age("age").cast("int"),
        # Unknown abbreviations become NOT REPORTED.
        "state": lambda: state_name("state", unknown="missing"),
        "result": lambda: lookup("result", HPARDINI_RESULTS),
        "test_kit": lambda: classify(
            [
                ((F.col("pathogen") == pathogen) & (F.col("detalhe_exame") == method), kit)
                for (pathogen, method), kit in HPARDINI_KITS.items()
            ],
            UNKNOWN_KIT,
        ),
    },
    keep=lambda: none_of("pathogen", HPARDINI_RESPIRATORY) & none_of("result", ["INCONCLUSIVO"]),
    code="pathogen",
    codes={"DENV": ["DENV"], "CHIKV": ["CHIKV"]},
    separator=";",
    encoding="ISO-8859-1",
)

# --- TARGET ---------------------------------------------------------------------------------
# Exam -> kit, analytes, result words, respiratory exams.
TARGET_KITS = {"DENVQL": "denv_pcr", "CHIKVQL": "chikv_pcr", "ZIKVQL": "zikv_pcr", "PMDZC": "arbo_pcr_3"}
TARGET_CODES = {"DENV": ["RES1", "DENV"], "ZIKV": ["ZIKV"], "CHIKV": ["CHIKV"]}
TARGET_RESULTS = {"NAO DETECTADO": NEG, "DETECTADO": POS}
TARGET_RESPIRATORY = ["RESCAP02", "COV19SWI", "COVID19", "COVID19U", "RESCAP04", "COV19LVI"]

TARGET = LabSpec(
    lab_id="TARGET",
    columns={
        "test_id": "Numerdo do Pedido",
        "sample_code": "Código da Amostra",
        "date_testing": "Data de Coleta",
        "sex": "Sexo",
        "age": "Idade",
        "location": "Município",
        "state_code": "Estado",
        "exame": "Exame",
        "exam_name": "Nome exame",
        "detalhe_exame": "Cód. Pátógeno",
        "pathogen": "Patógeno",
        "result": "Resultado",
    },
    dates={"date_testing": ("d/M/yyyy",)},
    ids=("test_id", "sample_code"),
    normalise=("age", "location", "state_code", "exame", "exam_name", "pathogen", "result"),
    key=lambda: [F.col("test_id"), F.col("exame")],
    rules={
        "age": lambda: age_units("age"),
        "state": lambda: state_name("state_code"),
        "test_kit": lambda: lookup("exame", TARGET_KITS),
        "result": lambda: lookup("result", TARGET_RESULTS),
    },
    keep=lambda: none_of("exame", TARGET_RESPIRATORY),
    code="detalhe_exame",
    codes=TARGET_CODES,
)

FEEDS = {s.lab_id: s for s in [EINSTEIN, SABIN, FLEURY, HILAB, HLAGYN, DBMOL, HPARDINI, TARGET]}

# --- case estimates -------------------------------------------------------------------------
# Canonical name -> (raw header, type).
ESTIMATE_COLUMNS = {
    "SE": ("SE", "string"),
    "casos_estimados": ("casos_est", "int"),
    "casos_est_min": ("casos_est_min", "int"),
    "casos_est_max": ("casos_est_max", "int"),
    "casos_confirmados": ("casos", "int"),
    "disease": ("disease", "string"),
    "city": ("city", "string"),
    "city_ibge_code": ("city_ibge_code", "string"),
    "state_code": ("state_code", "string"),
    "state": ("state", "string"),
    "region": ("region", "string"),
    "data_iniSE": ("data_iniSE", "date"),
    "data_fimSE": ("data_fimSE", "date"),
    "file_name": ("file_name", "string"),
}
ESTIMATE_KEYS = ["SE", "city_ibge_code", "state_code", "disease"]
