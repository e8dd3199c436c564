"""The eight feeds, the case estimates, the generic feed steps and the combined plan.

Each feed reads raw rows in its own delivery format, derived from the order lines, and its SQL twin
states the cleaned rows directly from the same lines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.catalog.base import Tables, query
from labwatch.catalog.bridge import (
    AS_OF,
    SAMPLE_COLUMNS,
    SHIFT,
    STAMP,
    WIDE_SQL,
    case_sql,
    coded_lines,
    collapse_sql,
    combined,
    dimensions,
    list_sql,
    one_hot_sql,
    raw_estimates,
    samples,
    sql,
    wide_lines,
)
from labwatch.feeds import labs
from labwatch.feeds.labs import FEEDS, ESTIMATE_KEYS
from labwatch.feeds.runner import run_feed, stamp
from labwatch.feeds.spec import LabSpec
from labwatch.functions import text as X
from labwatch.operators import windows as W
from labwatch.operators.merge import FeedsOfTable, upsert
from labwatch.operators.shaping import one_hot
from labwatch.plans import combine as C
from labwatch.schema import CARRIED, LAB_COLUMNS
from labwatch.session import stored_by
from labwatch.sources.readers import cast_estimates

DAY = f"(cast(l_shipdate as date) + {SHIFT})"
BORN = "cast(o_orderdate as date)"
STATE_CODE = {
    "expr": "CASE c_nationkey % 7 WHEN 0 THEN 'SP' WHEN 1 THEN 'RJ' WHEN 2 THEN 'XX' WHEN 3 THEN 'AM' WHEN 4 THEN 'GO' WHEN 5 THEN NULL ELSE 'PA' END",
    "names": {"SP": "SAO PAULO", "RJ": "RIO DE JANEIRO", "AM": "AMAZONAS", "GO": "GOIAS", "PA": "PARA"},
}
SEX = "CASE o_custkey % 4 WHEN 0 THEN 'Feminino' WHEN 1 THEN 'masculino' WHEN 2 THEN 'M' ELSE NULL END"
FILE = "concat('feed_', cast(l_suppkey % 5 as string), '.csv')"
QTY = "cast(cast(l_quantity as int) as string)"
# Text around a place that cleaning removes.
PLACE = "concat(c_mktsegment, ' d''Óeste, ', cast(c_nationkey as string))"
PLAIN_PLACE = "concat(c_mktsegment, ' DOESTE ', cast(c_nationkey as string))"


def dmy(day: str) -> str:
    iso = f"cast({day} as string)"
    return f"concat(substr({iso}, 9, 2), '/', substr({iso}, 6, 2), '/', substr({iso}, 1, 4))"


def mdy(day: str) -> str:
    iso = f"cast({day} as string)"
    return f"concat(substr({iso}, 6, 2), '/', substr({iso}, 9, 2), '/', substr({iso}, 1, 4))"


def pick(column: str, *values: str | None) -> str:
    """One of the texts, by a number column."""
    n = len(values)
    cases = " ".join(f"WHEN {i} THEN {_text(v)}" for i, v in enumerate(values[:-1]))
    return f"CASE {column} % {n} {cases} ELSE {_text(values[-1])} END"


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


# Raw header -> expression over the joined lines, per feed.
RAW: dict[str, dict[str, str]] = {
    "EINSTEIN": {
        "accession": "concat('0', cast(l_orderkey as string))",
        "sexo": SEX,
        "idade": QTY,
        "exame": "CASE p_type WHEN 'STANDARD' THEN 'PCR Multiplex Zika, Dengue e Chikungunya' ELSE concat('SOROLOGIA ', p_type) END",
        "detalhe_exame": f"""CASE p_type WHEN 'STANDARD' THEN {pick("l_linenumber", "Vírus Dengue:", "Vírus Zika:", "Vírus Chikungunya:")}
            WHEN 'ECONOMY' THEN 'Dengue IgG' WHEN 'PROMO' THEN 'DENGUE IGM, TESTE RÁPIDO' WHEN 'MEDIUM' THEN 'NS1 Euroimmun'
            WHEN 'SMALL' THEN 'ANTÍGENO NS1 DO VIRUS DA DENGUE' ELSE 'Outro' END""",
        "dh_coleta": f"CASE WHEN l_partkey % 2 = 0 THEN {dmy(DAY)} ELSE concat(cast({DAY} as string), ' 00:00:00') END",
        "municipio": PLACE,
        "estado": "concat('São ', cast(c_nationkey as string), '.')",
        "patogeno": "p_brand",
        "resultado": pick("ascii(l_returnflag)", "DETECTADO", "NÃO DETECTADO", "INCONCLUSIVO"),
    },
    "SABIN": {
        "OS": "cast(l_orderkey as string)",
        "Estado": "concat('São ', cast(c_nationkey as string), '.')",
        "Municipio": PLACE,
        "DataAtendimento": mdy(DAY),
        "DataNascimento": mdy(BORN),
        "Sexo": SEX,
        "Descricao": f"""CASE p_type WHEN 'STANDARD' THEN 'PCR PARA ZIKA, Chikungunya e Dengue'
            WHEN 'MEDIUM' THEN {pick("p_size", "DETECÇÃO MOLECULAR DO VÍRUS DENGUE ", "DETECÇÃO E TIPAGEM DO VÍRUS DA DENGUE",
                                     "DETECÇÃO MOLECULAR DO VÍRUS DENGUE COM GENOTIPAGEM")}
            WHEN 'SMALL' THEN {pick("p_size", "FEBRE AMARELA PCR", "PAINEL MOLECULAR PARA DENGUE E OUTROS")}
            ELSE concat('Sorologia ', p_type) END""",
        "Parametro": f"""CASE p_type WHEN 'STANDARD' THEN {pick("l_linenumber", "PCRCHIK", "PCRDE", "VIRUSZICA")}
            WHEN 'MEDIUM' THEN {pick("p_size", "PCRDE", "PCRD", "DENV")}
            WHEN 'SMALL' THEN {pick("p_size", "YFV", "YFV", "MAYARO", "OROVPCR", "ZIKAV", "PCRCHIKCT")}
            WHEN 'PROMO' THEN {pick("l_linenumber", "NS1ELISA", "NS1IMUNOCRO")}
            WHEN 'ECONOMY' THEN {pick("l_linenumber", "DENGIGG", "DENGUEGI", "DENGIGG", "DENGUEMIC", "ZIKAM1")}
            ELSE {pick("l_linenumber", "DENV1", "FEBREGLC", "TITMAYIGM", "RCHIKUNGMELISAIGG")} END""",
        "Resultado": f"""CASE l_returnflag WHEN 'A' THEN {pick("l_suppkey", " Detectado", "reagente", "REAGENTE 1:200", "1,2", "0,85", "Detectável", "REAGENTE FRACO")}
            WHEN 'N' THEN {pick("l_suppkey", "Não Detectado", "NÃO REAGENTE ", ",5", "0,79", "INFERIOR A 2", "'")}
            ELSE {pick("l_suppkey", "Inconclusivo", "1:200", None, "TESTE", "ilegível")} END""",
    },
    "FLEURY": {
        "CODIGO REQUISICAO": "concat(cast(l_orderkey as string), '_', cast(l_suppkey % 2 as string))",
        "DATA COLETA": f"CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE {dmy(DAY)} END",
        "PACIENTE": "concat('P', cast(o_custkey as string))",
        "SEXO": "CASE o_custkey % 3 WHEN 0 THEN 'F' ELSE 'M' END",
        "IDADE": f"""CASE l_linenumber % 6 WHEN 0 THEN {QTY} WHEN 1 THEN concat({QTY}, 'A') WHEN 2 THEN concat({QTY}, 'A10M')
            WHEN 3 THEN concat({QTY}, 'A5D') WHEN 4 THEN concat({QTY}, 'M') ELSE NULL END""",
        "MUNICIPIO": "c_mktsegment",
        "ESTADO": STATE_CODE["expr"],
        "EXAME": "CASE p_type WHEN 'ECONOMY' THEN 'DENGUEG' WHEN 'PROMO' THEN 'DENGUENS1' WHEN 'LARGE' THEN "
        + pick("p_size", "2019NCOV", "ARBOPCR", "MAYAROG")
        + " ELSE concat('EX', p_type) END",
        "PATOGENO": f"""CASE p_type WHEN 'ECONOMY' THEN {pick("l_linenumber", "Dengue, IgG", "Dengue, IgM ")} WHEN 'PROMO' THEN ' Dengue, NS1'
            WHEN 'STANDARD' THEN {pick("p_size", "Zika Vírus - IgM", "Zika Vírus, detecção no RNA")}
            WHEN 'MEDIUM' THEN {pick("p_size", "Chikungunya, PCR", "Febre Amarela, PCR", "Oropouche, Anticorpos, IgM")}
            WHEN 'SMALL' THEN 'Mayaro, Detecção do RNA por PCR' ELSE 'Outro' END""",
        "RESULTADO": f"""CASE l_returnflag WHEN 'A' THEN {pick("l_suppkey", "Reagente", "Detectado (Positivo)", "1,5", "Positivo", "detectável")}
            WHEN 'N' THEN {pick("l_suppkey", "Não reagente", "0,5", "Inferior a 0,9", "Indetectável", "Negativo")}
            ELSE {pick("l_suppkey", "Indeterminado", "1,0", "1/40", None, "ilegível")} END""",
    },
    "HILAB": {
        "Código Da Cápsula": "cast(l_orderkey as string)",
        "Estado": STATE_CODE["expr"],
        "Cidade": PLACE,
        "Data Do Exame": dmy(DAY),
        "Exame": """CASE p_type WHEN 'STANDARD' THEN 'Dengue IgM' WHEN 'ECONOMY' THEN 'Dengue IgG' WHEN 'PROMO' THEN 'Dengue NS1'
            WHEN 'MEDIUM' THEN 'Zika IgG' WHEN 'SMALL' THEN 'Influenza A' ELSE 'COVID-19' END""",
        "Resultado": pick("ascii(l_returnflag)", "Reagente", "Não Reagente", "Inválido"),
        "Idade": "cast(cast(l_quantity * 3 as int) - 10 as string)",
        "Paciente": "concat('P', cast(o_custkey as string))",
        "Sexo": SEX,
    },
    "HLAGYN": {
        "Idade": QTY,
        "Sexo": SEX,
        "Pedido": "cast(l_orderkey as string)",
        "Data Coleta": f"cast({DAY} as string)",
        "Zika vírus": pick("l_partkey", "Detectado", "Não Detectado", None),
        "Dengue vírus": pick("l_suppkey", "Detectado", "Não Detectado", "ND", None),
        "Chikungunya vírus": pick("l_linenumber", "Não Detectado", "Detectado", None),
        "Cidade": "c_mktsegment",
        "UF": STATE_CODE["expr"],
    },
    "DBMOL": {
        "NumeroPedido": "concat('00', cast(l_orderkey as string))",
        "Sexo": "CASE o_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE 'I' END",
        "Procedimento": f"""CASE p_type WHEN 'STANDARD' THEN 'Painel de Arboviroses (Dengue, Zika e Chikungunya)'
            WHEN 'ECONOMY' THEN 'Dengue - Anticorpos IgG' WHEN 'PROMO' THEN 'Dengue NS1'
            WHEN 'MEDIUM' THEN 'Estudo Sorológico Vírus Mayaro - Anticorpos IgG e IgM'
            WHEN 'SMALL' THEN 'Anticorpos anti Chikungunya IgG e IgM' ELSE {pick("p_size", "Chikungunya vírus IgM", "Covid")} END""",
        "CodigoProcedimento": f"""CASE p_type WHEN 'STANDARD' THEN 'PZDC' WHEN 'ECONOMY' THEN 'DENGG' WHEN 'PROMO' THEN 'DNS1'
            WHEN 'MEDIUM' THEN 'MAYA' WHEN 'SMALL' THEN 'AACHI' ELSE {pick("p_size", "CHIKUNM", "COVID")} END""",
        "Parametro": f"""CASE p_type WHEN 'STANDARD' THEN {pick("l_linenumber", "Dengue", "ZikaV", "Chikun")} WHEN 'ECONOMY' THEN 'DengG'
            WHEN 'PROMO' THEN 'DNS1' WHEN 'MEDIUM' THEN {pick("l_linenumber", "IgG", "IgM", "Material")}
            WHEN 'SMALL' THEN {pick("l_linenumber", "AACHIG", "AACHIM", "Outro")} ELSE 'RESUL' END""",
        "DataCadastro": f"cast({DAY} as string)",
        "DataNascimento": f"cast({BORN} - 36000 + cast(l_suppkey as int) as string)",
        "Cidade": "c_mktsegment",
        "UF": STATE_CODE["expr"],
        "Resultado": f"""CASE l_returnflag WHEN 'A' THEN {pick("l_suppkey", "Positivo", "Detectado", "1.5", "positiva")}
            WHEN 'N' THEN {pick("l_suppkey", "Negativo", "Não detectado", "0.5", "Inferior a 0.8", "1.00")}
            ELSE {pick("l_suppkey", "0.9", "Resultado conferido e liberado.", "xx resultado formatado xx", None, "0,9")} END""",
    },
    "HPARDINI": {
        "CODIGO": "concat(cast(l_orderkey as string), '-', cast(l_suppkey % 3 as string))",
        "DATACOLETA": f"CASE WHEN l_partkey % 2 = 0 THEN {dmy(DAY)} ELSE cast({DAY} as string) END",
        "PATÓGENO": pick("l_partkey", "denv", "chikv", "DENV", "Sars-Cov-2", "zikv"),
        "MÉTODO": pick("l_linenumber", "Imunoensaio Enzimático", "Imunocromatografia", "PCR em Tempo Real"),
        "CIDADE": "concat(' ', lower(c_mktsegment))",
        "UF": STATE_CODE["expr"],
        "SEXO": SEX,
        "IDADE": "cast(cast(l_quantity * 3 as int) - 10 as string)",
        "RESULTADO": pick("ascii(l_returnflag)", "Positivo", "negativo", "Inconclusivo"),
    },
    "TARGET": {
        "Numerdo do Pedido": "concat('00', cast(l_orderkey as string))",
        "Código da Amostra": "cast(l_partkey as string)",
        "Data de Coleta": dmy(DAY),
        "Sexo": "CASE o_custkey % 3 WHEN 0 THEN 'F' ELSE 'M' END",
        "Idade": f"""CASE l_linenumber % 6 WHEN 0 THEN {QTY} WHEN 1 THEN concat({QTY}, 'a') WHEN 2 THEN concat({QTY}, 'A10M')
            WHEN 3 THEN concat({QTY}, 'M10D') WHEN 4 THEN concat({QTY}, 'D') ELSE NULL END""",
        "Município": "concat(' ', lower(c_mktsegment))",
        "Estado": f"lower({STATE_CODE['expr']})",
        "Exame": """CASE p_type WHEN 'STANDARD' THEN 'pmdzc' WHEN 'ECONOMY' THEN 'DenvQL' WHEN 'PROMO' THEN 'CHIKVQL'
            WHEN 'MEDIUM' THEN 'ZIKVQL' WHEN 'SMALL' THEN 'Covid19' ELSE 'OUTRO' END""",
        "Nome exame": "p_name",
        "Cód. Pátógeno": f"""CASE p_type WHEN 'STANDARD' THEN {pick("l_linenumber", "DENV", "ZIKV", "CHIKV")} WHEN 'ECONOMY' THEN 'RES1'
            WHEN 'PROMO' THEN 'CHIKV' ELSE 'ZIKV' END""",
        "Patógeno": "p_brand",
        "Resultado": pick("ascii(l_returnflag)", "Detectado", "Não detectado", "Repetir"),
    },
}


def raw_feed(t: Tables, lab: str):
    """The delivery as plain columns, as if read from files."""
    columns = [F.expr(e).alias(h) for h, e in RAW[lab].items()]
    return wide_lines(t).select(F.inline(F.array(F.struct(*columns, F.expr(FILE).alias("file_name")))))


def raw_sql(spec: LabSpec) -> str:
    exprs = RAW[spec.lab_id]
    parts = [f'{exprs[header]} AS {name}_' for name, header in spec.columns.items()]
    distinct = "DISTINCT " if spec.distinct_raw else ""
    return f"SELECT {distinct}{', '.join(parts)}, {DAY} AS day_, {BORN} AS born_, {FILE} AS file_name FROM {WIDE_SQL}"


def plain(column: str) -> str:
    return rf"trim(trim(upper(strip_accents({column})), ' '), '\t')"


def bare(column: str) -> str:
    return rf"regexp_replace(upper(strip_accents({column})), '[^\w\s]', '', 'g')"


def years(later: str, earlier: str) -> str:
    def number(d: str) -> str:
        return f"CAST(strftime({d}, '%Y%m%d') AS INTEGER)"

    return f"(({number(later)} - {number(earlier)}) // 10000)"


def first_letter_sex(column: str, other: str = "NULL") -> str:
    return f"CASE upper(left({column}, 1)) WHEN 'F' THEN 'F' WHEN 'M' THEN 'M' ELSE {other} END"


STATE_OR_NULL = case_sql("state_code_", STATE_CODE["names"])

# Cleaned rows of each feed: sample_id, the carried columns, code and result.
FIXED: dict[str, str] = {
    "EINSTEIN": f"""SELECT md5(concat(test_id_, exame_, CASE WHEN lower(exame_) = 'pcr multiplex zika, dengue e chikungunya'
            THEN 'MULTIPLEX' ELSE detalhe_exame_ END)) AS sample_id, test_id_ AS test_id,
        {case_sql("upper(detalhe_exame_)", labs.EINSTEIN_KITS, "'UNKNOWN'")} AS test_kit,
        {first_letter_sex("sex_", "'UNKNOWN'")} AS sex, CAST(age_ AS INTEGER) AS age, {bare("location_")} AS location,
        day_ AS date_testing, {bare("state_")} AS state, CAST(NULL AS VARCHAR) AS patient_id, file_name,
        upper(detalhe_exame_) AS code, CASE result_ WHEN 'DETECTADO' THEN 1 WHEN 'NÃO DETECTADO' THEN 0 END AS result
        FROM raw WHERE test_id_ <> '2024234005520' AND day_ >= DATE '2025-08-01'""",
    "SABIN": f"""SELECT md5(concat(test_id_, exame_, CASE WHEN lower(exame_) = 'pcr para zika, chikungunya e dengue'
            THEN 'MULTIPLEX' ELSE detalhe_exame_ END)) AS sample_id, test_id_ AS test_id,
        CASE WHEN code IN ('PCRCHIK', 'PCRDE', 'VIRUSZICA') AND lower(exame_) = 'pcr para zika, chikungunya e dengue' THEN 'arbo_pcr_3'
            WHEN code IN ({list_sql(labs.SABIN_IGG)}) THEN 'igg_serum' WHEN code IN ({list_sql(labs.SABIN_IGM)}) THEN 'igm_serum'
            WHEN code IN ('NS1ELISA', 'NS1IMUNOCRO') THEN 'ns1_antigen'
            WHEN {" OR ".join(f"(code = '{c}' AND exame_ ILIKE '{e}')" for c, e in labs.SABIN_DENV_PCR)} THEN 'denv_pcr'
            WHEN code IN ({list_sql(labs.SABIN_CHIKV_PCR)}) THEN 'chikv_pcr' WHEN code IN ('ZIKAPCRBIO', 'ZIKAV') THEN 'zikv_pcr'
            WHEN code = 'OROVPCR' THEN 'orov_pcr' WHEN code IN ('RESMAYARO', 'MAYARO') THEN 'mayv_pcr'
            WHEN code = 'YFV' AND exame_ = 'FEBRE AMARELA PCR' THEN 'yfv_pcr' ELSE 'UNKNOWN' END AS test_kit,
        {first_letter_sex("sex_")} AS sex, {years("day_", "born_")} AS age, {bare("location_")} AS location,
        day_ AS date_testing, {bare("state_")} AS state, CAST(NULL AS VARCHAR) AS patient_id, file_name, code,
        CASE WHEN word IN ({list_sql(labs.SABIN_POSITIVE)}) THEN 1 WHEN word IN ({list_sql(labs.SABIN_NEGATIVE)}) THEN 0
            WHEN regexp_matches(word, '^[0-9]') THEN CASE WHEN try_cast(regexp_replace(word, ',', '.') AS DOUBLE) < 0.8 THEN 0
                WHEN try_cast(regexp_replace(word, ',', '.') AS DOUBLE) >= 0.8 THEN 1 ELSE -2 END
            WHEN regexp_matches(word, '^[,.]') THEN CASE WHEN CAST(substr(word, 2) AS DOUBLE) / 100 < 0.8 THEN 0 ELSE 1 END
            WHEN day_ < DATE '2024-01-01' AND word LIKE 'INFERIOR A%' THEN 0
            WHEN day_ < DATE '2024-01-01' AND word LIKE 'REAGEN%' THEN 1 ELSE -2 END AS result
        FROM (SELECT *, detalhe_exame_ AS code, strip_accents(upper(trim(result_, ' '))) AS word FROM raw)
        WHERE word NOT IN ({list_sql(labs.SABIN_VOID_RESULTS)}) AND NOT (code = 'YFV' AND exame_ ILIKE 'PAINEL MOLECULAR PARA DENGUE %')
            AND code NOT IN ('DENV1', 'FEBREGLC', 'TITMAYIGM')""",
    "FLEURY": f"""SELECT md5(concat(test_id_, exame_, code)) AS sample_id, test_id_ AS test_id,
        {case_sql("code", labs.FLEURY_KITS, "'UNKNOWN'")} AS test_kit, sex_ AS sex,
        CASE WHEN age_ LIKE '%D' THEN 0 WHEN strpos(age_, 'A') > 0 THEN CAST(split_part(age_, 'A', 1) AS INTEGER)
            ELSE try_cast(age_ AS INTEGER) END AS age,
        location_ AS location, day_ AS date_testing, {STATE_OR_NULL} AS state, patient_id_ AS patient_id, file_name, code, result
        FROM (SELECT *, CASE WHEN word IN ('INDETECTAVEL', 'NAO DETECTADO (NEGATIVO)', 'NEGATIVO') OR word LIKE 'NAO REAGENT%' THEN 0
            WHEN word IN ('DETECTADO (POSITIVO)', 'POSITIVO', 'DETECTAVEL') OR word LIKE 'REAGENT%' THEN 1
            WHEN exame_ IN ('DENGUEG', 'DENGUEM', 'DENGUENS1') THEN CASE WHEN word IN ('INFERIOR A 0,9', 'INFERIOR A 0,5') THEN 0
                WHEN number < 0.9 THEN 0 WHEN number > 1.1 THEN 1 WHEN number IS NOT NULL THEN NULL ELSE -2 END
            ELSE -2 END AS result
            FROM (SELECT *, try_cast(replace(word, ',', '.') AS DOUBLE) AS number FROM (
                SELECT *, {plain("pathogen_")} AS code, {plain("result_")} AS word FROM raw)))
        WHERE result IS NOT NULL AND date_testing_ IS NOT NULL AND exame_ <> '2019NCOV'
            AND word NOT IN ('INDETERMINADO') AND word NOT LIKE '1/%' AND NOT (code = 'ZIKA VIRUS - IGM' AND number IS NOT NULL AND strpos(word, ',') > 0)""",
    "HILAB": f"""SELECT md5(concat(test_id_, exame_, patient_id_)) AS sample_id, test_id_ AS test_id,
        {case_sql("exame_", labs.HILAB_KITS)} AS test_kit, {first_letter_sex("sex_")} AS sex,
        CASE WHEN n BETWEEN 0 AND 120 THEN n END AS age, {bare("location_")} AS location, day_ AS date_testing,
        {STATE_OR_NULL} AS state, patient_id_ AS patient_id, file_name, exame_ AS code,
        CASE result_ WHEN 'Reagente' THEN 1 WHEN 'Não Reagente' THEN 0 END AS result
        FROM (SELECT *, CAST(age_ AS INTEGER) AS n, row_number() OVER (PARTITION BY md5(concat(test_id_, exame_, patient_id_))
            ORDER BY test_id_ NULLS FIRST, state_code_ NULLS FIRST, location_ NULLS FIRST, day_ NULLS FIRST, exame_ NULLS FIRST,
                result_ NULLS FIRST, CAST(age_ AS INTEGER) NULLS FIRST, patient_id_ NULLS FIRST, sex_ NULLS FIRST, file_name) AS line
            FROM raw WHERE exame_ <> 'Influenza A' AND result_ <> 'Inválido')
        WHERE line = 1 AND exame_ NOT LIKE 'COVID%'""",
    "DBMOL": f"""SELECT md5(concat(test_id, exam, CASE WHEN exam IN ({list_sql(labs.DBMOL_KITS_BY_ANALYTE)}) THEN analyte ELSE '' END)) AS sample_id,
        test_id, CASE WHEN exam = '{labs.DBMOL_MAYARO}' THEN CASE analyte WHEN 'IGG' THEN 'igg_serum' WHEN 'IGM' THEN 'igm_serum' ELSE 'UNKNOWN' END
            WHEN exam = '{labs.DBMOL_CHIK_BOTH}' THEN CASE analyte WHEN 'AACHIG' THEN 'igg_serum' WHEN 'AACHIM' THEN 'igm_serum' ELSE 'UNKNOWN' END
            ELSE {case_sql("exam", labs.DBMOL_KITS, "'UNKNOWN'")} END AS test_kit,
        CASE WHEN sex_ IN ('F', 'M') THEN sex_ END AS sex,
        CASE WHEN {years("day_", "birth")} <= 120 THEN {years("day_", "birth")} END AS age,
        location_ AS location, day_ AS date_testing, {case_sql("state_", STATE_CODE["names"], "'NOT REPORTED'")} AS state,
        CAST(NULL AS VARCHAR) AS patient_id, file_name,
        CASE WHEN exam = '{labs.DBMOL_MAYARO}' AND analyte IN ('IGG', 'IGM') THEN concat('MAYV_', analyte)
            WHEN exam LIKE 'CHIKUNGUNYA VIRUS IG_' AND analyte = 'RESUL' THEN concat('CHIKV_', right(exam, 3)) ELSE analyte END AS code, result
        FROM (SELECT *, CASE WHEN analyte IN ('DENGG', 'AACHIG', 'AACHIM') OR (exam = 'CHIKUNGUNYA VIRUS IGM' AND analyte = 'RESUL')
                THEN CASE WHEN number < 0.8 THEN 0 WHEN number <= 1.0 THEN -3 WHEN number > 1.0 THEN 1 WHEN word LIKE 'INFERIOR A %' THEN 0 ELSE -2 END
            WHEN analyte = 'DNS1' OR (exam LIKE 'PAINEL DE ARBOVIROSES%' AND analyte IN ('CHIKUN', 'DENGUE', 'ZIKAV'))
                THEN {case_sql("word", labs.DBMOL_WORDS, "-2")}
            WHEN exam = '{labs.DBMOL_MAYARO}' THEN CASE WHEN word LIKE 'INFERIOR A %' THEN 0 WHEN word IN ('POSITIVO', 'DETECTADO') THEN 1
                WHEN word IN ('NEGATIVO', 'NAO DETECTADO') THEN 0 ELSE -2 END ELSE -2 END AS result
            FROM (SELECT *, try_cast(word AS DOUBLE) AS number FROM (SELECT *, CAST(CAST(test_id_ AS BIGINT) AS VARCHAR) AS test_id,
                {plain("exame_")} AS exam, {plain("detalhe_exame_")} AS analyte, {plain("result_")} AS word,
                CAST(birth_date_ AS DATE) AS birth FROM raw)))
        WHERE procedure_ <> 'COVID' AND analyte <> 'MATERIAL' AND word <> 'RESULTADO CONFERIDO E LIBERADO.'
            AND word NOT LIKE '%RESULTADO FORMATADO%' AND result <> -3""",
    "HPARDINI": f"""SELECT md5(test_id_) AS sample_id, test_id_ AS test_id,
        CASE WHEN code = 'DENV' THEN CASE method WHEN 'IMUNOENSAIO ENZIMATICO' THEN 'denv_serum' WHEN 'IMUNOCROMATOGRAFIA' THEN 'ns1_antigen'
                WHEN 'PCR EM TEMPO REAL' THEN 'denv_pcr' ELSE 'UNKNOWN' END
            WHEN code = 'CHIKV' AND method = 'PCR EM TEMPO REAL' THEN 'chikv_pcr' ELSE 'UNKNOWN' END AS test_kit,
        {first_letter_sex("sex_")} AS sex, CASE WHEN n BETWEEN 0 AND 120 THEN n END AS age, {plain("location_")} AS location,
        day_ AS date_testing, {case_sql("state_", STATE_CODE["names"], "'NOT REPORTED'")} AS state, CAST(NULL AS VARCHAR) AS patient_id,
        file_name, code, CASE word WHEN 'POSITIVO' THEN 1 WHEN 'NEGATIVO' THEN 0 END AS result
        FROM (SELECT *, CAST(age_ AS INTEGER) AS n, {plain("pathogen_")} AS code, {plain("detalhe_exame_")} AS method,
            {plain("result_")} AS word FROM raw) WHERE code <> 'SARS-COV-2' AND word <> 'INCONCLUSIVO'""",
    "TARGET": f"""SELECT md5(concat(test_id, exam)) AS sample_id, test_id, {case_sql("exam", labs.TARGET_KITS)} AS test_kit, sex_ AS sex,
        CASE WHEN strpos(years_text, 'A') > 0 THEN CAST(split_part(years_text, 'A', 1) AS INTEGER)
            WHEN strpos(years_text, 'M') > 0 OR strpos(years_text, 'D') > 0 THEN 0 ELSE CAST(years_text AS INTEGER) END AS age,
        {plain("location_")} AS location, day_ AS date_testing, {case_sql("upper(state_code_)", STATE_CODE["names"])} AS state,
        CAST(NULL AS VARCHAR) AS patient_id, file_name, detalhe_exame_ AS code,
        CASE word WHEN 'DETECTADO' THEN 1 WHEN 'NAO DETECTADO' THEN 0 END AS result
        FROM (SELECT *, CAST(CAST(test_id_ AS BIGINT) AS VARCHAR) AS test_id, {plain("exame_")} AS exam, {plain("age_")} AS years_text,
            {plain("result_")} AS word FROM raw) WHERE exam <> 'COVID19'""",
}

STAMPS = f"TIMESTAMP '{STAMP}' AS created_at, TIMESTAMP '{STAMP}' AS updated_at"


def feed_sql(lab: str) -> str:
    spec = FEEDS[lab]
    views = {"raw": raw_sql(spec), "fixed": FIXED[lab]}
    source = "fixed"
    if spec.redundant:
        counts = ", ".join(
            f"count(*) FILTER (code IN ('{keep}', '{drop}')) OVER (PARTITION BY test_id) AS pair{i}"
            for i, (keep, drop) in enumerate(spec.redundant)
        )
        gone = " OR ".join(f"(code = '{drop}' AND pair{i} = 2)" for i, (_, drop) in enumerate(spec.redundant))
        views["single"] = f"SELECT * FROM (SELECT *, {counts} FROM fixed) WHERE NOT ({gone})"
        source = "single"
    views["hot"] = f"SELECT sample_id, {', '.join(CARRIED)}, {one_hot_sql('code', spec.codes)} FROM {source}"
    count = "CAST(1 AS BIGINT)" if spec.single_line else "CAST(line_count AS BIGINT)"
    return sql(f"SELECT *, {STAMPS} FROM ({collapse_sql('hot', CARRIED, count)})", **views)


def hlagyn_sql() -> str:
    def text(column: str) -> str:
        return f"CASE {column} WHEN 'Detectado' THEN 'Pos' WHEN 'Não Detectado' THEN 'Neg' END"

    order = ", ".join(f"{c} NULLS FIRST" for c in CARRIED)
    results = ", ".join(
        f"CASE {column} WHEN 'Detectado' THEN 1 WHEN 'Não Detectado' THEN 0 END NULLS FIRST"
        for column in ("dengue_result_", "zika_result_", "chikungunya_result_")
    )
    body = f"""SELECT * EXCLUDE (line), {STAMPS} FROM (SELECT sample_id, {", ".join(CARRIED)},
        {text("dengue_result_")} AS denv_test_result, {text("zika_result_")} AS zikv_test_result,
        {text("chikungunya_result_")} AS chikv_test_result, 'NT' AS yfv_test_result, 'NT' AS mayv_test_result,
        'NT' AS orov_test_result, 'NT' AS wnv_test_result, CAST(1 AS BIGINT) AS qty_original_lines,
        row_number() OVER (PARTITION BY sample_id ORDER BY {order}, {results}) AS line FROM fixed) WHERE line = 1"""
    fixed = f"""SELECT md5(concat(test_id_, CAST(day_ AS VARCHAR), age_, sex_)) AS sample_id, test_id_ AS test_id, 'arbo_pcr_3' AS test_kit,
        {first_letter_sex("sex_")} AS sex, CAST(age_ AS INTEGER) AS age, location_ AS location, day_ AS date_testing,
        {STATE_OR_NULL} AS state, CAST(NULL AS VARCHAR) AS patient_id, file_name, dengue_result_, zika_result_, chikungunya_result_
        FROM raw WHERE dengue_result_ IS NOT NULL OR zika_result_ IS NOT NULL OR chikungunya_result_ IS NOT NULL"""
    return sql(body, raw=raw_sql(FEEDS["HLAGYN"]), fixed=fixed)


def _register_feeds() -> None:
    for i, lab in enumerate(FEEDS, start=1):
        statement = hlagyn_sql() if lab == "HLAGYN" else feed_sql(lab)

        @query(f"L{i:02d}_{lab.lower()}", statement)
        def _(t: Tables, lab=lab):
            return run_feed(raw_feed(t, lab), FEEDS[lab], as_of=STAMP)


_register_feeds()

ESTIMATES = ", ".join(f'"{c}"' if c in ("SE", "data_iniSE", "data_fimSE") else c for c in labs.ESTIMATE_COLUMNS)


@query("L09_case_estimates", sql(f"SELECT {ESTIMATES} FROM estimates", "estimates"))
def _(t: Tables):
    typed = cast_estimates(raw_estimates(t))
    return upsert(typed.limit(0), typed, ESTIMATE_KEYS)


@query("L10_step_pivot", sql(f"SELECT sample_id, analyte, result, {', '.join(vocab.RESULT_COLUMNS)} FROM coded", "coded"))
def _(t: Tables):
    lines = coded_lines(t).select("sample_id", "analyte", "result")
    return lines.select("*", *one_hot("analyte", "result", {p: [p] for p in vocab.PATHOGENS}))


@query(
    "L11_step_fill",
    sql(
        "SELECT sample_id, test_kit, "
        + ", ".join(
            f"CASE max({c}) OVER s WHEN 1 THEN 'Pos' WHEN 0 THEN 'Neg' WHEN -1 THEN 'NT' END AS {c}" for c in vocab.RESULT_COLUMNS
        )
        + ", count(*) OVER s AS qty_original_lines FROM coded WINDOW s AS (PARTITION BY sample_id)",
        "coded",
    ),
)
def _(t: Tables):
    return W.propagate(coded_lines(t).select("sample_id", "test_kit", *vocab.RESULT_COLUMNS))


@query("L12_step_dedupe", sql(f"SELECT sample_id, {', '.join(SAMPLE_COLUMNS)} FROM samples", "samples"))
def _(t: Tables):
    return W.dedupe(coded_lines(t).select("sample_id", *SAMPLE_COLUMNS), ["sample_id"])


@query(
    "L13_step_upsert",
    sql(
        f"""SELECT {', '.join(CARRIED)}, sample_id, {', '.join(vocab.RESULT_COLUMNS)}, qty_original_lines,
        CASE WHEN sex = 'F' THEN TIMESTAMP '2026-01-01 08:00:00' ELSE TIMESTAMP '{STAMP}' END AS created_at,
        CASE WHEN sex = 'F' AND test_kit = 'denv_pcr' THEN TIMESTAMP '2026-01-01 08:00:00' ELSE TIMESTAMP '{STAMP}' END AS updated_at
        FROM samples""",
        "samples",
    ),
)
def _(t: Tables):
    # The upsert reads both sides several times, always by this key.
    rows = stored_by(samples(t), "sample_id", "samples-made")
    before = stamp(rows.filter("sex = 'F'"), "2026-01-01 08:00:00")
    delivered = stamp(rows.filter("NOT (coalesce(sex, '') = 'F' AND test_kit = 'denv_pcr')"), STAMP)
    return upsert(before, delivered, ["sample_id"])


def finals(t: Tables):
    """The bridge samples as the finals of eight laboratories, made once for all of them."""
    rows = stamp(samples(t), STAMP, also=("lab_id",))
    return FeedsOfTable(rows, {f"LAB{i}": F.col("lab_id") == f"LAB{i}" for i in range(8)})


COMBINED = [*LAB_COLUMNS, "lab_id"]
METHOD_CASE = case_sql("test_kit", vocab.KIT_METHODS)


@query("C01_combine_feeds", sql(f"SELECT *, {STAMPS}, {METHOD_CASE} AS test_method FROM samples", "samples"))
def _(t: Tables):
    return C.combine_feeds(finals(t))


@query("C02_age_group", sql("SELECT sample_id, age_group FROM dated", "dated"))
def _(t: Tables):
    return C.add_age_group(samples(t)).select("sample_id", "age_group")


@query("C03_epiweek", sql("SELECT sample_id, epiweek_enddate, epiweek_number, month FROM dated", "dated"))
def _(t: Tables):
    return C.add_epiweek(samples(t)).select("sample_id", "epiweek_enddate", "epiweek_number", "month")


@query("C04_fix_place", sql("SELECT lab_id, location, state, count(*) AS n FROM placed GROUP BY ALL", "placed"))
def _(t: Tables):
    dims = dimensions(t)
    placed = C.fix_place(samples(t), dims.fix_state, dims.fix_location)
    return placed.groupBy("lab_id", "location", "state").agg(F.count(F.lit(1)).alias("n"))


@query("C05_combined", sql("SELECT * FROM combined", "combined"))
def _(t: Tables):
    return combined(t)


@query("C05_combined_from_finals", sql(f"SELECT *, {STAMPS}, {METHOD_CASE} AS test_method FROM combined", "combined"))
def _(t: Tables):
    return C.combine(finals(t), dimensions(t))


@query("C06_for_sharing", sql(f"SELECT * EXCLUDE ({', '.join(C.PRIVATE)}), {METHOD_CASE} AS test_method FROM combined", "combined"))
def _(t: Tables):
    return C.for_sharing(combined(t).withColumn("test_method", X.kit_method("test_kit")))


@query("C07_long_results", sql("SELECT * FROM long", "long"))
def _(t: Tables):
    return C.long_results(combined(t), AS_OF)


@query("C08_estimates_by_week", sql("SELECT * FROM estimates_weekly", "estimates_weekly"))
def _(t: Tables):
    return C.estimates_by_week(cast_estimates(raw_estimates(t)), AS_OF)


REPORT_CITY = C.ReportCity(code=3300071, name="Building Nation 7", state_code="N7")


@query(
    "C09_city_report",
    sql(
        f"""SELECT date_testing, test_kit, age_group, '{REPORT_CITY.name}' AS location, 'N7' AS state_code, location_ibge_code,
        pathogen, result, count(*) AS count FROM (SELECT date_testing, test_kit, age_group, location_ibge_code, """
        + ", ".join(f"{c} AS {p}" for p, c in vocab.RESULT_OF.items())
        + f""" FROM combined WHERE location_ibge_code = {REPORT_CITY.code})
        UNPIVOT (result FOR pathogen IN ({', '.join(vocab.PATHOGENS)})) WHERE result <> 'NT' GROUP BY ALL""",
        "combined",
    ),
)
def _(t: Tables):
    return C.city_report(combined(t), REPORT_CITY)
