"""Record schemas."""

from __future__ import annotations

from pyspark.sql import types as T

from labwatch import vocab

S, I, L, D, DT, NTZ = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.DateType(),
    T.TimestampNTZType(),
)


def struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S) for n in names])


# One row per sample, the contract of every feed.
LAB_RESULT = struct(
    sample_id=S,
    test_id=S,
    test_kit=S,
    sex=S,
    age=I,
    location=S,
    date_testing=DT,
    state=S,
    patient_id=S,
    file_name=S,
    **{c: S for c in vocab.RESULT_COLUMNS},
    qty_original_lines=L,
    created_at=NTZ,
    updated_at=NTZ,
)
LAB_COLUMNS = LAB_RESULT.fieldNames()

# Columns a sample carries over from its first line.
CARRIED = ["test_id", "test_kit", "sex", "age", "location", "date_testing", "state", "patient_id", "file_name"]

CASE_ESTIMATE = struct(
    SE=S,
    casos_estimados=I,
    casos_est_min=I,
    casos_est_max=I,
    casos_confirmados=I,
    disease=S,
    city=S,
    city_ibge_code=S,
    state_code=S,
    state=S,
    region=S,
    data_iniSE=DT,
    data_fimSE=DT,
    file_name=S,
)

MUNICIPALITIES = struct(
    CD_MUN=I,
    CD_UF=I,
    SIGLA_UF=S,
    NM_UF=S,
    NM_UF_NORM=S,
    NM_MUN=S,
    NM_MUN_NORM=S,
    REGIAO=S,
    lat=D,
    long=D,
)
MACROREGIONS = struct(
    CO_UF=I, CO_MACSAUD=S, DS_NOMEPAD_macsaud=S, ADM2_PCODE=S, DS_UF_SIGLA=S, Populacao=I
)
TEST_METHODS = strings("test_kit", "test_method", "test_description")
AGE_GROUPS = struct(age_group=S, min_age=I, max_age=I)
EPIWEEKS = struct(year=I, week_num=I, end_date=DT, start_date=DT)
FIX_STATE = strings("source_state", "target_state", "description")
FIX_LOCATION = strings("source_location", "source_state", "target_location", "description")
