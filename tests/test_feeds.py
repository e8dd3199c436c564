import datetime as dt

import pytest

from labwatch.feeds import FEEDS, convert_types, fix_values, run_feed, run_stages
from labwatch.feeds.labs import sabin
from labwatch.feeds.runner import rejects
from labwatch.schema import LAB_COLUMNS, LAB_RESULT

STAMP = "2026-02-01 10:00:00"


def raw(spark, lab, *rows, **defaults):
    """Raw rows by header; headers not given are NULL."""
    headers = [*FEEDS[lab].raw_headers(), "file_name"]
    data = [tuple({"file_name": "f.csv", **defaults, **row}.get(h) for h in headers) for row in rows]
    return spark.createDataFrame(data, ", ".join(f"`{h}` string" for h in headers))


def finals(spark, lab, *rows, spec=None, **defaults):
    return run_feed(raw(spark, lab, *rows, **defaults), spec or FEEDS[lab], STAMP)


def fixed(spark, lab, *rows, **defaults):
    spec = FEEDS[lab]
    return fix_values(convert_types(raw(spark, lab, *rows, **defaults), spec), spec).collect()


@pytest.mark.parametrize("lab", list(FEEDS))
def test_contract(spark, lab):
    out = finals(spark, lab, {})
    assert out.columns == LAB_COLUMNS
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in LAB_RESULT.fields]


def test_einstein_multiplex_is_one_sample(spark):
    exam = "PCR MULTIPLEX ZIKA, DENGUE E CHIKUNGUNYA"
    base = {"accession": "007", "exame": exam, "dh_coleta": "05/09/2025", "sexo": "fem", "idade": "5", "municipio": "Ji-Paraná", "estado": "Rondônia"}
    rows = [
        {**base, "detalhe_exame": "Vírus Dengue:", "resultado": "DETECTADO"},
        {**base, "detalhe_exame": "Vírus Zika:", "resultado": "NÃO DETECTADO"},
        {**base, "detalhe_exame": "Vírus Chikungunya:", "resultado": "NÃO DETECTADO"},
        # A repeated delivery line counts once.
        {**base, "detalhe_exame": "Vírus Dengue:", "resultado": "DETECTADO"},
        {**base, "dh_coleta": "2025-07-31 00:00:00"},
        {**base, "accession": "2024234005520"},
    ]
    out = finals(spark, "EINSTEIN", *rows).collect()
    assert len(out) == 1
    row = out[0]
    assert (row.test_id, row.test_kit, row.sex, row.location, row.state) == ("007", "arbo_pcr_3", "F", "JIPARANA", "RONDONIA")
    assert (row.denv_test_result, row.zikv_test_result, row.chikv_test_result, row.yfv_test_result) == ("Pos", "Neg", "Neg", "NT")
    assert row.qty_original_lines == 3 and row.date_testing == dt.date(2025, 9, 5) and row.patient_id is None


def test_sabin_results_and_filters(spark):
    base = {"OS": "1", "Descricao": "x", "Parametro": "DENGIGM", "DataAtendimento": "02/03/2024", "DataNascimento": "02/04/2000"}
    texts = ["Não Reagente ", "0,79", "0,80", ",5", "1:200", "reagente 1:200", "NAO REATIVO", "'", "Teste", None, "zzz"]
    rows = [{**base, "OS": str(i), "Resultado": t} for i, t in enumerate(texts)]
    got = {r.test_id: r.result for r in fixed(spark, "SABIN", *rows)}
    assert got == {"0": 0, "1": 0, "2": 1, "3": 0, "4": -2, "5": 1, "6": -2, "7": 0, "10": -2}
    # Before 2024 text patterns count as well.
    early = fixed(spark, "SABIN", {**base, "DataAtendimento": "12/31/2023", "Resultado": "NAO REATIVO"})
    assert early[0].result == 0 and early[0].age == 23
    codes = ["PCRCHIKCT", "DENV1", "FEBREGLC", "YFV", None]
    kept = fixed(spark, "SABIN", *[{**base, "Parametro": c, "Descricao": "PAINEL MOLECULAR PARA DENGUE X", "Resultado": "NEGATIVO"} for c in codes])
    assert [r.detalhe_exame for r in kept] == ["PCRCHIKCT"]


def test_sabin_redundant_analytes(spark):
    base = {"Descricao": "x", "DataAtendimento": "02/03/2024", "Resultado": "NEGATIVO"}
    rows = [{**base, "OS": o, "Parametro": p} for o, p in [("1", "DENGIGG"), ("1", "DENGUEGI"), ("2", "DENGUEGI")]]
    assert finals(spark, "SABIN", *rows).count() == 2


def test_sabin_date_order(spark):
    row = {"OS": "1", "Descricao": "x", "Parametro": "DENGIGM", "Resultado": "POSITIVO", "DataAtendimento": "02/03/2024"}
    days = [finals(spark, "SABIN", row, spec=sabin(month_first=m)).collect()[0].date_testing for m in (True, False)]
    assert days == [dt.date(2024, 2, 3), dt.date(2024, 3, 2)]


def test_fleury(spark):
    base = {"CODIGO REQUISICAO": "1", "DATA COLETA": "1/2/2025", "EXAME": "DENGUEG", "PATOGENO": "Dengue, IgG", "ESTADO": "SP", "SEXO": "F"}
    texts = {"0,8": 0, "0,9": None, "1,1": None, "1,2": 1, "Inferior a 0,5": 0, "não reagente": 0, "REAGENTE fraco": 1, "talvez": -2, "1/40": None, "*": None}
    rows = [{**base, "CODIGO REQUISICAO": t, "RESULTADO": t} for t in texts]
    got = {r.test_id: r.result for r in fixed(spark, "FLEURY", *rows)}
    # Indeterminate and void results leave no row.
    assert got == {t: code for t, code in texts.items() if code is not None}
    dropped = [
        {**base, "RESULTADO": None},
        {**base, "RESULTADO": "NEGATIVO", "EXAME": None},
        {**base, "RESULTADO": "NEGATIVO", "EXAME": "2019NCOV"},
        {**base, "RESULTADO": "NEGATIVO", "DATA COLETA": None},
        {**base, "RESULTADO": "NEGATIVO", "CODIGO REQUISICAO": "6330770357_400"},
        {**base, "RESULTADO": "1,5", "PATOGENO": "ZIKA VÍRUS - IGM"},
    ]
    assert fixed(spark, "FLEURY", *dropped) == []
    row = finals(spark, "FLEURY", {**base, "RESULTADO": "Positivo", "PACIENTE": "p", "IDADE": "10A5D"}).collect()[0]
    assert (row.state, row.patient_id, row.age, row.test_kit, row.denv_test_result) == ("SAO PAULO", "p", 0, "igg_serum", "Pos")


def test_hilab_counts_one_line(spark):
    base = {"Código Da Cápsula": "1", "Exame": "Dengue NS1", "Paciente": "p", "Data Do Exame": "01/02/2025", "Resultado": "Reagente", "Estado": "RJ"}
    rows = [base, {**base, "Resultado": "Não Reagente"}, {**base, "Exame": "Covid-19 Antígeno"}, {**base, "Exame": "COVID"}, {**base, "Resultado": "Inválido"}, {**base, "Exame": None}, {**base, "Idade": "121", "Código Da Cápsula": "2"}]
    out = {r.test_id: r for r in finals(spark, "HILAB", *rows).collect()}
    assert set(out) == {"1", "2"}
    # The first line in column order is kept before rules apply.
    assert out["1"].denv_test_result == "Neg" and out["1"].qty_original_lines == 1
    assert out["2"].age is None and out["2"].state == "RIO DE JANEIRO"


def test_hlagyn_wide_results(spark):
    base = {"Pedido": "1", "Data Coleta": "2025-02-01", "Idade": "4", "Sexo": "Masc", "UF": "XX"}
    rows = [{**base, "Dengue vírus": "Detectado", "Zika vírus": "ND"}, {**base, "Pedido": "2"}, {**base, "Pedido": "3", "Chikungunya vírus": "Não Detectado"}]
    out = {r.test_id: r for r in finals(spark, "HLAGYN", *rows).collect()}
    assert set(out) == {"1", "3"}
    assert (out["1"].denv_test_result, out["1"].zikv_test_result, out["1"].chikv_test_result, out["1"].wnv_test_result) == ("Pos", None, None, "NT")
    assert out["1"].state is None and out["1"].sex == "M" and out["1"].test_kit == "arbo_pcr_3"


def test_dbmol(spark):
    base = {"NumeroPedido": "0012", "DataCadastro": "2025-02-28", "DataNascimento": "2000-02-29", "UF": "ZZ", "Sexo": "I"}
    igg = {**base, "Procedimento": "Dengue - Anticorpos IgG", "CodigoProcedimento": "DENGG", "Parametro": "DENGG"}
    texts = {"0.79": 0, "0.80": None, "1.00": None, "1.01": 1, "inferior a 2": 0, "0,5": -2, "Resultado conferido e liberado.": None, "x Resultado Formatado": None}
    rows = [{**igg, "NumeroPedido": str(i), "Resultado": t} for i, t in enumerate(texts)]
    got = {r.test_id: r.result for r in fixed(spark, "DBMOL", *rows)}
    assert got == {str(i): code for i, code in enumerate(texts.values()) if code is not None}
    mayaro = {**base, "Procedimento": "Estudo sorológico vírus Mayaro - Anticorpos IgG e IgM", "CodigoProcedimento": "MAYA"}
    out = finals(spark, "DBMOL", {**mayaro, "Parametro": "IgG", "Resultado": "Positivo"}, {**mayaro, "Parametro": "IgM", "Resultado": "Inferior a 5"}, {**mayaro, "Parametro": "Material", "Resultado": "Soro"}).collect()
    assert {(r.test_kit, r.mayv_test_result) for r in out} == {("igg_serum", "Pos"), ("igm_serum", "Neg")}
    assert {(r.test_id, r.age, r.state, r.sex) for r in out} == {("12", 24, "NOT REPORTED", None)}


def test_hpardini(spark):
    base = {"CODIGO": "1", "DATACOLETA": "05/02/2025", "PATÓGENO": "denv", "MÉTODO": "Imunoensaio Enzimático", "RESULTADO": "Positivo", "UF": "GO", "IDADE": "130", "SEXO": "F"}
    out = finals(spark, "HPARDINI", base, {**base, "RESULTADO": "Inconclusivo"}, {**base, "PATÓGENO": "RSV"}, {**base, "PATÓGENO": None}).collect()
    assert [(r.test_kit, r.denv_test_result, r.age, r.state, r.date_testing) for r in out] == [("denv_serum", "Pos", None, "GOIAS", dt.date(2025, 2, 5))]


def test_target(spark):
    base = {"Numerdo do Pedido": "007", "Data de Coleta": "5/2/2025", "Exame": "pmdzc", "Idade": "95a10m", "Estado": "sp", "Sexo": "F"}
    rows = [{**base, "Cód. Pátógeno": c, "Resultado": r} for c, r in [("DENV", "Detectado"), ("ZIKV", "Não detectado"), ("CHIKV", "Repetir")]]
    out = finals(spark, "TARGET", *rows, {**base, "Exame": "COVID19"}, {**base, "Exame": "NOVO", "Cód. Pátógeno": "RES1", "Resultado": "DETECTADO"}).collect()
    by_kit = {r.test_kit: r for r in out}
    assert set(by_kit) == {"arbo_pcr_3", None}
    row = by_kit["arbo_pcr_3"]
    assert (row.denv_test_result, row.zikv_test_result, row.chikv_test_result) == ("Pos", "Neg", "NT")
    assert (row.test_id, row.age, row.state, row.qty_original_lines) == ("7", 95, "SAO PAULO", 3)


def test_dirty_values_are_reported_or_raise(spark):
    base = {"Exame": "Dengue NS1", "Resultado": "Reagente", "Código Da Cápsula": "1"}
    df = raw(spark, "HILAB", {**base, "Idade": "x", "Data Do Exame": "2025-13-01"}, {**base, "Idade": "5", "Data Do Exame": "01/02/2025"})
    bad = rejects(df, FEEDS["HILAB"]).collect()
    assert [sorted(r.rejected_columns) for r in bad] == [["age", "date_testing"]]
    with pytest.raises(ValueError, match="HILAB"):
        convert_types(df, FEEDS["HILAB"], strict=True)
    assert convert_types(df, FEEDS["HILAB"]).count() == 2


def test_stages_agree_with_the_fused_feed(spark):
    base = {"OS": "1", "Descricao": "PCR para Zika, Chikungunya e Dengue", "DataAtendimento": "02/03/2024"}
    rows = [{**base, "Parametro": p, "Resultado": r, "Sexo": s} for p, r, s in [("PCRCHIK", "DETECTADO", "F"), ("PCRDE", "NAO DETECTADO", "M"), ("VIRUSZICA", "zz", None)]]
    df = raw(spark, "SABIN", *rows)
    staged = run_stages(df, FEEDS["SABIN"])["samples"]
    fused = run_feed(df, FEEDS["SABIN"], STAMP)
    columns = [c for c in LAB_COLUMNS if c not in ("created_at", "updated_at")]
    assert staged.select(columns).collect() == fused.select(columns).collect()
    assert fused.first().zikv_test_result == "NT"
