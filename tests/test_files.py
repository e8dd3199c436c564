import datetime as dt
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from labwatch.catalog.base import Tables
from labwatch.catalog.file_queries import customer_workbooks
from labwatch.feeds import FEEDS, LabSpec
from labwatch.schema import AGE_GROUPS, EPIWEEKS
from labwatch.sources import readers, repair, sinks, snapshots
from labwatch.sources.workbook import parse_workbooks, read_workbooks
from labwatch.streaming import ingest


def cell(column, row, value):
    ref = f"{chr(65 + column)}{row}"
    if value is None:
        return ""
    if isinstance(value, dt.date):
        return f'<c r="{ref}" s="1"><v>{(value - dt.date(1899, 12, 30)).days}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t>{value}</t></is></c>'


def workbook(path, **sheets):
    """A minimal workbook; each sheet is a list of rows."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
    targets = "".join(f'<Relationship Id="rId{i}" Type="x" Target="worksheets/sheet{i}.xml"/>' for i, _ in enumerate(sheets, 1))
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{targets}</Relationships>')
        book.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{r}">' + "".join(cell(c, r, v) for c, v in enumerate(row)) + "</row>" for r, row in enumerate(rows, 1))
            book.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')


def test_named_sheet_and_dates(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", outro=[["x"], ["1"]], itps_dengue=[["accession", "dh_coleta", "n"], ["007", dt.date(2025, 9, 5), 3.0], [None, None, None], ["8", "05/09/2025", None]])
    out = read_workbooks(spark, str(tmp_path), "itps_dengue").orderBy("row_no").collect()
    assert [r.cells for r in out] == [{"accession": "007", "dh_coleta": "2025-09-05 00:00:00", "n": "3"}, {"accession": "8", "dh_coleta": "05/09/2025", "n": None}]
    assert [r.is_last for r in out] == [False, True] and out[0].file_name.endswith("a.xlsx")


def test_all_sheets_without_footers(spark, tmp_path):
    for name in ("a", "b"):
        workbook(tmp_path / f"{name}.xlsx", s1=[["OS"], [f"{name}1"], [f"{name}2"], ["total"]], s2=[["OS"], [f"{name}3"], ["total"]])
    (tmp_path / "notes.txt").write_text("x")
    rows = read_workbooks(spark, str(tmp_path), all_sheets=True).filter("not is_last")
    assert sorted(r.OS for r in repair.named_columns(rows, ["OS"]).collect()) == ["a1", "a2", "a3", "b1", "b2", "b3"]
    assert {r.sheet for r in read_workbooks(spark, str(tmp_path)).collect()} == {"s1"}


def test_blank_first_line_and_repeated_headers(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", s=[[None, "x"], ["Pedido", "Resultado", "Resultado"], ["1", "CT_I: 20", "ok"]])
    assert [r.cells for r in read_workbooks(spark, str(tmp_path)).collect()] == [{"Pedido": "1", "Resultado": "CT_I: 20", "Resultado.1": "ok"}]


def test_workbook_feed_with_repaired_headers(spark, tmp_path):
    workbook(
        tmp_path / "old.xlsx",
        s=[["Pedido", "Idade", "Sexo", "Data Coleta", "Cidade (Inst Saúde)", "UF  (Inst Saúde)", "Resultado", "Resultado", "Resultado"],
           ["1", "30", "F", dt.date(2025, 2, 1), "Natal", "RN", "VIRUS_ZIKA: Detectado", "VIRUS_DENGUE:", " "],
           ["2", "31", "M", dt.date(2025, 2, 2), "Natal", "RN", None, "VIRUS_DENGUE: Não Detectado", None]],
    )
    workbook(
        tmp_path / "new.xlsx",
        s=[["Pedido", "Idade", "Sexo", "Data Coleta", "Cidade", "UF", "Zika vírus", "Dengue vírus", "Chikungunya vírus", "Resultado"],
           ["3", "32", "F", "2025-02-03", "Goiânia", "GO", "Detectado", None, None, "livre"]],
    )
    out = {r.Pedido: r for r in readers.read_feed(spark, str(tmp_path), FEEDS["HLAGYN"]).collect()}
    assert out["1"]["Zika vírus"] == "Detectado" and out["1"]["Dengue vírus"] == "" and out["1"].Cidade == "Natal" and out["1"].UF == "RN"
    assert out["2"]["Zika vírus"] == "" and out["2"]["Dengue vírus"] == "Não Detectado"
    assert out["3"]["Zika vírus"] == "Detectado" and out["3"].Cidade == "Goiânia"
    assert out["1"]["Data Coleta"] == "2025-02-01 00:00:00"


def test_sole_untagged_column_gets_the_plain_name(spark):
    rows = spark.createDataFrame(
        [("f", 1, {"Resultado.1": None, "Resultado.2": "livre", "x": "1"}), ("f", 2, {"Resultado.1": " ", "Resultado.2": None, "x": "2"}), ("g", 1, {"x": "3"})],
        "file_name string, row_no long, cells map<string,string>",
    )
    out = sorted((r.cells for r in repair.tagged_columns(rows, "Resultado").collect()), key=str)
    assert out == sorted([{"Resultado": "livre", "x": "1"}, {"Resultado": None, "x": "2"}, {"x": "3"}], key=str)


def test_delimited_feed(spark, tmp_path):
    header = ";".join(["EXTRA", *FEEDS["HPARDINI"].raw_headers()])
    line = ";".join(["e", "007", "05/02/2025", "DENV", "PCR em Tempo Real", "São Paulo", "SP", "F", "30", "Positivo"])
    (tmp_path / "a.csv").write_bytes(f"{header}\n{line}\n".encode("latin-1"))
    (tmp_path / "a.bak").write_text("x")
    row = readers.read_feed(spark, str(tmp_path), FEEDS["HPARDINI"]).collect()[0]
    assert row.CODIGO == "007" and row.CIDADE == "São Paulo" and row.file_name.endswith("a.csv")
    (tmp_path / "a.csv").write_text("A;B\n1;2\n")
    with pytest.raises(ValueError, match="missing"):
        readers.read_feed(spark, str(tmp_path), FEEDS["HPARDINI"])


def test_estimates_and_seed_headers(spark, tmp_path):
    os.makedirs(tmp_path / "e")
    (tmp_path / "e" / "x.csv").write_text(
        "SE,casos_est,casos_est_min,casos_est_max,casos,disease,city,city_ibge_code,state_code,state,region,data_iniSE,data_fimSE\n"
        "202501,10,x,12,9,dengue,Natal,0240810,RN,Rio Grande do Norte,Nordeste,2024-12-29,2025-01-04\n"
    )
    row = readers.read_estimates(spark, str(tmp_path / "e")).collect()[0]
    assert (row.SE, row.casos_estimados, row.casos_est_min, row.city_ibge_code, row.data_fimSE) == ("202501", 10, None, "0240810", dt.date(2025, 1, 4))
    (tmp_path / "ages.csv").write_text("age_group, min_age, max_age\n00-04, -1, 4\n80+,   80, 1000\n")
    assert [tuple(r) for r in readers.read_seed(spark, str(tmp_path / "ages.csv"), AGE_GROUPS).collect()] == [("00-04", -1, 4), ("80+", 80, 1000)]
    (tmp_path / "weeks.csv").write_text("year,week_num,end_date,start_date\n2018,01,2018-01-06,2017-12-31\n")
    assert readers.read_seed(spark, str(tmp_path / "weeks.csv"), EPIWEEKS).first().start_date == dt.date(2017, 12, 31)


def test_packed_line(spark):
    df = spark.createDataFrame([('1,"a, b",c',), ("2,,x",)], "line string")
    rows = df.select(F.inline(F.array(readers.parse_packed("line", ["i", "j", "k"])))).collect()
    assert [tuple(r) for r in rows] == [("1", "a, b", "c"), ("2", None, "x")]


def test_publish_and_release_names(spark, tmp_path):
    tables = {"01_a": spark.range(3), "matrix_ALL": lambda: spark.range(2)}
    releases = spark.createDataFrame([("2026-01-06_10h00_Arbo_SE53.2025_V2",), ("2026-01-05_10h00_Arbo_SE53.2025_V1",), ("current",)], "release string")
    # The week is the one of six days before.
    name = sinks.release_name(releases, "2026-01-07 09:05:00").first()
    assert (name.version, name.release) == (3, "2026-01-07_09h05_Arbo_SE53.2025_V3")
    assert sinks.release_name(releases, "2026-01-12 09:05:00").first().release.endswith("_SE01.2026_V1")
    assert sinks.release_name(releases.limit(0), "2026-01-07 09:05:00").first().version == 1
    done = sinks.publish(spark, tables, str(tmp_path / "in"), str(tmp_path / "pub"), name.release)
    assert [(t, n) for t, _, n in done["release"]] == [("01_a", 3), ("matrix_ALL", 2)]
    assert [(t, n) for t, _, n in done["public"]] == [("01_a", 3)]
    assert sorted(os.listdir(tmp_path / "pub")) == ["SE53.2025", "current"]
    assert os.listdir(tmp_path / "pub" / "current" / "matrices" / "csv") == ["01_a"]
    assert sorted(os.listdir(tmp_path / "in" / "current" / "matrices" / "csv")) == ["01_a", "matrix_ALL"]


def test_snapshots_survive_a_replay_and_a_lost_job(spark, tmp_path):
    table = str(tmp_path / "t")
    assert snapshots.read_snapshot(spark, table) is None
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string, created_at string")
    now = lambda: sorted((tuple(r) for r in snapshots.read_snapshot(spark, table).collect()), key=str)
    assert snapshots.merge_into(spark, rows((1, "a", "x"), (2, "b", "x")), table, ["k"], "20260107") == 1
    for _ in range(2):
        assert snapshots.merge_into(spark, rows((2, "c", "y"), (3, "d", "y")), table, ["k"], "stream", 0) == 2
    assert now() == [(1, "a", "x"), (2, "c", "x"), (3, "d", "y")]
    # Another writer counts its batches from 0 too; the same key in two merged parts keeps the first stamp.
    assert snapshots.merge_into(spark, rows((3, "e", "z"), (None, "n", "z")), table, ["k"], "other", 0) == 3
    assert [r for r in now() if r[0] == 3] == [(3, "e", "y")] and len(now()) == 4
    # A part that no manifest line names does not count, and a failed check leaves none.
    os.makedirs(tmp_path / "t" / "part-of-no-version")
    with pytest.raises(ValueError):
        snapshots.merge_into(spark, rows((5, "p", "z"), (5, "q", "z")), table, ["k"], "other", 1)
    assert snapshots.snapshot_version(spark, table) == 3
    assert snapshots.read_snapshot(spark, table, 1).count() == 2
    before = now()
    assert snapshots.compact_snapshot(spark, table) == 4 and now() == before
    assert snapshots.merge_into(spark, rows().limit(0), table, ["k"], "other", 2) == 4


ROW = "k int, v string, created_at string"


def snapshot_rows(spark, table, **how):
    return sorted((tuple(r) for r in snapshots.read_snapshot(spark, table, **how).collect()), key=str)


def test_two_writers_keep_both_batches(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), ROW)
    commit, late = snapshots._commit, []

    def interleaved(spark_, table_, **entry):
        # Another writer takes the version between this one's look at the manifest and its commit.
        if not late:
            late.append(1)
            snapshots.merge_into(spark, rows((2, "other", "x")), table, ["k"], "other", 0)
        return commit(spark_, table_, **entry)

    for n, version in ((0, 2), (1, 4)):
        monkeypatch.setattr(snapshots, "_commit", interleaved)
        late.clear()
        if n:
            late.append(1)
            snapshots.merge_into(spark, rows((4, "between", "x")), table, ["k"], "other", 1)
        assert snapshots.merge_into(spark, rows((10 + n, "mine", "x")), table, ["k"], "mine", n) == version
    assert [r[0] for r in snapshot_rows(spark, table)] == [10, 11, 2, 4]
    assert [p.version for p in snapshots.manifest(spark, table)] == [1, 2, 3, 4]
    assert not snapshots.create_once(spark, f"{table}/manifest/{1:012d}.json", "{}")
    with pytest.raises(snapshots.Conflict):
        snapshots.merge_into(spark, rows((5, "e", "x")), table, ["k"], expected=3)
    # Both see an empty table first.
    late.clear()
    table = str(tmp_path / "new")
    assert snapshots.merge_into(spark, rows((1, "mine", "x"), (2, "mine", "y")), table, ["k"], "mine", 0) == 2
    assert snapshot_rows(spark, table) == [(1, "mine", "x"), (2, "mine", "x")]


def test_reads_and_compaction_open_touched_buckets_only(spark, tmp_path):
    table = str(tmp_path / "t")
    base = spark.range(400).selectExpr("cast(id as int) as k", "'old' as v", "'x' as created_at")
    snapshots.merge_into(spark, base, table, ["k"], buckets=64)
    snapshots.merge_into(spark, spark.createDataFrame([(7, "new", "y"), (8, "new", "y")], ROW), table, ["k"])
    first, second = snapshots.manifest(spark, table)
    assert len(first.held) > 50 and sum(h.rows for h in first.held) == 400
    touched = {h.bucket for h in second.held}
    assert len(touched) <= 2
    folder = lambda path: path.split("/__bucket=")[1].split("/")[0]
    wanted = spark.createDataFrame([(7,), (10_000,)], "k int")
    found = snapshots.read_snapshot(spark, table, wanted=wanted)
    assert [tuple(r) for r in found.collect()] == [(7, "new", "x")]
    opened = {folder(f) for f in found.inputFiles() if first.path.split("/")[-1] in f}
    assert len(opened) <= 2 and str(next(h.bucket for h in second.held)) in {*opened, *map(str, touched)}
    before = snapshot_rows(spark, table)
    assert snapshots.compact_snapshot(spark, table) == 3
    third = snapshots.manifest(spark, table)[-1]
    assert set(third.covers) == touched == {h.bucket for h in third.held}
    assert snapshot_rows(spark, table) == before and len(before) == 400
    # Nothing is joined any more, the old base still answers for the other buckets, and old versions can be read.
    plan = snapshots.read_snapshot(spark, table)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert len(snapshot_rows(spark, table, version=1)) == 400 and (7, "old", "x") in snapshot_rows(spark, table, version=1)


def test_a_merge_during_compaction_stays_on_top(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), ROW)
    for n, v in enumerate("abc"):
        snapshots.merge_into(spark, rows((1, v, "x"), (n + 2, v, "x")), table, ["k"], batch=n)
    write = snapshots._write_part

    def interrupted(*args):
        monkeypatch.setattr(snapshots, "_write_part", write)
        snapshots.merge_into(spark, rows((1, "d", "y"), (9, "d", "y")), table, ["k"], batch=3)
        return write(*args)

    monkeypatch.setattr(snapshots, "_write_part", interrupted)
    assert snapshots.compact_snapshot(spark, table) == 5
    assert snapshot_rows(spark, table) == [(1, "d", "x"), (2, "a", "x"), (3, "b", "x"), (4, "c", "x"), (9, "d", "y")]


def test_changes_keep_counts_equal_to_rebuilt_ones(spark, tmp_path):
    table, counts = str(tmp_path / "t"), str(tmp_path / "counts")
    schema = "k int, week string, lab string"
    batches = [
        [(i, f"w{i % 3}", "a" if i % 2 else None) for i in range(20)],
        [(i, f"w{(i + 1) % 4}", "b") for i in range(5, 15)] + [(None, "w0", "a")],
        [(i, "w9", "b") for i in range(12, 30)],
        [(3, "w0", "a")],
    ]
    for n, batch in enumerate(batches):
        snapshots.merge_into(spark, spark.createDataFrame(batch, schema), table, ["k"], "feed", n)
        if n != 1:  # a refresh may also cover two merges
            for _ in range(2):
                snapshots.refresh_counts(spark, table, counts, ["week", "lab"])
            kept = {tuple(r) for r in snapshots.read_counts(spark, counts).collect()}
            rebuilt = {tuple(r) for r in snapshots.read_snapshot(spark, table).groupBy("week", "lab").count().collect()}
            assert kept == rebuilt
    # The last merge moves no count.
    assert len(snapshots.manifest(spark, counts)) == 2
    moved = snapshots.changes(spark, table, 3).collect()
    assert sorted((r.k, r.week, r.sign) for r in moved) == [(3, "w0", -1), (3, "w0", 1)]


def test_sabin_reads_every_sheet(spark, tmp_path):
    spec = FEEDS["SABIN"]
    headers = spec.raw_headers()
    line = lambda n: [f"{n}-{i}" for i in range(len(headers))]
    workbook(tmp_path / "a.xlsx", s1=[headers, line(1), line(2), ["total"]], s2=[headers, line(3), ["total"]])
    rows = readers.read_feed(spark, str(tmp_path), spec).select(f"`{headers[0]}`").collect()
    assert sorted(r[0] for r in rows) == ["1-0", "2-0", "3-0"]


def test_deliveries_with_different_headers(spark, tmp_path):
    spec = FEEDS["HILAB"]
    headers = spec.raw_headers()
    (tmp_path / "a.csv").write_text(",".join(headers) + "\n" + ",".join(f"a{i}" for i in range(len(headers))) + "\n")
    other = ["extra", *reversed(headers)]
    (tmp_path / "b.csv").write_text(",".join(other) + "\n" + ",".join(["?"] + [f"b{i}" for i in reversed(range(len(headers)))]) + "\n")
    rows = readers.read_feed(spark, str(tmp_path), spec).drop("file_name").collect()
    assert sorted(tuple(r) for r in rows) == [tuple(f"{n}{i}" for i in range(len(headers))) for n in "ab"]


def drop(folder, name, spec: LabSpec, *rows):
    lines = [",".join(spec.raw_headers()), *[",".join(r.get(h, "") for h in spec.raw_headers()) for r in rows]]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_stream_of_two_deliveries(spark, tmp_path):
    spec = FEEDS["HILAB"]
    inbox, archive = tmp_path / "inbox", tmp_path / "archive"
    inbox.mkdir()
    archive.mkdir()
    base = {"Código Da Cápsula": "1", "Exame": "Dengue NS1", "Data Do Exame": "01/02/2025", "Resultado": "Reagente", "Estado": "RJ", "Idade": "9", "Paciente": "p"}
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "cp")
    refreshed = []

    def run(as_of):
        ingest.stream_feed(spark, str(inbox), spec, table, checkpoint, str(archive), as_of, then=lambda s, t: refreshed.append(t))

    drop(inbox, "a.csv", spec, base, {**base, "Código Da Cápsula": "2"})
    run("2025-02-02 00:00:00")
    run("2025-02-03 00:00:00")
    assert len(refreshed) == 1
    # A late file corrects one sample and brings a new one.
    drop(inbox, "b.csv", spec, {**base, "Resultado": "Não Reagente"}, {**base, "Código Da Cápsula": "3"})
    run("2025-02-04 00:00:00")
    out = {r.test_id: r for r in snapshots.read_snapshot(spark, table).collect()}
    assert set(out) == {"1", "2", "3"} and len(refreshed) == 2
    assert out["1"].denv_test_result == "Neg"
    assert (out["1"].created_at.day, out["1"].updated_at.day, out["2"].updated_at.day) == (2, 4, 2)
    # Consumed files move away once a later batch has committed.
    drop(inbox, "c.csv", spec, {**base, "Código Da Cápsula": "4"})
    run("2025-02-05 00:00:00")
    archived = [f for _, _, files in os.walk(archive) for f in files]
    assert "a.csv" in archived


def test_scratch_folder(spark):
    from labwatch import session

    class Bare:
        """A session whose cluster names no shared folder."""

        sparkContext = spark.sparkContext

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError):
        session.scratch_dir(Bare, "x")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert session.scratch_dir(spark, "x").startswith(shared)


STREAMED = {
    "EINSTEIN": ("itps_dengue", {"accession": "007", "exame": "PCR MULTIPLEX ZIKA, DENGUE E CHIKUNGUNYA", "detalhe_exame": "Vírus Dengue:", "resultado": "DETECTADO", "dh_coleta": "05/09/2025", "sexo": "fem", "idade": "5", "municipio": "Ji-Paraná", "estado": "Rondônia"}, "accession"),
    "SABIN": ("s1", {"OS": "1", "Descricao": "x", "Parametro": "DENGIGM", "DataAtendimento": "02/03/2024", "DataNascimento": "02/04/2000", "Resultado": "reagente 1:200"}, "OS"),
    "HLAGYN": ("s", {"Pedido": "1", "Data Coleta": "2025-02-01", "Idade": "4", "Sexo": "Masc", "UF": "GO", "Cidade": "Natal", "Dengue vírus": "Detectado", "Zika vírus": "ND"}, "Pedido"),
}


@pytest.mark.parametrize("lab", list(STREAMED))
def test_stream_of_workbooks(spark, tmp_path, lab):
    spec = FEEDS[lab]
    sheet, row, key = STREAMED[lab]
    headers = spec.raw_headers()
    inbox, table, checkpoint = tmp_path / "inbox", str(tmp_path / "table"), str(tmp_path / "cp")
    inbox.mkdir()
    for number, name in enumerate(("a", "b"), 1):
        lines = [[{**row, key: str(number)}.get(h) for h in headers]]
        footer = [["total"]] if spec.drop_footer else []
        more = {"s2": [headers, [{**row, key: "9"}.get(h) for h in headers], *footer]} if spec.all_sheets and number == 2 else {}
        workbook(inbox / f"{name}.xlsx", **{sheet: [headers, *lines, *footer]}, **more)
        ingest.stream_feed(spark, str(inbox), spec, table, checkpoint, as_of="2026-02-01 10:00:00")
    assert {r.test_id for r in snapshots.read_snapshot(spark, table).collect()} == {"1", "2"} | ({"9"} if spec.all_sheets else set())


def test_customer_workbooks_grow_in_number(spark):
    tables = Tables(spark, "")
    # One nation holds nearly all rows; its keys leave out some files.
    rows = [(k, f"name{k}", 7 if k % 10 else 3, "AUTO") for k in range(1, 100) if not 40 <= k < 55]
    tables.customer = spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    files = customer_workbooks(tables, 10)
    cells = parse_workbooks(files, all_sheets=True).filter("NOT is_last AND sheet <> 'note'").collect()
    sizes = {}
    for r in cells:
        sizes[r.file_name] = sizes.get(r.file_name, 0) + 1
    assert max(sizes.values()) <= 10 and len(sizes) > 10
    for n in (0, 1):
        want = {k for nation in (3, 7) for k in [k for k, _, c, _ in rows if c == nation][n::2]}
        assert sorted(int(r.cells["id"]) for r in cells if r.sheet == f"part{n}") == sorted(want)
    assert {r.path for r in files.filter("noted").collect()} == {"nation-3.xlsx", "nation-7.xlsx"}
