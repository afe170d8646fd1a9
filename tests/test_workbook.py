"""Workbook ingest (S-1..S-6) on workbooks generated here, including a corrupt file."""

import datetime as dt
import os


from dividax.plans.report import build_report
from dividax.sources.workbook import cells_to_statements, read_workbook_cells, write_workbook


def _sheet(currency, header, rows):
    top = [[None] * 8 for _ in range(9)]
    top[5][5] = currency  # F6
    top[1][1] = "Cash operations"
    return top + [header] + rows + [[None, None, None, None, None, None, "Total", 123.0]]


def test_ingest_and_report(spark, tmp_dir):
    en = ["Unnamed: 0", "ID", "Type", "Time", "Comment", "Symbol", "Amount", "Unnamed: 7"]
    pl = ["Unnamed: 0", "ID", "Typ", "Czas", "Komentarz", "Ticker", "Kwota", "Unnamed: 7"]
    rows_en = [
        [None, "1", "Dividend", "12.01.2024 10:00:00", "SBUX.US USD 0.5700/ SHR", "SBUX.US", "5.7", None],
        [None, "2", "Withholding Tax", "12.01.2024 10:00:00", "SBUX.US USD WHT 15%", "SBUX.US", "-0.86", None],
        [None, "3", "Deposit", "13.01.2024 10:00:00", "Blik top up", None, "100", None],
    ]
    rows_pl = [
        [None, "7", "Dywidenda", "15.01.2024 09:00:00", "TXT.PL PLN 1.2000/ SHR", "TXT.PL", "12.0", None],
    ]
    # header row cells must be strings; blank placeholder headers are kept as text
    write_workbook(os.path.join(tmp_dir, "a.xlsx"), _sheet("USD", en, rows_en))
    write_workbook(os.path.join(tmp_dir, "b.xlsx"), _sheet("PLN", pl, rows_pl))
    with open(os.path.join(tmp_dir, "corrupt.xlsx"), "wb") as f:
        f.write(b"not a zip file at all")
    cells = read_workbook_cells(spark, tmp_dir)
    rows, bad = cells_to_statements(cells)
    assert [r["path"].endswith("corrupt.xlsx") for r in bad.collect()] == [True]
    good = rows.collect()
    assert len(good) == 4  # the Total footer rows are gone
    by_id = {r["ID"]: r for r in good}
    assert by_id["1"]["account_currency"] == "USD" and by_id["7"]["account_currency"] == "PLN"
    # Polish headers resolve to the English statement columns at ingest
    assert by_id["7"]["Type"] == "Dywidenda" and by_id["7"]["Symbol"] == "TXT.PL" and by_id["7"]["Amount"] == "12.0"
    assert "Unnamed: 0" not in by_id["1"]["cells"] and by_id["1"]["cells"]["Type"] == "Dividend"
    fx = spark.createDataFrame([("USD", dt.date(2024, 1, 11), 4.0)], "currency string, rate_date date, rate double")
    rep = build_report(rows, fx)
    out = {r["ticker"]: r for r in rep.collect()}
    assert out["SBUX.US"]["shares"] == 10.0 and out["SBUX.US"]["wht_amount"] == 0.86
    assert out["SBUX.US"]["net_dividend"] == 5.7 and out["SBUX.US"]["fx_rate_d1"] == 4.0
    assert out["TXT.PL"]["shares"] == 10.0 and out["TXT.PL"]["tax_due_pln"] is None  # 19 % default covers the tax


def test_end_to_end_job(spark, tmp_dir):
    from dividax.plans.job import run_report_job
    statements, archives, out = (os.path.join(tmp_dir, d) for d in ("statements", "archives", "out"))
    os.makedirs(statements)
    os.makedirs(archives)
    en = ["Unnamed: 0", "ID", "Type", "Time", "Comment", "Symbol", "Amount", "Unnamed: 7"]
    rows = [
        [None, "1", "Dividend", "15.01.2024 10:00:00", "SBUX.US USD 0.5700/ SHR", "SBUX.US", "22.8", None],
        [None, "2", "Withholding Tax", "15.01.2024 10:00:00", "SBUX.US USD WHT 15%", "SBUX.US", "-3.42", None],
        [None, "3", "Dividend", "15.03.2024 10:00:00", "SBUX.US USD 0.5700/ SHR", "SBUX.US", "22.8", None],
    ]
    write_workbook(os.path.join(statements, "pln.xlsx"), _sheet("PLN", en, rows))
    with open(os.path.join(archives, "archiwum_tab_a_2024.csv"), "w", encoding="iso-8859-1") as f:
        f.write("data;1USD;1EUR\nnazwa;1 dolar;1 euro\n20240112;4,0000;4,3000\n")
    run_report_job(spark, statements, archives, out)
    rep = spark.read.parquet(os.path.join(out, "report_parquet")).collect()
    assert len(rep) == 1 and rep[0]["shares"] == 10.0 and rep[0]["tax_due_pln"] == 0.29
    assert spark.read.parquet(os.path.join(out, "quarantine")).count() == 1  # March: no rate within the look-back
    assert spark.read.parquet(os.path.join(out, "totals")).first()["total_tax_pln"] == 0.29
    assert len([f for f in os.listdir(os.path.join(out, "report")) if f.endswith(".csv")]) >= 1


def _with_styles(content: bytes, column: str) -> bytes:
    """The workbook with a date style on the numeric cells of a column."""
    import io
    import re
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            data = old.read(name)
            if "worksheets/" in name:
                data = re.sub(rb'(<c r="%s\d+")(?=[^>]*><v>)' % column.encode(), rb'\1 s="1"', data)
            new.writestr(name, data)
        new.writestr("xl/styles.xml", '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><numFmts count="1">'
                     '<numFmt numFmtId="170" formatCode="dd/mm/yyyy hh:mm"/></numFmts><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="170"/></cellXfs></styleSheet>')
    return out.getvalue()


def test_date_cells_currency_and_headers_of_real_files():
    import pytest

    from dividax.sources.workbook import statement_rows, workbook_bytes

    def sheet(currency, headers):
        rows = [[None] * 7 for _ in range(8)]
        rows[5][5] = currency
        return [*rows, headers, [1, "DIVIDENT", 45303.5, "c", "S1.US", 2.5]]

    headers = ["ID", "Type", "Time", "Comment", "Symbol", "Amount"]
    (row,) = statement_rows("p", _with_styles(workbook_bytes(sheet("PLN", headers)), "C"))
    assert row[1] == "PLN" and row[3]["Time"] == "2024-01-12 12:00:00" and float(row[3]["Amount"]) == 2.5
    with pytest.raises(ValueError, match="no account currency"):
        list(statement_rows("p", workbook_bytes(sheet(None, headers))))
    with pytest.raises(ValueError, match="more than once: Comment"):
        list(statement_rows("p", workbook_bytes(sheet("PLN", [*headers[:5], "Comment"]))))


def test_typed_cells_reach_the_report(spark, tmp_dir):
    header = [None, "ID", "Type", "Time", "Comment", "Symbol", "Amount", None]
    rows = [[None, "1", "Dividend", dt.datetime(2024, 1, 12, 23, 59, 59), "SBUX.US USD 0.5700/ SHR", "SBUX.US", 5.7, None],
            [None, "2", "Withholding Tax", dt.datetime(2024, 1, 12), "SBUX.US USD WHT 15%", "SBUX.US", -0.86, None]]
    write_workbook(os.path.join(tmp_dir, "typed.xlsx"), _sheet("USD", header, rows))
    found, bad = cells_to_statements(read_workbook_cells(spark, tmp_dir))
    assert bad.count() == 0 and sorted(r["Time"] for r in found.collect()) == ["2024-01-12 00:00:00", "2024-01-12 23:59:59"]
    fx = spark.createDataFrame([("USD", dt.date(2024, 1, 11), 4.0)], "currency string, rate_date date, rate double")
    (out,) = build_report(found, fx).collect()
    assert (out["date"], out["shares"], out["wht_amount"], out["net_dividend"]) == (dt.date(2024, 1, 12), 10.0, 0.86, 5.7)


def test_fleet_files_are_written_once_and_damaged_ones_rejected(spark, tmp_dir):
    from pyspark.sql import functions as F

    from dividax.sources.workbook import FLEET_DAMAGE, fleet_file, reject_reason, write_statement_fleet
    rows = [(f"{a}-{y}-{i}", a, "PLN", "Dividend", dt.datetime(y, 3, 1 + i, 10, 30, i), None if i == 3 else f"c <{i}> & Łódź", "X.PL", None if i == 4 else i / 4)
            for a in range(4) for y in (2020, 2021) for i in range(6)]
    stmt = spark.createDataFrame(rows, "id string, acct int, account_currency string, Type string, Time timestamp, Comment string, Symbol string, Amount double")
    for _ in range(2):  # a repeated task writes the same files again
        assert sorted((r["path"][-15:], r["rows"]) for r in write_statement_fleet(stmt, f"{tmp_dir}/fleet").collect()) == [(f"t-{a}-{y}-0.xlsx", 6) for a in range(4) for y in (2020, 2021)]
    assert len(os.listdir(f"{tmp_dir}/fleet")) == 8
    found, bad = cells_to_statements(read_workbook_cells(spark, f"{tmp_dir}/fleet"))
    assert sorted(tuple(r) for r in bad.select(*fleet_file("path"), reject_reason("_error")).collect()) == [(i, 2020, d) for i, d in enumerate(FLEET_DAMAGE)]
    got = {r["ID"]: (r["Comment"], r["Amount"] and float(r["Amount"]), r["Time"]) for r in found.collect()}
    assert got == {i: (c, v, str(t)) for i, a, _, _, t, c, _, v in rows if t.year == 2021 or a == 3}
    assert found.where(F.col("account_currency") != "PLN").count() == 0


def test_a_file_binds_its_own_header(spark, tmp_dir):
    values = {"ID": "5", "Type": "Dividend", "Time": "12.01.2024 10:00:00", "Comment": "c", "Symbol": "A.US", "Amount": "2.5"}
    names = {"ID": "ID", "Type": "Typ", "Time": "Czas", "Comment": "Komentarz", "Symbol": "Ticker", "Amount": "Kwota"}
    for i, (order, polish) in enumerate([(list(values), False), (list(values)[::-1], True), (["Amount", "ID", "Time", "Symbol", "Type", "Comment"], False), (["ID", "Type", "Time"], True)]):
        write_workbook(os.path.join(tmp_dir, f"{i}.xlsx"), _sheet("USD", [names[c] if polish else c for c in order], [[values[c] for c in order]]))
    rows, bad = cells_to_statements(read_workbook_cells(spark, tmp_dir))
    got = rows.select(*values).collect()
    assert len(got) == 3 and all(r.asDict() == values for r in got)
    assert [r["_error"].split(": ", 1)[1] for r in bad.collect()] == ["column missing: Symbol, Comment, Amount"]


def test_files_are_sized_by_account_and_year(spark, tmp_dir, monkeypatch):
    from dividax.sources import workbook as W
    monkeypatch.setattr(W, "ROWS_PER_WORKBOOK", 10)
    rows = [(f"{a}-{y}-{i}", a, "PLN", "Dividend", dt.datetime(y, 3, 1), "c", "X.PL", i / 4) for a in range(4) for y in (2020, 2021) for i in range(30 if a == 3 else 6)]
    stmt = spark.createDataFrame(rows, "id string, acct int, account_currency string, Type string, Time timestamp, Comment string, Symbol string, Amount double")
    files = W.write_statement_fleet(stmt, f"{tmp_dir}/fleet").collect()
    small = [r for r in files if not os.path.basename(r["path"]).startswith("stmt-3-")]
    assert len(small) == 6 and all(r["rows"] == 6 for r in small)  # not cut by the rows of other accounts
    assert 2 < len(files) - len(small) <= 6 and sum(r["rows"] for r in files) == len(rows)


def test_sheets_in_any_form_give_the_same_cells(monkeypatch):
    import io
    from xml.etree import ElementTree as ET

    from dividax.sources import workbook as W
    values = [None, "", "a & b <c>", "Łódź", 5, 2.5, dt.datetime(2024, 1, 12, 3, 4, 5), " x ", "two\nlines"]
    plain = "".join(W._row_xml(i, values[i % 9:] + values[: i % 9]) for i in range(1, 60)).encode()
    source = (["one", "two"], {1}, dt.datetime(1899, 12, 30))

    def both(rows, tail=b"</sheetData></worksheet>"):
        sheet = b'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="%s"><sheetData>' % W._NS["m"].encode() + rows + tail
        found = []
        for read in (lambda fh: W._iter_rows(fh, *source), lambda fh: (
                (int(n), dict(zip(c.to_pylist()[a:b], v.to_pylist()[a:b]))) for numbers, ends, c, v in W._iter_cells(fh, *source)
                for n, a, b in zip(numbers, ends[:-1], ends[1:]) if b > a)):
            out = []
            try:
                out.extend(row for row in iter(read(io.BytesIO(sheet)).__next__, None))
            except StopIteration:
                pass
            except ET.ParseError:
                out.append("error")
            found.append(out)
        return found

    monkeypatch.setattr(W, "BYTES_PER_BATCH", 1000)
    row = lambda cell: plain + b'<row r="70">' + cell + b"</row>"
    forms = [plain, plain.replace(b"<c ", b"\n <c "), plain.replace(b'<row r="20">', b'<!-- </row> --><row r="20">'), plain.replace(b"&amp;", b"&#38;"),
             plain.replace(b"&amp;", b"&x;"), row(b'<c r="A70" t="s"><v>1</v></c><c r="B70" s="1"/>'), row(b'<c r="B70"><f>A1</f><v>4</v></c>'),
             row(b'<c r="A70" t="b"><v>1</v></c><c r="B70" t="e"><v>#N/A</v></c>'), row(b'<c r="A70" t="inlineStr"><is><r><t>To</t></r><r><t>tal</t></r></is></c>'),
             row(b'<c r="B70"><v>1</v></c><c r="B70"><v>2</v></c>'), row(b'<c r="B71"><v>1</v></c>'), plain + b'<row r="70"/>', plain + b"</row>"]
    for rows in forms:
        assert len(set(map(str, both(rows)))) == 1
    assert both(plain, b"</sheetData>") == [both(plain)[0] + ["error"]] * 2 and both(plain[:-40], b"")[1][-1] == "error"
    monkeypatch.setattr(W, "_iter_rows", lambda fh, *_s: iter(()) if b"<row" not in fh.read() else 1 / 0)  # plain rows take column operations
    assert sum(len(n) for n, *_ in W._iter_cells(io.BytesIO(b'<worksheet xmlns="%s"><sheetData>%s</sheetData></worksheet>' % (W._NS["m"].encode(), plain)), *source)) == 59


def test_layouts_without_a_chance_are_not_tried(spark):
    from dividax.functions.dates import coerce_date
    texts = ["2024-01-12 3:04:05", "2024-01-12", "12.01.2024 10:00:00", "1.2.2024 1:2:3", " 2024-01-12 ", "2024-01-12T03:04:05", "12.01.2024", "x", "", None, "2024-13-01"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] and str(r[0]) for r in df.select(coerce_date("t")).collect()]
    assert got == ["2024-01-12", "2024-01-12", "2024-01-12", "2024-02-01", "2024-01-12", None, None, None, None, None, None]
    assert "CASE WHEN" in df.select(coerce_date("t"))._jdf.queryExecution().optimizedPlan().toString()


def test_counting_statement_rows_makes_none_of_their_texts(spark):
    from conftest import SF_SMALL

    from dividax.sources.statements import synthetic_statements
    stmt = synthetic_statements(spark, SF_SMALL)
    plan = stmt.groupBy("acct").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "SHR" not in plan and "WHT" not in plan and "decimal" not in plan  # chunk sizes are counted over all rows
    legs = {r["kind"]: r["n"] for r in stmt.selectExpr("substr(id, 1, 1) kind", "id").groupBy("kind").agg({"id": "count"}).withColumnRenamed("count(id)", "n").collect()}
    assert legs["D"] > legs["T"] > 0 and stmt.where("id like 'T%' and Amount > 0 or id like 'D%' and Amount < 0").count() == 0


def test_plain_sheets_are_cut_without_a_pattern_per_cell(monkeypatch):
    import io
    import random

    import pyarrow as pa
    import pyarrow.compute as pc

    from dividax.sources import workbook as W
    monkeypatch.setattr(pc, "extract_regex", None)  # cost more than half of the reader's time
    monkeypatch.setattr(pc, "split_pattern", None)
    pick, shared, epoch = random.Random(5), ["one", "x < y"], dt.datetime(1899, 12, 30)
    texts = ["a", "x > y", "&amp;lt;", "Łódź 😀", "  pad ", "", "two\nlines", 'q"uote t="s"', "&lt;c r=&quot;A1&quot;&gt;"]
    forms = ['{s} t="inlineStr"><is><t>{x}</t></is></c>', '{s} t="inlineStr"><is><t xml:space="preserve">{x}</t></is></c>', '{s}><v>45303.25</v></c>', '{s}><v></v></c>',
             ' t="s"><v>1</v></c>', ' t="b"><v>1</v></c>', ' t="e"><v>#N/A</v></c>', ' t="str"><v>{x}</v></c>', "{s}/>", "{s}></c>", ' t="inlineStr"/>', ' t="inlineStr"><v>{x}</v></c>']
    for _ in range(300):
        rows, gap, first = [], pick.choice(["", "", "\n  "]), pick.choice([1, 98, 9_998, 999_998])
        for n in range(first, first + 8):
            cells = [f'<c r="{W._letters(c)}{n}"' + pick.choice(forms).format(s=pick.choice(["", ' s="1"']), x=pick.choice(texts)) for c in sorted(pick.sample([0, 1, 2, 25, 26, 701, 702], pick.randrange(6)))]
            rows.append(f'<row r="{n}"{pick.choice(["", " spans=" + chr(34) + "1:8" + chr(34)])}' + (f">{gap}{gap.join(cells)}{gap}</row>" if cells else pick.choice(["/>", "></row>"])))
        piece = gap.join(rows).encode()
        numbers, ends, columns, values = W._plain_cells(piece, pa.array(shared), {1}, epoch)
        got = [(int(n), dict(zip(columns.to_pylist()[a:b], values.to_pylist()[a:b]))) for n, a, b in zip(numbers, ends[:-1], ends[1:]) if b > a]
        assert got == list(W._iter_rows(io.BytesIO(b'<worksheet xmlns="%s"><sheetData>%s</sheetData></worksheet>' % (W._NS["m"].encode(), piece)), shared, {1}, epoch))
    for odd in (b'<row r="1"><c r="A1"><v>1<b/></v></c></row>', b'<row r="1"><c r="A2"><v>1</v></c></row>', b'<row r="1">x<c r="A1"><v>1</v></c></row>', b'<row r="1"><c r="A1"/>x</row>',
                b'<row r="1"><c r="B1"/><c r="A1"/></row>', b'<row r="1"><c r="A1"><v>1</is></c></row>', b'<row r="1"><c r="A1"/>', b'<row r="1"><c r="A1"><v>&x;</v></c></row>'):
        assert W._plain_cells(odd, pa.array(shared), {1}, epoch) is None  # left to the parser


def test_rows_without_nulls_are_joined_once(monkeypatch):
    import decimal

    import pyarrow as pa
    import pyarrow.compute as pc

    from dividax.sources import workbook as W
    joins, join = [], pc.binary_join_element_wise
    monkeypatch.setattr(pc, "binary_join_element_wise", lambda *a, **k: joins.append(1) or join(*a, **k))
    columns = [["a & <b>", "", "Łódź"], [dt.datetime(2024, 1, 12, 3, 4, 5)] * 3, [1.5, -2.25, 100.0], [decimal.Decimal("1.50"), decimal.Decimal("-2.00"), decimal.Decimal("0.10")]]
    for nulls, calls in (((), 1), ((0,), 2), ((0, 1, 2, 3), 5)):
        table = [[None, *c[1:]] if j in nulls else c for j, c in enumerate(columns)]
        joins.clear()
        text = b"".join(W._rows_xml(11, 1, [pa.chunked_array([pa.array(c)]) for c in table])).decode()
        want = "".join(W._row_xml(i, [None, *row]) for i, row in enumerate(zip(*table), start=11))
        assert text.replace("<v>100<", "<v>100.0<") == want and len(joins) == calls


def test_footers_are_looked_for_in_all_texts_at_once(spark):
    from dividax.sources.workbook import CELL_SCHEMA
    maps = [{"ID": "1", "Amount": "2"}, {"Amount": "Total 5"}, {"ID": "SubTotals"}, {"Unnamed: 0": "Total", "ID": "4"}, {"Unnamed: 0": "x"}, {"Typ": "Dywidenda"},
            {"ID": "7", "Type": None}, {"ID": "To", "Type": "tal"}, {}]
    cells = spark.createDataFrame([("p", "PLN", i, m, None) for i, m in enumerate(maps)], CELL_SCHEMA)
    rows, _bad = cells_to_statements(cells)
    # in placeholder columns a footer isn't one; an unknown text is neither
    assert sorted((r["sheet_row"], r["ID"], r["Type"]) for r in rows.collect()) == [(0, "1", None), (3, "4", None), (5, None, "Dywidenda"), (7, "To", "tal")]
    assert "array_join" in rows._jdf.queryExecution().optimizedPlan().toString()
