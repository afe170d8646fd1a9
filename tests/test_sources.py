"""Findings JSON reports, report TSV round trip and archive selection (S-13..S-17, A-13, A-14, T-11)."""

import json
import os

from pyspark.sql import functions as F

from dividax.operators.findings import finding_counts, flatten_findings, top_rules
from dividax.sources.archives import latest_archives
from dividax.sources.findings import read_findings
from dividax.sources.report_io import prepare_export, read_report, write_report


def test_findings_reports(spark, tmp_dir):
    full = {
        "metrics": {"_totals": {"loc": 1234, "SEVERITY.HIGH": 1, "SEVERITY.LOW": 2}},
        "results": [
            {"test_id": "B101", "filename": "src\\app\\main.py", "line_number": 10, "issue_text": "x", "issue_severity": "HIGH"},
            {"test_id": "B105", "filename": "a.py", "issue_severity": "LOW"},
            {"filename": "b.py", "line_number": 3, "issue_severity": "MEDIUM"},
            {"test_id": "B105", "issue_severity": "WEIRD"},
        ],
    }
    with open(os.path.join(tmp_dir, "full.json"), "w") as f:
        json.dump(full, f, indent=2)
    with open(os.path.join(tmp_dir, "empty.json"), "w") as f:
        json.dump({}, f)
    with open(os.path.join(tmp_dir, "broken.json"), "w") as f:
        f.write("{not json")
    reports = read_findings(spark, tmp_dir)
    counts = {r["report_id"].rsplit("/", 1)[-1]: r for r in finding_counts(reports).collect()}
    assert (counts["full.json"]["lines_scanned"], counts["full.json"]["total_issues"]) == (1234, 4)
    assert (counts["full.json"]["high"], counts["full.json"]["medium"], counts["full.json"]["low"]) == (1, 0, 2)
    assert (counts["empty.json"]["lines_scanned"], counts["empty.json"]["total_issues"]) == (0, 0)
    assert counts["full.json"]["status"] == "ok" and counts["broken.json"]["status"] == "unreadable"
    assert counts["broken.json"]["total_issues"] is None and counts["broken.json"]["high"] is None
    rows = reports.select("report_id", "results", "_corrupt_record").collect()
    assert sum(1 for r in rows if r["_corrupt_record"] is not None) == 1
    flat = {r["result_index"]: r for r in flatten_findings(reports.where(F.col("report_id").endswith("full.json"))).collect()}
    assert flat[0]["uri"] == "src/app/main.py" and flat[0]["level"] == "error" and flat[0]["fingerprint"] == "src/app/main.py:10"
    assert flat[1]["start_line"] == 1 and flat[1]["message"] == "Security issue detected" and flat[1]["level"] == "note"
    assert flat[2]["rule_id"] == "unknown" and flat[2]["level"] == "warning"
    assert flat[3]["uri"] == "unknown" and flat[3]["level"] == "note"
    top = [(r["rank"], r["rule_id"], r["n"]) for r in top_rules(reports.where(F.col("report_id").endswith("full.json")), 3).orderBy("rank").collect()]
    assert top == [(1, "B105", 2), (2, "B101", 1), (3, "unknown", 1)]


def test_report_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame(
        [(0, "2024-01-15", "\x1b[31mSBUX.US\x1b[0m", 10.004, "5.7 USD", "1.01 USD", "15%", 0.15, "2024-01-12", "4.0000 PLN", None)],
        "acct int, Date string, Ticker string, Shares double, `Net Dividend` string, `Tax Collected Amount` string, "
        "`Tax Collected %` string, `Tax Collected` double, `Date D-1` string, `Exchange Rate D-1` string, `Tax Amount PLN` string")
    out = prepare_export(df)
    assert "Tax Collected" not in out.columns
    path = write_report(out, os.path.join(tmp_dir, "report"), single_file=True)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    back = read_report(spark, path).first()
    assert back["Ticker"] == "SBUX.US" and back["Shares"] == 10.0 and back["Tax Amount PLN"] == "0"


def test_latest_archives(spark):
    labels = spark.createDataFrame([(x,) for x in [
        "archiwum_tab_a_2022.csv", "archiwum_tab_a_2024.csv", "kursy_2024.csv", "archiwum_tab_a_2023.csv",
        "archiwum_tab_a_2021.csv", "readme.txt"]], "label string")
    got = [tuple(r) for r in latest_archives(labels).collect()]
    assert got == [(2024, "archiwum_tab_a_2024.csv"), (2023, "archiwum_tab_a_2023.csv"), (2022, "archiwum_tab_a_2022.csv")]


def test_ordered_sink_proves_its_order(spark, tmp_dir):
    from dividax.sources.report_io import ORDERED_SCHEMA, order_problems, read_ordered, write_ordered
    schema = "acct string, Date string, Ticker string"
    rows = [(str(i * 7 % 20), f"2024-01-{i % 28 + 1:02d}", f"T{i:04d}.US") for i in range(1500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    path = write_ordered(spark.createDataFrame(rows, schema), f"{tmp_dir}/ordered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    short = type(ORDERED_SCHEMA)(ORDERED_SCHEMA.fields[:1] + [ORDERED_SCHEMA[k] for k in ("acct", "Date", "Ticker")])
    got = {r["ordinal"]: tuple(r)[1:] for r in read_ordered(spark, path, short).collect()}
    assert [got[i + 1] for i in range(len(rows))] == sorted(rows)
    assert spark.read.parquet(f"{path}/manifest").count() > 1
    assert order_problems(spark, path, schema=short).count() == 0
    swapped = {1: got[2], 2: got[1]}
    out = spark.createDataFrame([(i, *swapped.get(i, r)) for i, r in got.items() if i != 1500], short)
    out.write.mode("overwrite").option("sep", "\t").option("header", True).csv(f"{path}/rows")
    assert {r["problem"] for r in order_problems(spark, path, schema=short).collect()} >= {"order", "rows"}


def test_long_documents_are_cut_into_results(spark, tmp_dir):
    """Splits of a few hundred bytes: every document spans many, results too; held against ``json``."""
    from dividax.operators.findings import flatten_results
    from dividax.sources.findings import read_large_findings

    texts = ['a "quoted" {brace', "back\\slash \\\\", "], [ }", "zażółć\nline", "", "x" * 700]
    results = [{"test_id": f"B{i}", "filename": f"d\\{i}.py", "line_number": i, "issue_text": texts[i % 6], "more": {"deep": [1, {"a": []}]},
                "issue_severity": ("HIGH", "LOW", None)[i % 3]} for i in range(200)]
    doc = {"errors": [[], {"results": []}], "metrics": {"a.py": {"loc": 1}, "_totals": {"loc": 7, "SEVERITY.HIGH": 67}, "z.py": {"loc": 2}}, "results": results, "report_id": "named"}
    whole = {
        "indented": json.dumps(doc, indent=2), "one_line": json.dumps(doc | {"report_id": None}),
        "tight": json.dumps(doc | {"report_id": "q\"t"}, indent=0, separators=(",", ":")), "none": json.dumps({"results": [], "metrics": {}}, indent=1),
        "lines": json.dumps({"results": results[:9]}).replace("}, {", "}\n, {"), "empty": "{}",
    }
    broken = {"cut": json.dumps(doc, indent=2)[:-3000], "more": json.dumps(doc, indent=2) + "}", "scalar": json.dumps({"results": [results[0], 5]}),
              "string": '{"results": [{"test_id": "B1}]}', "colon": '{"results"\n: []}', "inner": '{"results": [{"test_id" 5}]}'}
    os.makedirs(os.path.join(tmp_dir, "in"))
    for name, text in (whole | broken).items():
        with open(os.path.join(tmp_dir, "in", f"{name}.json"), "w", encoding="utf-8") as f:
            f.write(text)
    sizes = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "1b"}
    before = {k: spark.conf.get(k) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        reports, found = read_large_findings(spark, os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "scratch"))
        splits = spark.read.parquet(os.path.join(tmp_dir, "scratch", "lines")).select("file", "block").distinct().groupBy("file").count().agg(F.max("count")).first()[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert splits > 20
    short = lambda i: i.rsplit("/", 1)[-1].removesuffix(".json")
    counts = {short(r["report_id"]): r for r in finding_counts(reports).collect()}
    names = {"indented": "named", "tight": 'q"t'}
    assert {n for n, r in counts.items() if r["status"] != "ok"} == set(broken)
    assert {n for n, r in counts.items() if r["status"] == "ok"} == {names.get(n, n) for n in whole}
    got = {}
    for r in found.collect():
        got.setdefault(short(r["report_id"]), {})[r["pos"]] = r["r"].asDict()
    for name, text in whole.items():
        want, n = json.loads(text), names.get(name, name)
        fields = ("test_id", "filename", "line_number", "issue_text", "issue_severity")
        assert [got.get(n, {})[i] for i in range(len(want.get("results", [])))] == [{f: x[f] for f in fields} for x in want.get("results", [])]
        assert len(got.get(n, {})) == counts[n]["total_issues"] == len(want.get("results", []))
        assert counts[n]["lines_scanned"] == want.get("metrics", {}).get("_totals", {}).get("loc", 0)
    assert set(got) <= {names.get(n, n) for n in whole}
    assert flatten_results(found).where("report_id = 'named'").count() == 200


def test_documents_are_written_as_files_of_one_folder(spark, tmp_dir):
    from dividax.sources.findings import read_large_findings, write_documents

    ids = ["a/b c", "ą=%", "same", "same", None]
    rows = [(r, ({"loc": i},), [(f"B{j}", "x{.py", j, 'say "hi" : [', None) for j in range(i)]) for i, r in enumerate(ids)]
    reports = spark.createDataFrame(rows, "report_id string, metrics struct<_totals: struct<loc: bigint>>, "
                                    "results array<struct<test_id: string, filename: string, line_number: bigint, issue_text: string, issue_severity: string>>")
    path = os.path.join(tmp_dir, "documents")
    for _ in range(2):  # overwritten, not added to
        write_documents(reports.repartition(3), path)
    names = [n for n in os.listdir(path) if n.endswith(".json")]
    assert len(names) == len(ids) and not [n for n in os.listdir(path) if os.path.isdir(os.path.join(path, n))]
    found, results = read_large_findings(spark, path, os.path.join(tmp_dir, "cut"))
    got = sorted((r["status"], r["lines_scanned"], r["total_issues"], r["report_id"]) for r in finding_counts(found).collect())
    assert [g[:3] for g in got] == [("ok", i, i) for i in range(5)] and [g[3] for g in got[:4]] == ids[:4] and got[4][3].endswith(".json")
    assert results.where("""r.filename = 'x{.py' AND r.issue_text = 'say "hi" : [' AND r.test_id = concat('B', pos)""").count() == 10
