import datetime as dt
import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import readers
from tessera.sources.datasets import open_lake, read, tickers_on
from tessera.sources.lake import AuditFailed, Dataset, Lake, MissingPartition, Rule, bar_rules, fill, newest_pull, restatement, thinned, violations
from tessera.sources.payload import payload
from tessera.streaming.incremental import fill_available

KIND = "ticker string, open double, high double, low double, close double, volume double, date date"
D1, D2, D3 = (dt.date(2024, 1, d) for d in (2, 3, 5))


def bars(spark, *dates, close=10.0, n=3):
    rows = [(f"T{i}", 10.0, 12.0, 9.0, close, 5.0, d) for d in dates for i in range(n)]
    return spark.createDataFrame(rows, KIND)


@pytest.fixture
def lake(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("f", T.DoubleType())])
    return Lake(spark, str(tmp_path)).register(Dataset("bars", merge=True), Dataset("splits", key=None, schema=schema), Dataset("holdings", member="fund"))


def test_publish_read_and_gaps(spark, lake):
    with pytest.raises(MissingPartition):
        lake.coverage("bars")
    assert lake.publish("bars", bars(spark, D1, D3), bar_rules(3)[:1], ["ticker"]) == [D1, D3]
    assert lake.partitions("bars") == [D1, D3] and lake.coverage("bars") == (D1, D3)
    assert lake.series("bars", D1, D2).count() == 3 and lake.series("bars").count() == 6 and lake.on_date("bars", D3).count() == 3
    calendar = spark.createDataFrame([(d,) for d in (D1, D2, D3)], "date date")
    assert [r.date for r in lake.gaps("bars", calendar).collect()] == [D2]
    for call in (lambda: lake.series("bars", D2, D2), lambda: lake.on_date("bars", D2)):
        with pytest.raises(MissingPartition):
            call()
    with pytest.raises(ValueError):
        lake.series("bars", D3, D1)
    for call in (lambda: lake.current("bars"), lambda: lake.series("splits")):
        with pytest.raises(TypeError):
            call()


def test_published_partitions_do_not_change(spark, lake):
    lake.publish("bars", bars(spark, D1))
    assert lake.publish("bars", bars(spark, D1, D2, close=11.0)) == [D2]
    assert {r.close for r in lake.on_date("bars", D1).collect()} == {10.0}
    assert lake.publish("bars", bars(spark, D1, close=11.0), replace=True) == [D1]
    assert {r.close for r in lake.on_date("bars", D1).collect()} == {11.0}


def test_a_failed_audit_leaves_nothing(spark, lake, tmp_path):
    with pytest.raises(AuditFailed, match="high_is_highest: 3"):
        lake.publish("bars", bars(spark, D1, close=99.0), bar_rules(3))
    assert lake.partitions("bars") == [] and not list(tmp_path.glob("_staged/*"))


def test_nulls_fail_rules(spark):
    rows = spark.createDataFrame([(1.0,), (None,), (-1.0,)], "x double")
    assert violations(rows, [Rule("positive", F.col("x") > 0), Rule("many", F.count("*") > 5, whole=True)]) == {"positive": 2, "many": 1}


def test_current_tables_and_empty_sources(spark, lake):
    assert lake.current("splits").dtypes == [("id", "bigint"), ("f", "double")] and lake.current("splits").count() == 0
    for value in (1.0, 2.0):
        lake.publish("splits", spark.createDataFrame([(1, value)], "id long, f double"))
    assert [r.f for r in lake.current("splits").collect()] == [2.0]


def test_later_columns_are_null_before(spark, lake):
    lake.publish("bars", bars(spark, D1))
    lake.publish("bars", bars(spark, D2).withColumn("extra", F.lit(7)))
    assert {(r.date, r.extra) for r in lake.read("bars").collect()} == {(D1, None), (D2, 7)}


def test_members_publish_on_their_own(spark, lake):
    kind = "fund string, w double, date date"
    lake.publish("holdings", spark.createDataFrame([("A", 1.0, D1), ("B", 0.5, D1)], kind))
    assert {r.fund for r in lake.on_date("holdings", D1).collect()} == {"A", "B"}


def test_fill_isolates_failures(spark, lake):
    def build(date):
        if date == D2:
            raise RuntimeError("no file")
        return bars(spark, date)

    done, failed = fill(lake, "bars", [D1, D2, D3], build)
    assert done == [D1, D3] and list(failed) == [D2]
    assert fill(lake, "bars", [D1, D3], build) == ([], {})


def test_streamed_fill_is_idempotent(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    bars(spark, D1).write.parquet(str(landing / "one"))
    args = (spark, lake, "bars", f"{landing}/*", KIND, str(tmp_path / "checkpoint"))
    assert fill_available(*args) == [D1]
    assert fill_available(*args) == []
    bars(spark, D1, D2, close=11.0).write.parquet(str(landing / "two"))
    assert fill_available(*args) == [D2]
    assert {r.close for r in lake.on_date("bars", D1).collect()} == {10.0}


def test_folding_pulls(spark):
    rows = [("a", D1, 1.0), ("a", D2, None), ("b", D1, 3.0), ("b", D3, 4.0), ("c", D1, None)]
    got = newest_pull(spark.createDataFrame(rows, "k string, pulled date, v double"), ["k"], "v", "pulled").collect()
    assert {(r.k, r.v, r.pulled) for r in got} == {("a", 1.0, D1), ("b", 4.0, D3)}


def test_restatements(spark):
    kind = "t string, d date, f double"
    old = spark.createDataFrame([("a", D1, 1.0), ("b", D1, 2.0), ("c", D1, None), ("d", D1, 1.0), ("d", D1, 2.0), ("e", D1, 5.0)], kind)
    new = spark.createDataFrame([("a", D1, 1.0), ("b", D1, 3.0), ("c", D1, 1.0), ("d", D1, 1.0), ("f", D1, 1.0)], kind)
    r = restatement(old, new, ["t", "d"], "f").first()
    assert (r.added, r.removed, r.restated, r.old_disagree, r.new_disagree, r.largest, r.null_changes) == (1, 1, 2, 1, 0, 0.5, 1)


def test_readers(spark, tmp_path):
    with gzip.open(tmp_path / "bars.csv.gz", "wt") as out:
        out.write("ticker,volume,open,close,high,low,window_start,transactions\nA,5,1,2,3,0.5,1704153600000000000,7\n")
    row = readers.bars_csv(spark, str(tmp_path / "bars.csv.gz"), D1).first()
    assert (row.ticker, row.close, row.window_start_utc, row.date) == ("A", 2.0, dt.datetime(2024, 1, 2), D1)

    (tmp_path / "t.json").write_text("\n".join(json.dumps(x) for x in ({"ticker": "A", "cap": "12.5", "up": "1"}, {"ticker": "A", "cap": "bad", "up": "2"}, {"ticker": "B"})))
    schema = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("cap", T.DoubleType()), T.StructField("up", T.StringType()), T.StructField("late", T.LongType())])
    rows = readers.ndjson(spark, str(tmp_path / "t.json"), schema, D1)
    assert [(r.ticker, r.cap, r.late) for r in rows.collect()] == [("A", 12.5, None), ("A", None, None), ("B", None, None)]
    assert {(r.ticker, r.up) for r in readers.newest_copy(rows, "ticker", "up").collect()} == {("A", "2"), ("B", None)}

    (tmp_path / "borrow.txt").write_text("#BOF|2024\n#SYM|FEE|AVAIL\nAB|0.25|>10000000\nCD||500\n#EOF|2\n")
    got = readers.borrow_file(spark, str(tmp_path / "borrow.txt"), ["symbol", "fee", "available"]).collect()
    assert [(r.symbol, r.fee, r.available, r.available_capped) for r in got] == [("AB", "0.25", 10000000, True), ("CD", None, 500, False)]

    for pull, value in (("2024-01-01", "1.5"), ("2024-02-01", ".")):
        folder = tmp_path / "fred" / "DGS10" / f"pull={pull}"
        folder.mkdir(parents=True)
        (folder / "x.csv").write_text(f"date,value\n2023-12-29,{value}\n")
    pulled = readers.pulled_csv(spark, f"{tmp_path}/fred/*/*/*.csv")
    assert {(r.series_id, r.value, str(r.vendor_pull_date)) for r in pulled.collect()} == {("DGS10", 1.5, "2024-01-01"), ("DGS10", None, "2024-02-01")}

    text = "made by hand\n\n,Mkt-RF,SMB\n20240102,1.00,-99.99\n20240103,-0.50,0.25\n\n Annual\n,Mkt-RF,SMB\n2024,9,9\n"
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as z:
        z.writestr("f.csv", text)
    got = {(str(r.date), r.name): r.value for r in readers.sectioned_zip(spark, f"{tmp_path}/*.zip").collect()}
    assert got == {("2024-01-02", "Mkt-RF"): 0.01, ("2024-01-02", "SMB"): None, ("2024-01-03", "Mkt-RF"): -0.005, ("2024-01-03", "SMB"): 0.0025}

    (tmp_path / "n.xml").write_text("<edgar><invstOrSecs><invstOrSec><name>Acme</name><cusip>000000000</cusip><balance>3</balance><valUSD>9.5</valUSD></invstOrSec><invstOrSec><name>Beta</name><cusip>037833100</cusip><pctVal>1.25</pctVal></invstOrSec></invstOrSecs></edgar>")
    got = readers.filing_xml(spark, str(tmp_path / "n.xml")).collect()
    assert [(r.name, r.cusip, r.valUSD, r.pctVal) for r in got] == [("Acme", None, 9.5, None), ("Beta", "037833100", None, 1.25)]
    names = spark.createDataFrame([("brk b",), ("BRK/B",), ("-",), (" A ",)], "s string").select(readers.ticker_symbol(F.col("s")).alias("t"))
    assert [r.t for r in names.collect()] == ["BRK.B", "BRK.B", None, "A"]


def test_every_dataset_has_a_reader(spark, tmp_path):
    lake = open_lake(spark, str(tmp_path))
    assert len(lake.datasets) == 18
    for name, ds in lake.datasets.items():
        if ds.key is None:
            assert read(lake, name).dtypes == [(f.name, f.dataType.simpleString()) for f in ds.schema]
            with pytest.raises(TypeError):
                read(lake, name, D1)
        else:
            with pytest.raises(MissingPartition):
                read(lake, name, D1)
    lake.publish("tickers", spark.createDataFrame([("A", True, D1)], "ticker string, active boolean, date date"))
    assert tickers_on(lake, D1).count() == 1


def test_more_readers(spark, tmp_path):
    (tmp_path / "h.csv").write_text('Fund Holdings as of,"Jan 02, 2024"\n\nTicker,Name,Weight\nAAA,"Alpha, Inc",1.5\nBBB,,2.5\n\nThe content is copyrighted\n')
    got = readers.preamble_csv(spark, str(tmp_path / "h.csv")).orderBy("line").collect()
    assert [(r.Ticker, r.Name, r.Weight) for r in got] == [("AAA", "Alpha, Inc", "1.5"), ("BBB", None, "2.5")]
    tree = {"name": "All", "children": [{"name": "Equity", "members": ["A"], "children": [{"name": "US", "members": ["B", "C"]}]}, {"name": "Bond", "members": ["D"]}]}
    assert readers.category_tree(tree) == [("A", "All/Equity"), ("B", "All/Equity/US"), ("C", "All/Equity/US"), ("D", "All/Bond")]
    kind = "cusip string, exchange string, security_type string, ticker string"
    listings = spark.createDataFrame([("1", "LN", "Common Stock", "A"), ("1", "US", "ADR", "B"), ("1", "US", "Common Stock", "C"), ("2", None, None, None)], kind)
    assert {(r.cusip, r.ticker) for r in readers.best_listing(listings).collect()} == {("1", "C"), ("2", None)}
    (tmp_path / "a.atom").write_text('<feed><entry><content type="text/xml"><accession-number>0001-24-1</accession-number><filing-date>2024-01-05</filing-date><filing-type>NPORT-P</filing-type></content></entry></feed>')
    got = readers.filing_list(spark, str(tmp_path / "a.atom")).collect()
    assert [(r.accession, r.form, r.filed) for r in got] == [("0001-24-1", "NPORT-P", D3)]


def test_sizes_and_retention(spark, lake):
    lake.publish("bars", bars(spark, D1, D2))
    got = {r.date: r for r in lake.sizes("bars").collect()}
    assert {d: r.rows for d, r in got.items()} == {D1: 3, D2: 3} and all(r.bytes > 0 and r.files >= 1 for r in got.values())
    days = [dt.date(2022, 1, 1) + dt.timedelta(days=3 * k) for k in range(300)]
    kept = thinned(days, dt.date(2024, 6, 15))
    assert kept[0] == days[0] and set(kept) <= set(days) and len([d for d in kept if d.year == 2023]) == 6
    assert [d for d in days if (dt.date(2024, 6, 15) - d).days <= 14] == [d for d in kept if d >= dt.date(2024, 6, 1)]


def test_payload(spark):
    text = payload({"a": spark.createDataFrame([(1, float("nan"), D1, [1.0, None])], "k int, x double, d date, l array<double>"), "b": spark.range(0)})
    assert json.loads(text) == {"a": [{"k": 1, "x": None, "d": "2024-01-02", "l": [1.0, None]}], "b": []}
    with pytest.raises(ValueError):
        payload({"big": spark.range(20_000)})


def test_all_sections_of_a_zip(spark, tmp_path):
    text = "Made by hand\n\n  Value weighted returns -- monthly\n,NoDur,Durbl\n192607,  1.45, 15.55\n192608,  3.97, -99.99\n\n  Annual\n,NoDur,Durbl\n1927, 10.0, 20.0\n\nCopyright\n"
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("a.csv", text)
        z.writestr("b.csv", text.replace("1.45", "2.45"))
    rows = readers.sections_zip(spark, f"{tmp_path}/*.zip").collect()
    got = {(r.member, r.section, str(r.date), r.name): r.value for r in rows}
    assert len(rows) == 12 and got["a.csv", "Value weighted returns -- monthly", "1926-07-01", "NoDur"] == pytest.approx(0.0145)
    assert got["b.csv", "Value weighted returns -- monthly", "1926-07-01", "NoDur"] == pytest.approx(0.0245)
    assert got["a.csv", "Annual", "1927-01-01", "Durbl"] == pytest.approx(0.2) and got["a.csv", "Value weighted returns -- monthly", "1926-08-01", "Durbl"] is None


def test_a_sheet_of_a_workbook(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}"><sheets><sheet name="Other" sheetId="1" r:id="r1"/><sheet name="Monthly" sheetId="2" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>1960M01</t></si><si><r><t>Cop</t></r><r><t>per</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData/></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="B1" t="s"><v>1</v></c></row><row r="2"><c r="A2" t="s"><v>0</v></c><c r="B2"><v>678.5</v></c><c r="D2" t="inlineStr"><is><t>note</t></is></c></row></sheetData></worksheet>')
    rows = readers.workbook(spark, f"{tmp_path}/*.xlsx", "Monthly", {"A": "month", "B": "price", "C": "gap", "D": "note"}, 2).collect()
    assert [tuple(r) for r in rows] == [("w.xlsx", 2, "1960M01", "678.5", None, "note")]


def test_the_newest_vintage_of_a_page():
    page = '<a href="/data/q_daily_2023.csv">x</a> <a href=\'/data/q_daily_2024.csv\'>y</a> <a href="/data/other_2025.csv">z</a>'
    assert readers.newest_vintage(page, r"q_daily_(\d{4})\.csv") == "/data/q_daily_2024.csv" and readers.newest_vintage(page, r"none_(\d+)") is None
