import datetime as dt
import random
import re
import time
from html.parser import HTMLParser

from pyspark.sql import functions as F

from fixtures import LABEL_TEXT, PORTS_HTML
from starflow.plans import driver_queries, staging
from starflow.plans.driver_queries import q_html_table_pairs
from starflow.sources import (date_spine, html_links, html_rows, html_table_pairs, parse_label_lines, parse_label_text,
                              read_label_files, read_preamble_csv, scan)
from starflow.sources.html import NESTED, _clean


def test_label_text_blocks(spark):
    df = parse_label_text(spark.createDataFrame([("f", LABEL_TEXT)], "path string, text string"), keep=["path"])
    got = {(r.list_name, r.code): r.label for r in df.collect()}
    assert got[("i94cntyl", "582")] == "MEXICO"
    assert got[("i94cntyl", "111")] == "FRANCE"
    assert got[("i94cntyl", "996")] == "No Country Code (996)"       # entry on the terminator line is kept
    assert got[("i94prtl", "QHB")] == "QUAY'S HARBOUR, ZZ"            # doubled quote unescaped, padding trimmed
    assert got[("i94prtl", "TWO")] == "A, B, C"                      # terminator on its own line
    assert got[("i94addrl", "88")] == "Somewhere Else"
    counts = {k: v for k, v in df.groupBy("list_name").count().collect()}
    assert counts == {"i94cntyl": 5, "i94prtl": 5, "i94addrl": 2}


def test_label_files_and_port_split(spark, fixtures_dir):
    labels = staging.stage_labels(spark, f"{fixtures_dir}/labels.sas")
    ports = {r.code: (r.port, r.state) for r in staging.ports_from_labels(labels).collect()}
    assert ports["NYC"] == ("NEW YORK", "NY")
    assert ports["VGR"] == ("VALE - GREEN REACH", "YY")
    assert ports["XXX"] == ("No PORT Code (XXX)", None)
    assert ports["TWO"] == ("A", "B, C")
    c = {r.value: r.description for r in staging.stage_country_labels(labels).collect()}
    assert c[582] == "MEXICO" and c[996] == "No Country Code (996)" and len(c) == 5


def _many_blocks(n_blocks: int = 40) -> str:
    """Blocks closed every way the format allows, plus text outside blocks and after terminators."""
    out = ["libname x 'y' ;\n", "  1 = 'outside any block'\n"]
    for b in range(n_blocks):
        out.append(f"/* block {b} */\n  VALUE {'$' if b % 2 else ''}list{b % 7}{';' if b % 5 == 4 else ''}\n")
        out += [f"   {f'{chr(39)}{b}_{e}{chr(39)}' if e % 2 else b * 100 + e} =\t'label {b}/{e} it''s'\n"
                for e in range(b % 9)]
        out.append({0: f"   {b * 100 + 99} = 'on the terminator' ;\n", 1: ";\n", 2: "/* comment; closes */\n"}
                   .get(b % 5, ""))
        out.append(f"   {b * 100 + 98} = 'after the terminator'\n")
    return "".join(out)


def test_label_lines_match_whole_text_across_splits(spark, tmp_path):
    paths = []
    for name, text in [("fix.sas", LABEL_TEXT), ("many.sas", _many_blocks()),
                       ("crlf.sas", _many_blocks(25).replace("list", "other").replace("\n", "\r\n"))]:
        (tmp_path / name).write_bytes(text.encode())
        paths.append(str(tmp_path / name))

    def rows(df):
        return sorted((r.path.rsplit("/", 1)[-1], r.list_name, r.code, r.label) for r in df.collect())

    expected = rows(parse_label_text(read_label_files(spark, paths), keep=["path"]))
    assert len(expected) > 200
    prev = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for split_bytes in ("134217728", "250", "53"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            assert rows(parse_label_lines(spark, paths, with_path=True)) == expected, split_bytes
        assert spark.read.text(paths).select("_metadata.file_block_start").distinct().count() > 50
        only = rows(parse_label_lines(spark, paths, lists=["LIST3", "i94prtl"], with_path=True))
        assert only == [r for r in expected if r[1] in ("list3", "i94prtl")] and len(only) > 5
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)


def test_html_table_pairs(spark):
    pages = spark.createDataFrame([(1, PORTS_HTML)], "page_id long, html string")
    got = [(r.code, r.location) for r in html_table_pairs(pages, keep=["page_id"]).collect()]
    assert sorted(got) == sorted([("NYC", "New York, NY"), ("MIA", "Miami, FL"), ("BOS", "Boston, MA"),
                                  ("AGA", "Agana"), ("ANC", "Anchorage, AK"), ("SAN", "San Diego & Tijuana, CA")])


def test_stage_ports(spark):
    pages = spark.createDataFrame([("u", PORTS_HTML)], "url string, html string")
    got = {r.code: (r.municipality, r.state) for r in staging.stage_ports(pages).collect()}
    assert got["NYC"] == ("New York", "NY") and got["AGA"] == (None, None) and got["ANC"] == ("Anchorage", "AK")


def test_html_links(spark):
    html = '<p><a href="/a">Alpha</a> <a class="x" href="/b"><b>Beta</b></a> <a href="/c">c-3</a></p>'
    df = spark.createDataFrame([(7, html)], "page_id long, html string")
    got = [(r.link_pos, r.href, r.text) for r in html_links(df, "html", r"^[A-Za-z]+$", keep=["page_id"]).collect()]
    assert sorted(got) == [(0, "/a", "Alpha"), (1, "/b", "Beta")]


def test_preamble_csv(spark, fixtures_dir):
    gdp = staging.stage_gdp(spark, f"{fixtures_dir}/gdp.csv")
    got = {r.country: r.gdp_per_capita for r in gdp.collect()}
    assert got == {"Mexico": 8910.0, "France": 38000.0, "Cura\xe7ao": 19500.0, "Spain": None}
    raw = read_preamble_csv(spark, f"{fixtures_dir}/gdp.csv", "code string, rest string", numeric_key="code")
    assert raw.count() == 7


def test_date_spine_is_calendar_days(spark):
    spine = date_spine(spark, dt.date(2016, 1, 1), dt.date(2026, 1, 8))
    assert spine.count() == 3661
    # DST transitions (US and EU) neither repeat nor skip a day
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        days = [r.date for r in date_spine(spark, "2016-03-10", "2016-03-16").collect()]
        assert days == [dt.date(2016, 3, d) for d in range(10, 17)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scan_many_files_prunes_columns(spark, fixtures_dir):
    df = scan(spark, [f"{fixtures_dir}/arrivals_a.parquet", f"{fixtures_dir}/arrivals_b.parquet"],
              columns=["i94port", "i94mode"])
    assert df.columns == ["i94port", "i94mode"] and df.count() == 19
    plan = df.where(F.col("i94mode") == 1)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(i94mode), EqualTo(i94mode,1.0)]" in plan
    assert "ReadSchema: struct<i94port:string,i94mode:double>" in plan


def test_html_table_pairs_rebalanced_rows(spark):
    pages = spark.createDataFrame([(1, PORTS_HTML)], "page_id long, html string")
    a = sorted((r.code, r.location) for r in html_table_pairs(pages).collect())
    b = sorted((r.code, r.location) for r in html_table_pairs(pages, rebalance_rows=True).collect())
    assert a == b and len(a) == 6


def test_label_lines_plan_groups_by_split_not_file(spark, tmp_path):
    (tmp_path / "l.sas").write_text(LABEL_TEXT)
    df = parse_label_lines(spark, str(tmp_path / "l.sas"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    # Lines are grouped by stretches of a file split, never by file, and the windows over a file see no text.
    groups = [ln for ln in plan.splitlines() if "Aggregate(" in ln and "collect_list(struct(_pos" in ln]
    assert groups and all("_at" in ln and "_stretch" in ln for ln in groups)
    windows = [ln for ln in plan.splitlines() if "Window [" in ln]
    assert windows and not any("value#" in ln or "_t#" in ln for ln in windows)
    final = df._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString()
    assert final.count("FileScan text") == 1 or "ReusedExchange" in final  # one scan and one exchange of the lines


LABEL_SIGNS = "/* a; b */ value $abc /* ; */\n 'k;1' = 'A;B' /* ; */\n 2 = 'it''s; so' ; 3 = 'not mine'\n4 = 'outside'\nvalue d\n5 = 'E'\n;\n"


def test_terminator_signs_in_quotes_and_comments(spark, tmp_path):
    want = [("abc", "2", "it's; so"), ("abc", "k;1", "A;B"), ("d", "5", "E")]
    text = parse_label_text(spark.createDataFrame([(LABEL_SIGNS,)], "text string"))
    (tmp_path / "l.sas").write_text(LABEL_SIGNS.replace("/* a; b */ value", "/* a; b */\nvalue"))
    for df in (text, parse_label_lines(spark, str(tmp_path / "l.sas"))):
        assert sorted((r.list_name, r.code, r.label) for r in df.collect()) == want


def test_entities_and_attribute_forms(spark):
    html = ("<a href='/s?a=1&amp;b=2'>Caf&eacute; &#8364;&#x20AC;</a> <a class=x href=/u>&amp;lt; &nosuch; &#0;</a>"
            "<a data-href=\"no\" href = \"/d\">x</a><a name='n'>none</a>")
    got = [(r.href, r.text) for r in html_links(spark.createDataFrame([(html,)], "html string")).collect()]
    assert got == [("/s?a=1&b=2", "Café €€"), ("/u", "&lt; &nosuch; &#0;"), ("/d", "x")]


LABEL_PIECES = ["value abc", "  VALUE $x", "value", " value 1='h'", "1='A'", " 'b;c' = 'it''s' ", "22 =", "'q'", "/*", "*/", " /* note */", ";", "'",
                "\t", "3='/*'", "4='*/'", "x", " 5 = 'e' /* f", "g */ 6='h'", "'*/ ' /* '"]


def test_label_lines_with_comments_over_lines(spark, tmp_path):
    text = "value abc\n 1='A'\n /* over two lines\nvalue old\n 9='gone' ;\n*/\n 2='B' /* to\n */ ;\n 3='out'\n"
    (tmp_path / "c.sas").write_text(text)
    want = [("abc", "1", "A"), ("abc", "2", "B")]
    for df in (parse_label_text(spark.createDataFrame([(text,)], "text string")), parse_label_lines(spark, str(tmp_path / "c.sas"))):
        assert sorted((r.list_name, r.code, r.label) for r in df.collect()) == want


def test_label_lines_equal_whole_text_wherever_splits_fall(spark, tmp_path):
    """Random files of headers, entries, quotes, ends and comments over any lines, read in splits of a few bytes."""
    pick = random.Random(11)
    paths = []
    for k in range(120):
        text = "".join(pick.choice(LABEL_PIECES) + ("\n" if pick.random() < 0.6 else "") for _ in range(pick.randrange(1, 30)))
        if k % 10 == 0:
            text = text.replace("\n", "\r\n")
        paths.append(str(tmp_path / f"r{k}.sas"))
        (tmp_path / f"r{k}.sas").write_bytes(("value a\n1='one'\n" * (k % 2) + text).encode())

    def rows(df):
        return sorted((r.path.rsplit("/", 1)[-1], r.list_name, r.code, r.label) for r in df.collect())

    expected = rows(parse_label_text(read_label_files(spark, paths), keep=["path"]))
    assert len(expected) > 100
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        for split_bytes in (10, 37, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
            assert rows(parse_label_lines(spark, paths, with_path=True)) == expected, split_bytes
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


class _Tables(HTMLParser):
    """Rows and cells by the rules of the HTML standard, event by event."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.rows = [{"cells": [], "kind": "", "text": ""}], []

    def _end_cell(self):
        top = self.stack[-1]
        if top["kind"] == "td":
            top["cells"].append(top["text"])
        top["kind"], top["text"] = "", ""

    def _end_row(self):
        self._end_cell()
        top = self.stack[-1]
        if top["cells"]:
            self.rows.append([c.replace("\xa0", " ").strip(" ") for c in top["cells"]])
        top["cells"] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            if self.stack[-1]["kind"]:
                self.stack.append({"cells": [], "kind": "", "text": ""})
            else:
                self._end_row()
        elif tag == "tr":
            self._end_row()
        elif tag in ("td", "th"):
            self._end_cell()
            self.stack[-1]["kind"] = tag

    def handle_endtag(self, tag):
        if tag in ("tr", "table"):
            self._end_row()
            if tag == "table" and len(self.stack) > 1:
                self.stack.pop()
        elif tag in ("td", "th"):
            self._end_cell()

    def handle_data(self, data):
        for table in self.stack:
            if table["kind"]:
                table["text"] += data


def _read(html):
    reader = _Tables()
    reader.feed(html)
    reader.close()
    while len(reader.stack) > 1:
        reader.handle_endtag("table")
    reader._end_row()
    return sorted(reader.rows)


HTML_PIECES = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "<td class='a b'>", "</td>", "<TH>", "</th>", "a ", "b&amp;lt;", "<b>x</b>",
               "&eacute;&#65;&#x42;", " ", "<!-- <td>no</td> -->", "<br/>", "<trx>y</trx>", "NYC", "<table><tr><td>q", "&nbsp;"]


def test_html_tables_unclosed_and_nested(spark):
    rows = spark.createDataFrame([("<table><tr><td>NYC<td>New York<tr><td>X<table><tr><td>MIA<td>Miami</table>y<td>Z",)], "html string")
    got = sorted(r[0] for r in rows.select(F.explode(html_rows("html")).alias("c")).select(F.transform("c", _clean)).collect() if r[0])
    assert got == [["MIA", "Miami"], ["NYC", "New York"], ["XMIAMiamiy", "Z"]]
    assert [(r.code, r.location) for r in html_table_pairs(rows).orderBy("code").collect()] == [("MIA", "Miami"), ("NYC", "New York")]


def test_html_tables_equal_an_html_reader(spark):
    pick = random.Random(4)
    pages = [(k, "".join(pick.choice(HTML_PIECES) for _ in range(pick.randrange(0, 40)))) for k in range(400)] + [(-1, None), (-2, "")]
    rows = spark.createDataFrame(pages, "k int, html string").select("k", F.explode(html_rows("html")).alias("c"))
    got = {}
    for r in rows.where(F.size("c") > 0).select("k", F.transform("c", _clean).alias("c")).collect():
        got.setdefault(r.k, []).append(r.c)
    assert {k: sorted(v) for k, v in got.items()} == {k: _read(h) for k, h in pages if h and _read(h)}
    assert 50 < sum(bool(re.search(NESTED, h or "")) for _, h in pages) < 350


def test_a_page_of_many_rows(spark):
    html = "<table>" + "".join(f"<tr><td>AAA<td>place {k}" for k in range(20_000)) + "</table>"
    assert html_table_pairs(spark.createDataFrame([(html,)], "html string")).distinct().count() == 20_000


def test_label_comment_opened_by_slash_star_slash(spark, tmp_path):
    """``/*/`` opens a comment and does not close it, also where a file split ends inside of it."""
    text = "value abc\n1='A' /*/ x\n2='no'\n3='no' */\n4='B'\n;\n"
    (tmp_path / "c.sas").write_text(text)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        for split_bytes in (7, 25, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
            got = sorted((r.list_name, r.code, r.label) for r in parse_label_lines(spark, str(tmp_path / "c.sas")).collect())
            assert got == [("abc", "1", "A"), ("abc", "4", "B")], split_bytes
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_label_lines_are_put_together_once(spark, tmp_path):
    """However many steps read the stretches, one task each puts their lines together: later steps read finished texts."""
    (tmp_path / "l.sas").write_text(LABEL_TEXT)
    df = parse_label_lines(spark, str(tmp_path / "l.sas"))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString()
    assert final.count("FileScan text") == 1 and "ReusedExchange" in final
    assert sum("ObjectHashAggregate(" in ln and "collect_list(struct(_pos" in ln for ln in final.splitlines()) == 2  # partial, final
    assert "SortMergeJoin" not in final  # no sort of the texts


def test_html_pages_are_dealt_out_before_they_are_made(spark, tmp_path):
    """A table of one file and one row group is rendered and parsed by many tasks, null and repeated keys too."""
    rows = [(k % 300 if k % 50 else None, f"N{k}", "AUTO") for k in range(400)]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_mktsegment string").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    got = q_html_table_pairs(spark, str(tmp_path))
    assert got.select(F.spark_partition_id()).distinct().count() > 1
    assert got.where("location like '%inner'").count() == sum(1 for k, _, _ in rows if k is not None and k % 2 == 0)


def test_label_documents_are_written_and_parsed_in_parts(spark, tmp_path, monkeypatch):
    """One part's text lies on disk at a time, its exchanges go with it; all rows are parsed, whatever their keys."""
    cores, day = spark.sparkContext.defaultParallelism, dt.datetime(1996, 2, 29)
    rows = [(k // 4 if k % 3 else None, k % 4 + 1, float(k % 7), "ARN"[k % 3], "OF"[k % 2], day) for k in range(cores)]
    rows += rows[:3] + [(7, None, 1.0, "A", "O", day), (7, 1, 1.0, None, "O", None)] + [rows[-1]] * 4   # repeated; texts that are null
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, "
                                "l_shipdate timestamp").coalesce(2).write.parquet(str(tmp_path / "lineitem.parquet"))
    docs = driver_queries._label_docs(spark.read.parquet(str(tmp_path / "lineitem.parquet")))
    expected = sorted((r.list_name, r.code, r.label) for r in parse_label_text(docs).collect())
    n_docs = docs.where("text is not null").count()
    assert len(expected) == 3 * n_docs == 3 * (len(rows) - 2)

    parsed, shared = [], tmp_path / "shared"

    def parse(spark, path):
        parsed.append((len(list(shared.glob("label_files-*"))), spark.read.text(path).where("value like '%shipping%'").count()))
        return parse_label_lines(spark, path)

    def exchanges():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
        return set(re.findall(r"shuffle_\d+", blocks))

    monkeypatch.setattr(driver_queries, "parse_label_lines", parse)
    monkeypatch.setattr(driver_queries, "scratch_path", lambda _, name: f"{shared}/{name}-{len(parsed)}")
    monkeypatch.setattr(driver_queries, "LABEL_DOCS_A_CORE", 1, raising=False)
    before = exchanges()
    df = driver_queries.q_label_file_parse(spark, str(tmp_path))
    until = time.time() + 20
    while len(exchanges() - before) > 1 and time.time() < until:   # they go in the background
        time.sleep(0.1)
    assert len(exchanges() - before) <= 1   # that of counting the rows
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert sorted((r.list_name, r.code, r.label) for r in df.collect()) == expected
    assert len(parsed) == -(-len(rows) // cores) and sum(n for _, n in parsed) == n_docs
    assert all(there == 1 and n <= cores + 2 for there, n in parsed)   # no text but that of this part
