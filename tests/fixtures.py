"""Small synthetic inputs in the shapes the staging code reads (see FIXTURES.md)."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import SparkSession

EPOCH = dt.date(1960, 1, 1)


def day(y: int, m: int, d: int) -> float:
    return float((dt.date(y, m, d) - EPOCH).days)


APR1 = day(2016, 4, 1)      # ISO week 13
JAN1 = day(2016, 1, 1)      # ISO week 53 (of 2015)

# (i94port, i94cit, arrdate, i94mode, biryear, gender)
ARRIVALS_A = [
    ("NYC", 582.0, APR1, 1.0, 1980.0, "M"),      # adult, Mexico, JFK
    ("NYC", 582.0, APR1, 1.0, 2005.0, "F"),      # 11 -> CH
    ("NYC", 111.0, APR1, 1.0, 2004.0, None),     # 12 -> TE, gender U
    ("NYC", 111.0, APR1, 1.0, 1999.0, ""),       # 17 -> TE, blank gender U
    ("MIA", 582.0, APR1, 1.0, 1998.0, "X"),      # 18 -> AD
    ("MIA", 245.0, APR1, 1.0, 1952.0, "F"),      # 64 -> AD
    ("MIA", 245.0, APR1, 1.0, 1951.0, "M"),      # 65 -> AD (documented rule)
    ("MIA", 582.0, APR1, 1.0, 1950.0, "M"),      # 66 -> OA
    ("NYC", 582.0, APR1, 2.0, 1980.0, "M"),      # sea: dropped
    ("NYC", 582.0, APR1, 3.0, 1980.0, "M"),      # land: dropped
]
ARRIVALS_B = [
    ("NYC", 582.0, APR1, 1.0, 2020.0, "M"),      # negative age -> CH
    ("NYC", 582.0, APR1, 1.0, None, "F"),        # null birth year -> UN
    ("NYC", 582.0, APR1, 1.0, float("nan"), "U"),  # NaN birth year -> UN
    ("NYC", 582.0, None, 1.0, 1980.0, "M"),      # null date -> null date_id (inner lookups keep it)
    ("XXX", 582.0, APR1, 1.0, 1980.0, "M"),      # unknown port -> dropped
    ("NYC", 999.0, APR1, 1.0, 1980.0, "M"),      # INVALID origin: no country -> dropped
    ("NYC", 582.0, JAN1, 1.0, 1980.0, "F"),      # ISO week 53
    ("NYC", 582.0, APR1, 9.0, 1980.0, "M"),      # not reported mode: dropped
    ("NYC", 582.0, APR1, None, 1980.0, "M"),     # null mode: dropped
]

COUNTRY_LABELS_CSV = """value,description
582,MEXICO
111,  FRANCE
245,Spain
999,INVALID: STATELESS
996,No Country Code (996)
abc,JUNK
"""

LABEL_TEXT = """libname library 'somewhere' ;
/* origin codes */
  value i94cntyl
   582 =  'MEXICO'
   111 =  '  FRANCE'
   245 =  'SPAIN'
   999 =  'INVALID: STATELESS'
   996 =  'No Country Code (996)' ;

/* ports */
  value $i94prtl
   'NYC'\t=\t'NEW YORK, NY         '
   'QHB'\t=\t'QUAY''S HARBOUR, ZZ   '
   'VGR'\t=\t'VALE - GREEN REACH, YY'
   'XXX'\t=\t'No PORT Code (XXX)'
   'TWO'\t=\t'A, B, C'
;

value i94addrl
\t'NY'='NEW YORK'
\t'88'='Somewhere Else' ;
"""

PORTS_HTML = """<html><body><table>
<tr><th>Code</th><th>Location</th><th>Code</th><th>Location</th></tr>
<tr><td>NYC</td><td>New York, NY</td><td>MIA</td><td>Miami, FL</td></tr>
<tr><td>BOS</td><td>Boston, MA</td></tr>
<tr><td>Port</td><td>Not a code, XX</td></tr>
<tr><td>AGA</td><td>Agana</td></tr>
<tr><td>ANC</td><td><b>Anchorage</b>, AK</td></tr>
<tr><td>SAN</td><td>San Diego &amp; Tijuana, CA</td></tr>
</table></body></html>"""

TEMPERATURES_CSV = """dt,AverageTemperature,City,Country
2013-03-28,-1.0,New York,United States
2012-03-29,-1.0,New York,United States
2013-03-28,25.0,Miami,United States
2012-03-29,27.0,Miami,United States
2013-01-01,5.0,New York,United States
2013-03-28,15.0,Boston,United States
2013-03-28,,Anchorage,United States
2006-03-30,99.0,Miami,United States
2013-03-28,35.0,Paris,France
2013-05-02,35.0,Portland,United States
2013-05-02,15.0,Portland,United States
"""

GDP_CSV = (
    "T02,GDP and GDP per capita,,,,,\n"
    "Region/Country/Area,,Year,Series,Value,Footnotes,Source\n"
    '1,"Total, all countries or areas",2017,GDP per capita (US dollars),"10,000",,UN\n'
    '484,Mexico,2017,GDP per capita (US dollars),"8,910",,UN\n'
    '484,Mexico,2016,GDP per capita (US dollars),"8,700",,UN\n'
    '484,Mexico,2017,GDP in current prices (millions of US dollars),"1,158,000",,UN\n'
    '250,France,2017,GDP per capita (US dollars),"38,000",,UN\n'
    '531,Cura\xe7ao,2017,GDP per capita (US dollars),"19,500",,UN\n'
    '724,Spain,2017,GDP per capita (US dollars),n/a,,UN\n'
)

AIRPORTS_CSV = """ident,name,iso_country,iso_region,municipality,type,iata_code
KLGA,La Guardia,US,US-NY,New York,large_airport,LGA
KJFK,John F Kennedy Intl,US,US-NY,New York,large_airport,JFK
KMIA,Miami Intl,US,US-FL,Miami,large_airport,MIA
KBOS,Logan Intl,US,US-MA,Boston,large_airport,
KXYZ,Small Field,US,US-FL,Miami,small_airport,XYZ
CYYZ,Toronto Pearson,CA,CA-ON,Toronto,large_airport,YYZ
PANC,Anchorage Intl,US,US-AK,Anchorage,large_airport,ANC
"""

COUNTRIES_CSV = """name,alpha2,alpha3,languages
Mexico,MX,MEX,spa
France,FR,FRA,"fra,eng"
Spain,ES,ESP,"spa,xxx"
Nolang,NL,NLX,
Noalpha,NA,,spa
"""

LANGUAGES_CSV = """name,alpha2,alpha3
Spanish,es,spa
French,fr,fra
English,en,eng
German,de,deu
"""


def write_fixtures(spark: SparkSession, root: str) -> dict[str, str]:
    schema = "i94port string, i94cit double, arrdate double, i94mode double, biryear double, gender string"
    paths = {}
    for name, rows in (("arrivals_a", ARRIVALS_A), ("arrivals_b", ARRIVALS_B)):
        p = f"{root}/{name}.parquet"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(p)
        paths[name] = p
    pages = f"{root}/ports_pages.parquet"
    spark.createDataFrame([("https://example.org/ports", PORTS_HTML)], "url string, html string") \
        .coalesce(1).write.mode("overwrite").parquet(pages)
    paths["ports_pages"] = pages
    texts = {"country_labels.csv": (COUNTRY_LABELS_CSV, "utf-8"), "labels.sas": (LABEL_TEXT, "utf-8"),
             "temperatures.csv": (TEMPERATURES_CSV, "utf-8"), "gdp.csv": (GDP_CSV, "latin-1"),
             "airports.csv": (AIRPORTS_CSV, "utf-8"), "countries.csv": (COUNTRIES_CSV, "utf-8"),
             "languages.csv": (LANGUAGES_CSV, "utf-8")}
    for name, (text, enc) in texts.items():
        with open(os.path.join(root, name), "w", encoding=enc) as f:
            f.write(text)
        paths[name] = os.path.join(root, name)
    return paths
