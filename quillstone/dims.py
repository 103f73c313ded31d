"""Dimension tables: document types, publishers, labels, series, expectations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Code, label; the group is the code's letter, A to F are in scope.
DOC_TYPES = """
A1|Rate-decision press release
A2|Policy statement
A3|Meeting minutes / accounts / summary of deliberations
A4|Voting record
B1|Press-conference transcript / Q&A
B2|Opening remarks / webcast notes
C1|Speech
C2|Interview / op-ed / testimony
D1|Working paper
D2|Occasional / discussion paper / staff note
D3|Economic letter / research blog
E1|Monetary policy / inflation report
E2|Financial stability report
E3|Annual report
E4|Economic / quarterly bulletin
F1|Staff economic projections / forecasts
G1|Regulatory notice / consultation
G2|Statistical release
G3|Supervisory report
"""

# Code, name, country, ISO code, official domain, speech-list label
# (empty: the name), languages (empty: en), and ? where the domain is to be checked.
BANKS = """
dz|Bank of Algeria|Algeria|DZ|bank-of-algeria.dz||fr ar|?
ar|Central Bank of Argentina|Argentina|AR|bcra.gob.ar||es|
au|Reserve Bank of Australia|Australia|AU|rba.gov.au|||
at|Oesterreichische Nationalbank|Austria|AT|oenb.at||de en|
be|National Bank of Belgium|Belgium|BE|nbb.be||nl fr en|
ba|Central Bank of Bosnia and Herzegovina|Bosnia and Herzegovina|BA|cbbh.ba||bs en|?
br|Central Bank of Brazil|Brazil|BR|bcb.gov.br||pt en|
bg|Bulgarian National Bank|Bulgaria|BG|bnb.bg||bg en|
ca|Bank of Canada|Canada|CA|bankofcanada.ca||en fr|
cl|Central Bank of Chile|Chile|CL|bcentral.cl||es en|
cn|People's Bank of China|China|CN|pbc.gov.cn||zh en|
co|Central Bank of Colombia|Colombia|CO|banrep.gov.co||es|
hr|Croatian National Bank|Croatia|HR|hnb.hr||hr en|
cz|Czech National Bank|Czechia|CZ|cnb.cz||cs en|
dk|Danmarks Nationalbank|Denmark|DK|nationalbanken.dk||da en|
ee|Eesti Pank|Estonia|EE|eestipank.ee||et en|
ecb|European Central Bank|Euro area|EU|ecb.europa.eu|||
fi|Bank of Finland|Finland|FI|suomenpankki.fi||fi en|
fr|Bank of France|France|FR|banque-france.fr||fr en|
de|Deutsche Bundesbank|Germany|DE|bundesbank.de||de en|
gr|Bank of Greece|Greece|GR|bankofgreece.gr||el en|
hk|Hong Kong Monetary Authority|Hong Kong SAR|HK|hkma.gov.hk||en zh|
hu|Magyar Nemzeti Bank|Hungary|HU|mnb.hu||hu en|
is|Central Bank of Iceland|Iceland|IS|cb.is||is en|
in|Reserve Bank of India|India|IN|rbi.org.in|||
id|Bank Indonesia|Indonesia|ID|bi.go.id||id en|
ie|Central Bank of Ireland|Ireland|IE|centralbank.ie|||
il|Bank of Israel|Israel|IL|boi.org.il||he en|
it|Bank of Italy|Italy|IT|bancaditalia.it||it en|
jp|Bank of Japan|Japan|JP|boj.or.jp||ja en|
kr|Bank of Korea|Korea|KR|bok.or.kr||ko en|
kw|Central Bank of Kuwait|Kuwait|KW|cbk.gov.kw||ar en|?
lv|Latvijas Banka|Latvia|LV|bank.lv||lv en|
lt|Lietuvos bankas|Lithuania|LT|lb.lt||lt en|
lu|Banque centrale du Luxembourg|Luxembourg|LU|bcl.lu||fr en|
my|Bank Negara Malaysia|Malaysia|MY|bnm.gov.my|Central Bank of Malaysia|ms en|
mx|Bank of Mexico|Mexico|MX|banxico.org.mx||es en|
ma|Bank Al-Maghrib|Morocco|MA|bkam.ma||fr ar|?
nl|De Nederlandsche Bank|Netherlands|NL|dnb.nl|Netherlands Bank|nl en|
nz|Reserve Bank of New Zealand|New Zealand|NZ|rbnz.govt.nz|||
mk|National Bank of the Republic of North Macedonia|North Macedonia|MK|nbrm.mk||mk en|?
no|Norges Bank|Norway|NO|norges-bank.no||no en|
pe|Central Reserve Bank of Peru|Peru|PE|bcrp.gob.pe||es en|
ph|Bangko Sentral ng Pilipinas|Philippines|PH|bsp.gov.ph|||
pl|Narodowy Bank Polski|Poland|PL|nbp.pl|National Bank of Poland|pl en|
pt|Banco de Portugal|Portugal|PT|bportugal.pt|Bank of Portugal|pt en|
ro|National Bank of Romania|Romania|RO|bnr.ro||ro en|
ru|Central Bank of the Russian Federation|Russia|RU|cbr.ru||ru en|
sa|Saudi Central Bank|Saudi Arabia|SA|sama.gov.sa||ar en|
rs|National Bank of Serbia|Serbia|RS|nbs.rs||sr en|
sg|Monetary Authority of Singapore|Singapore|SG|mas.gov.sg|||
sk|Narodna banka Slovenska|Slovakia|SK|nbs.sk|National Bank of Slovakia|sk en|
si|Banka Slovenije|Slovenia|SI|bsi.si|Bank of Slovenia|sl en|
za|South African Reserve Bank|South Africa|ZA|resbank.co.za|||
es|Banco de Espana|Spain|ES|bde.es|Bank of Spain|es en|
se|Sveriges Riksbank|Sweden|SE|riksbank.se||sv en|
ch|Swiss National Bank|Switzerland|CH|snb.ch||de en fr|
th|Bank of Thailand|Thailand|TH|bot.or.th||th en|
tr|Central Bank of the Republic of Turkiye|Turkiye|TR|tcmb.gov.tr|Central Bank of the Republic of Turkey|tr en|
ae|Central Bank of the United Arab Emirates|United Arab Emirates|AE|centralbank.ae||ar en|?
gb|Bank of England|United Kingdom|GB|bankofengland.co.uk|||
us|Federal Reserve System|United States|US|federalreserve.gov|Board of Governors of the Federal Reserve System||
vn|State Bank of Vietnam|Vietnam|VN|sbv.gov.vn||vi en|?
"""

# Other labels of a publisher.
ALIASES = """
lv|Bank of Latvia
lv|Bank of Lativa
lt|Bank of Lithuania
lu|Central Bank of Luxembourg
ru|Bank of Russia
ru|Central Bank of Russia
sa|Saudi Arabian Monetary Agency
sa|Saudi Arabian Monetary Authority
tr|Central Bank of the Republic of Turkiye
mk|National Bank of the Republic of Macedonia
pt|Banco de Portugal
si|Banka Slovenije
ma|Bank of Morocco
co|Banco de la Republica
hu|Central Bank of Hungary
hu|National Bank of Hungary
ph|Central Bank of the Philippines
us|Board of Governors of the US Federal Reserve System
es|Banco de Espana
my|Bank Negara Malaysia
nl|De Nederlandsche Bank
pl|Narodowy Bank Polski
sk|Narodna banka Slovenska
"""

# Publisher, series handle, document type.
SERIES = """
ecb|ecb:ecbwps|D1
ecb|ecb:ecbops|D2
us|fip:fedgfe|D1
us|fip:fedgif|D1
gb|boe:boeewp|D1
de|zbw:bubdps|D1
it|bdi:wptemi|D1
es|bde:wpaper|D1
fr|bfr:banfra|D1
ca|bca:bocawp|D1
jp|boj:bojwps|D1
ch|snb:snbwpa|D1
se|hhs:rbnkwp|D1
nl|dnb:dnbwpp|D1
au|rba:rbardp|D1
"""

# Publisher, type, documents expected a year.
EXPECTED = """
us|A2|8
us|A3|8
us|F1|4
ecb|A1|8
ecb|A2|8
ecb|A3|8
ecb|E4|8
au|A1|8
au|A3|8
au|E1|4
"""

# Publisher and the types of its own sources; C1, D1 and D2 come
# from shared catalogues for all.
NATIVE_TYPES = {"ecb": "A1 A2 A3 E4 D1 D2", "us": "A2 A3 F1 D1", "au": "A1 A3 E1", "jp": "A3 D1", "gb": "D1", "de": "D1", "ch": "A2 E2", "ca": "A3 E1", "fr": "E2"}
SHARED_TYPES = ("C1", "D1", "D2")

# Publisher, documents its catalogue holds.
TARGETS = {"us": 4198, "ecb": 3658, "ca": 1360, "it": 1211, "gb": 1128, "es": 1088, "fr": 1005, "de": 691, "au": 536, "jp": 405, "se": 391, "ch": 318, "nl": 200}


def _rows(block: str) -> list[list[str]]:
    return [line.split("|") for line in block.strip().splitlines()]


def doc_types(spark: SparkSession) -> DataFrame:
    rows = [(code, code[0], label, code[0] <= "F") for code, label in _rows(DOC_TYPES)]
    return spark.createDataFrame(rows, "doc_type string, type_group string, label string, in_scope boolean")


def banks(spark: SparkSession) -> DataFrame:
    rows = [(c, name, country, iso, home, label or name, (langs or "en").split(), check == "?") for c, name, country, iso, home, label, langs, check in _rows(BANKS)]
    return spark.createDataFrame(rows, "bank_code string, name string, country string, iso2 string, homepage string, label string, languages array<string>, verify boolean")


def labels(spark: SparkSession) -> DataFrame:
    """All labels of a publisher, with the primary one."""
    own = banks(spark).select("bank_code", "label", F.col("label").alias("primary_label"))
    other = spark.createDataFrame([tuple(r) for r in _rows(ALIASES)], "bank_code string, label string")
    return own.unionByName(other.join(own.select("bank_code", "primary_label"), "bank_code"))


def series(spark: SparkSession) -> DataFrame:
    rows = [(b, h, *h.split(":"), t, k) for k, (b, h, t) in enumerate(_rows(SERIES))]
    return spark.createDataFrame(rows, "bank_code string, handle string, archive string, series string, doc_type string, series_pos int")


def expected(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(b, t, int(n)) for b, t, n in _rows(EXPECTED)], "bank_code string, doc_type string, expected int")


def supported_types(spark: SparkSession) -> DataFrame:
    """Types of a publisher: its own, then the shared ones, each once."""
    rows = []
    for code, *_ in _rows(BANKS):
        own = dict.fromkeys([*NATIVE_TYPES.get(code, "").split(), *SHARED_TYPES])
        rows += [(code, t, k) for k, t in enumerate(own)]
    return spark.createDataFrame(rows, "bank_code string, doc_type string, pos int")


def targets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TARGETS.items()), "bank_code string, target int")
