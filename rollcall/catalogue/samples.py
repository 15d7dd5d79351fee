"""Candidate, fund and page rows derived from the shared test tables.

The SQL is written once for two dialects; only row repetition differs between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans import medallion
from ..session import scratch_path

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "labels", "pages", "conversations", "benchmark",
]

# One syllable per digit, for place and person names in letters.
SYLLABLES = ["ara", "bel", "chi", "dho", "gun", "jha", "kot", "mur", "nag", "pal"]

# Raw state spelling per nation key.
RAW_STATES = [
    "ORISSA", "Andhra Pradesh", "jammu and kashmir", "NCT OF DELHI", "DADRA AND NAGAR HAVELI",
    "Pondicherry", "UTTARANCHAL", "Chattisgarh", "Andaman&Nicobar Islands", "DELHI (NCT)",
    "BIHAR", "Goa", "GUJARAT", "Haryana", "KERALA", "Karnataka ", "Madhya  Pradesh", "MAHARASHTRA",
    "Punjab", "RAJASTHAN", "Tamil Nadu", "TRIPURA", "Uttar Pradesh", "WEST BENGAL", "",
]


def spelled(number: str) -> str:
    text = f"CAST({number} AS STRING)"
    for digit, syllable in enumerate(SYLLABLES):
        text = f"replace({text}, '{digit}', '{syllable}')"
    return text


def raw_state(key: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(RAW_STATES))
    return f"CASE {key} {arms} END"


def person(custkey: str) -> tuple[str, str]:
    text = spelled(f"({custkey} + 1000)")
    return f"substr({text}, 1, 6)", f"substr({text}, 7)"


FIRST, LAST = "substr(person, 1, 6)", "substr(person, 7)"

CANDIDATES = f"""
SELECT CAST(year(o_orderdate) AS INT) AS election_year,
       {raw_state('n_nationkey')} AS state,
       concat(place,
              CASE seat % 5 WHEN 0 THEN ' (SC)' WHEN 1 THEN '  (st)' ELSE '' END) AS constituency,
       CAST(seat AS INT) AS constituency_id,
       CAST(CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderkey END AS BIGINT) AS candidate_id,
       concat(CASE WHEN c_custkey % 4 = 0 THEN 'K.' ELSE '' END, {FIRST}, '  ', {LAST}) AS name,
       CASE WHEN seat % 3 = 0 THEN 'Ind'
            WHEN c_custkey % 7 = 6 THEN concat('Front  ', {spelled('(c_custkey % 90)')})
            WHEN c_custkey % 11 = 10 THEN NULL
            ELSE c_mktsegment END AS party,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderkey % 6 AS INT) END AS criminal_cases,
       CASE o_orderkey % 12 WHEN 0 THEN 'Illiterate' WHEN 1 THEN 'Literate' WHEN 2 THEN '5th Pass'
            WHEN 3 THEN '8th Pass' WHEN 4 THEN '10th  Pass' WHEN 5 THEN '12TH PASS' WHEN 6 THEN 'Graduate'
            WHEN 7 THEN 'Graduate Professional' WHEN 8 THEN 'post graduate' WHEN 9 THEN 'Doctorate'
            WHEN 10 THEN 'Not Given' ELSE NULL END AS education,
       CAST(15 + c_custkey % 95 AS INT) AS age,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL
            ELSE CAST(round(o_totalprice * 100) AS BIGINT) + copy * 100 END AS assets,
       CAST(round(c_acctbal * 100) AS BIGINT) AS liabilities,
       c_custkey % 15 = year(o_orderdate) % 2 AS is_winner,
       o_orderkey % 71 = 0 AS is_bye_election
FROM (SELECT *, {{copies:CASE WHEN o_orderkey % 23 = 0 THEN 2 ELSE 1 END}} AS copy
      FROM {{orders}} JOIN (
             SELECT *, CAST(floor(c_custkey / 15) AS BIGINT) AS seat,
                    {spelled('(c_custkey + 1000)')} AS person,
                    {spelled('(CAST(floor(c_custkey / 15) AS BIGINT) + 100)')} AS place
             FROM {{customer}}) AS people ON o_custkey = c_custkey
           JOIN {{nation}} ON n_nationkey = seat % 25) AS entries
"""

_HOLDER = "(15 * s_suppkey + CASE WHEN s_suppkey % 5 = 4 THEN 2 ELSE 1 END)"
MP_FIRST, MP_LAST = FIRST, LAST
_SEAT = "place"

FUNDS = f"""
SELECT s_suppkey AS mp_id,
       {raw_state('n_nationkey')} AS state,
       CASE s_suppkey % 4 WHEN 0 THEN concat(upper({_SEAT}), ' (SC)')
            WHEN 1 THEN replace({_SEAT}, 'chi', 'ci')
            WHEN 2 THEN {_SEAT}
            ELSE replace({_SEAT}, 'bel', 'bhel') END AS constituency,
       CASE s_suppkey % 6 WHEN 0 THEN concat('SHRI ', upper({MP_FIRST}), ' ', upper({MP_LAST}))
            WHEN 1 THEN concat({MP_LAST}, ' ', {MP_FIRST})
            WHEN 2 THEN concat({MP_FIRST}, {MP_LAST})
            WHEN 3 THEN concat({MP_FIRST}, ' (', {MP_LAST}, ')')
            WHEN 4 THEN concat('Dr. ', {MP_FIRST}, ' ', {MP_LAST}, ' S/O Ram')
            ELSE concat(replace({MP_FIRST}, 'bel', 'bal'), ' ', {MP_LAST}, 'u') END AS mp_name,
       CASE WHEN s_suppkey % 11 = 0 OR copy = 1 THEN NULL ELSE cents END AS allocated,
       CASE WHEN copy = 1 THEN 0 ELSE open_cents END AS expenditure,
       n AS works_recommended, n_shipped AS works_sanctioned,
       CASE WHEN s_suppkey % 9 = 0 THEN n + 1 ELSE n_returned END AS works_completed
FROM (SELECT *, {{copies:CASE WHEN s_suppkey % 13 = 0 THEN 2 ELSE 1 END}} AS copy
      FROM (SELECT l_suppkey,
                   CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
                   CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(round(l_extendedprice * 100) AS BIGINT)
                                 ELSE 0 END) AS BIGINT) AS open_cents,
                   count(*) AS n,
                   CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_shipped,
                   CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS n_returned
            FROM {{lineitem}} GROUP BY l_suppkey) AS works
           JOIN (SELECT *, {spelled(f"({_HOLDER} + 1000)")} AS person, {spelled("(s_suppkey + 100)")} AS place
                 FROM {{supplier}}) AS holders ON l_suppkey = s_suppkey
           JOIN {{nation}} ON n_nationkey = s_suppkey % 25) AS seats
"""

_AMOUNT = "CAST(round(o_totalprice * 1000) AS BIGINT)"

# Money cells in the spellings of the source, one per order.
MONEY_CELLS = f"""
SELECT o_orderkey,
       CASE o_orderkey % 8
            WHEN 0 THEN concat('Rs ', CAST({_AMOUNT} AS STRING), ' ~ 3 Crore+')
            WHEN 1 THEN concat('Rs&nbsp;', CAST(CAST(floor({_AMOUNT} / 1000) AS BIGINT) AS STRING), ',',
                               substr(CAST({_AMOUNT} % 1000 + 1000 AS STRING), 2), '&nbsp;~')
            WHEN 2 THEN 'Nil' WHEN 3 THEN '--' WHEN 4 THEN ' Not Given '
            WHEN 5 THEN concat('<b>rs. ', CAST({_AMOUNT} AS STRING), '</b>')
            WHEN 6 THEN concat('about ', CAST({_AMOUNT} AS STRING), ' only')
            ELSE '' END AS cell,
       CASE WHEN o_orderkey % 8 IN (0, 1, 5, 6) THEN {_AMOUNT}
            WHEN o_orderkey % 8 = 2 THEN 0 END AS figure
FROM {{orders}}
"""


def _fill(sql: str, copies: str, names: dict[str, str] | None = None) -> str:
    while "{copies:" in sql:
        head, _, tail = sql.partition("{copies:")
        expr, _, rest = tail.partition("}")
        sql = head + copies.format(expr) + rest
    return sql.format(**names) if names else sql


def for_spark(sql: str) -> str:
    return _fill(sql, "explode(sequence(CAST(0 AS BIGINT), CAST({} AS BIGINT) - 1))")


def for_duckdb(sql: str) -> str:
    names = {t: t for t in TABLES}
    sql = _fill(sql, "unnest(range(0, {}))", names)
    return sql.replace("AS STRING)", "AS VARCHAR)")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def wide_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table whose rows need much work each. The test tables are files of one row group, which no setting splits, so their
    rows are dealt out; tables in many files need no such step."""
    return table(spark, folder, name).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def run_sql(spark: SparkSession, folder: str, sql: str, **given: DataFrame) -> DataFrame:
    used = {t: table(spark, folder, t) for t in TABLES if f"{{{t}}}" in sql and t not in given}
    return spark.sql(for_spark(sql), **used, **given)


#: Bytes of the customer table beyond which Spark, as it is set by default, joins by a shuffle.
SHUFFLED_BYTES = 10 << 20


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Orders are dealt out where the customers are few enough for a broadcast; otherwise the join shuffles them anyway."""
    length, _ = _fingerprint(spark, f"{folder}/customer.parquet")
    given = {"orders": wide_table(spark, folder, "orders")} if length <= SHUFFLED_BYTES else {}
    return run_sql(spark, folder, CANDIDATES, **given)


def funds(spark: SparkSession, folder: str) -> DataFrame:
    return run_sql(spark, folder, FUNDS)


def money_cells(spark: SparkSession, folder: str) -> DataFrame:
    return run_sql(spark, folder, MONEY_CELLS, orders=wide_table(spark, folder, "orders"))


_written: dict[tuple, tuple[str, object]] = {}


def _fingerprint(spark: SparkSession, path: str) -> tuple[int, int]:
    """Size and time of change of a table's files."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(where).getLength(), files.getFileStatus(where).getModificationTime()


def silver(spark: SparkSession, folder: str) -> DataFrame:
    """The silver table, written once per session and input, then read by every mart."""
    inputs = [f"{folder}/{name}.parquet" for name in ("orders", "customer", "nation")]
    seen = tuple(_fingerprint(spark, path) for path in inputs)
    key = (spark.sparkContext.applicationId, folder, seen)
    if key not in _written:
        built = medallion.build_silver(candidates(spark, folder))
        path = scratch_path(spark, "silver")
        built.write.partitionBy("election_year").parquet(path)
        _written[key] = (path, built.schema)
    path, schema = _written[key]
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def written(spark: SparkSession, label: str) -> str:
    """A new scratch folder for one query's files."""
    return scratch_path(spark, label)


# A page with one candidate row, as the source lays it out; one per candidate.
CANDIDATE_PAGES = f"""
SELECT election_year, constituency_id, candidate_id AS entry_id,
       concat('<html><h3>List of Candidates in ', constituency, ' : ',
              CASE WHEN is_bye_election THEN 'BYE ELECTION ON 04-02-2017 : ' ELSE '' END,
              state, ' Lok Sabha ', CAST(election_year AS STRING), '</h3>',
              '<table><tr><td>menu</td></tr></table>',
              '<table class="w3"><tr><td>Sno</td><td>Candidate</td><td>Party</td><td>Cases</td>',
              '<td>Education</td><td>Age</td><td>Assets</td><td>Liabilities</td></tr>',
              '<tr><td>1</td><td><a href="candidate.php',
              coalesce(concat('?candidate_id=', CAST(candidate_id AS STRING)), ''), '">', name, '</a>', CASE WHEN is_winner THEN ' &nbsp <font>Winner</font>' ELSE '' END,
              '</td><td>', coalesce(party, ''), '</td><td><b>', coalesce(CAST(criminal_cases AS STRING), ''),
              '</b></td><td>', coalesce(education, '--'), '</td><td>', CAST(age AS STRING),
              '</td><td>', coalesce(concat('Rs&nbsp;', CAST(assets AS STRING), ' ~'), 'Not Given'),
              '</td><td>', CASE WHEN liabilities > 0 THEN concat('Rs ', CAST(liabilities AS STRING)) ELSE 'Nil' END,
              '</td></tr><tr><td></td><td>Total</td><td></td><td></td><td></td><td></td><td></td><td></td></tr>',
              '</table></html>') AS html
FROM {{entries}}
"""


#: Bytes of the orders table whose pages one task builds and reads.
PAGE_TASK_BYTES = 2 << 20


def candidate_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The entries are dealt out behind their join, whose few compact partitions hold far more pages than one task should
    parse; into more parts as the table grows."""
    length, _ = _fingerprint(spark, f"{folder}/orders.parquet")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), length // PAGE_TASK_BYTES)
    return spark.sql(CANDIDATE_PAGES, entries=run_sql(spark, folder, CANDIDATES).repartition(n))


def seat_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One page per seat, year and kind of contest, with a row per candidate, a shorter table before and a table of as many
    rows behind; pages of some seats are empty, others have no table. The link of a page names its seat, in some wrongly."""
    rows = run_sql(spark, folder, CANDIDATES)

    def cell(text: Column) -> Column:
        return F.concat(F.lit("<td>"), F.coalesce(text, F.lit("")), F.lit("</td>"))

    link = F.coalesce(F.concat(F.lit("?candidate_id="), F.col("candidate_id").cast("string")), F.lit(""))
    mark = F.when(F.col("is_winner"), " &nbsp <font>Winner</font>").otherwise("")
    amount = F.coalesce(F.concat(F.lit("Rs&nbsp;"), F.col("assets").cast("string"), F.lit(" ~")), F.lit("Not Given"))
    debts = F.when(F.col("liabilities") > 0, F.concat(F.lit("Rs "), F.col("liabilities").cast("string"))).otherwise("Nil")
    cells = [
        cell(F.lit("1")), cell(F.concat(F.lit('<a href="c.php'), link, F.lit('">'), "name", F.lit("</a>"), mark)), cell(F.col("party")),
        cell(F.concat(F.lit("<b>"), F.col("criminal_cases").cast("string"), F.lit("</b>"))), cell(F.coalesce("education", F.lit("--"))),
        cell(F.col("age").cast("string")), cell(amount), cell(debts),
    ]
    row, decoy = F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")), F.concat(F.lit("<tr>"), *[cell(F.lit("decoy"))] * 8, F.lit("</tr>"))
    keys = ["election_year", "constituency_id", "state", "constituency", "is_bye_election"]
    pages = rows.groupBy(*keys).agg(F.array_join(F.collect_list(row), "").alias("rows"), F.array_join(F.collect_list(decoy), "").alias("decoys"))
    bye = F.when(F.col("is_bye_election"), "BYE ELECTION ON 04-02-2017 : ").otherwise("")
    head = F.concat(
        F.lit("<html><h3>List of Candidates in "), "constituency", F.lit(" : "), bye, "state", F.lit(" Lok Sabha "),
        F.col("election_year").cast("string"), F.lit("</h3><table><tr><td>menu</td></tr></table>"),
    )
    body = F.concat(head, F.lit("<table>"), "rows", F.lit("</table><table>"), "decoys", F.lit("</table></html>"))
    seat = F.col("constituency_id") + F.when(F.col("is_bye_election"), 0).otherwise(1)
    empty, bare = seat % 9 == 0, seat % 11 == 0
    named = F.when(seat % 7 == 0, F.lit("ELSEWHERE")).otherwise(F.upper(F.regexp_replace("constituency", r" .*$", "")))
    return pages.select(
        "election_year", "constituency_id", F.concat(F.lit("page "), seat.cast("string"), F.lit("#"), named).alias("source_url"),
        F.when(empty, " ").when(bare, head).otherwise(body).alias("html"),
    )


# Two writings of one person's name, or of two people, one pair per customer.
NAME_PAIRS = f"""
SELECT c_custkey, a, CASE c_custkey % 9
         WHEN 0 THEN concat('Shri ', upper(a)) WHEN 1 THEN concat(l, ' ', f)
         WHEN 2 THEN concat(f, l) WHEN 3 THEN concat(f, ' (', l, ')')
         WHEN 4 THEN concat('Dr. ', a, ' S/O Ram') WHEN 5 THEN concat(replace(f, 'bel', 'bal'), ' ', l, 'u')
         WHEN 6 THEN concat(f, ' Alias ', l, ' Kumar') WHEN 7 THEN b ELSE '' END AS b
FROM (SELECT c_custkey, {FIRST} AS f, {LAST} AS l, concat({FIRST}, ' ', {LAST}) AS a,
             concat('J P ', {person('(c_custkey + 1)')[0]}, ' ', {person('(c_custkey * 7 + 3)')[1]}) AS b
      FROM (SELECT *, {spelled('(c_custkey + 1000)')} AS person FROM {{customer}}) AS named) AS people
"""

# Rupee figures of every display range, one per order.
FIGURES = """
SELECT o_orderkey,
       CASE o_orderkey % 6 WHEN 0 THEN cents * 1000 WHEN 1 THEN cents
            WHEN 2 THEN CAST(floor(cents / 100) AS BIGINT) WHEN 3 THEN CAST(floor(cents / 10000) AS BIGINT)
            WHEN 4 THEN CAST(floor(cents / 100000) AS BIGINT) END AS figure
FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM {orders}) AS amounts
"""

# The other source's rows, one per supplier.
CROSS_CHECK = """
SELECT CASE WHEN s_suppkey % 4 = 3 THEN 'Rajya Sabha' ELSE 'Lok Sabha' END AS house,
       CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE CAST(cents AS DOUBLE) + 0.75 END AS allocatedAmount,
       CAST(open_cents - 1000 AS DOUBLE) AS totalExpenditure,
       CASE WHEN s_suppkey % 6 = 0 THEN n + 2 ELSE n_returned END AS completedWorksCount,
       CASE WHEN s_suppkey % 8 = 7 THEN NULL ELSE n END AS recommendedWorksCount
FROM (SELECT l_suppkey,
             CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
             CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(round(l_extendedprice * 100) AS BIGINT)
                           ELSE 0 END) AS BIGINT) AS open_cents,
             count(*) AS n,
             CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS n_returned
      FROM {lineitem} GROUP BY l_suppkey) AS works
     JOIN {supplier} ON l_suppkey = s_suppkey
"""
