"""The same results in DuckDB SQL, written from the rules and not from the Spark plans."""

from __future__ import annotations

from ..functions import lookups
from ..plans import funds as fund_plan
from . import samples
from .queries import FIRST, LATEST, LIST_BLOCK, NEEDLE, RECONCILED, SCARCE_BLOCK, STATE

SPACE = r"[\s\p{Z}\x{85}]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def case_map(value: str, table: dict, default: str) -> str:
    arms = " ".join(f"WHEN {quoted(k)} THEN {quoted(v) if isinstance(v, str) else v}" for k, v in table.items())
    return f"CASE {value} {arms} ELSE {default} END"


def sub(text: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({text}, {quoted(pattern)}, {quoted(to)}, 'g')"


def collapse(text: str) -> str:
    return f"trim({sub(text, SPACE, ' ')})"


def tidy(text: str) -> str:
    return f"trim({sub(sub(collapse(text), r'\s*&\s*', ' & '), r'\s*\.\s*', '. ')})"


def title(text: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all(lower({text}), '\p{{L}}+|\P{{L}}+'), "
        r"lambda w: (CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END) || w[2:]), '')"
    )


def conform_state(text: str) -> str:
    spaced = sub(collapse(text), r"\s*&\s*", " & ")
    conformed = sub(title(spaced), r"\bAnd\b", "&")
    return case_map(conformed, lookups.STATE_ALIASES, conformed)


def seat_category(text: str) -> str:
    return (
        rf"CASE WHEN regexp_matches({text}, '(?i)\(\s*SC\s*\)') THEN 'SC' "
        rf"WHEN regexp_matches({text}, '(?i)\(\s*ST\s*\)') THEN 'ST' ELSE 'GEN' END"
    )


def strip_tag(text: str) -> str:
    return f"trim({sub(text, r'(?i)\s*\((sc|st)\)\s*$')})"


def key_part(text: str) -> str:
    plain = f"replace({sub(f'upper(coalesce({text}, {quoted('')}))', r'\(\s*(SC|ST)\s*\)')}, '&', ' AND ')"
    return sub(plain, "[^A-Z]")


def ratio(num: str, den: str, digits: int) -> str:
    """Half up on the exact value, away from zero."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (
        f"CASE WHEN {d} > 0 THEN CAST(sign({n}) * ((abs({n}) * {2 * 10**digits} + {d}) // (2 * {d})) AS DOUBLE)"
        f" / CAST({10**digits} AS DOUBLE) END"
    )


def share(flag: str, digits: int = 1) -> str:
    return ratio(f"100 * count(*) FILTER (WHERE {flag})", f"count({flag})", digits)


def mean(col: str, digits: int = 1) -> str:
    return ratio(f"coalesce(sum({col}), 0)", f"count({col})", digits)


def clean_html(text: str) -> str:
    out = sub(f"coalesce({text}, '')", "<[^>]+>", " ")
    for entity, plain in lookups.ENTITIES:
        out = f"replace({out}, {quoted(entity)}, {quoted(plain)})"
    return collapse(sub(out, r"&#\d+;", " "))


RANK = case_map("lower(education)", lookups.EDUCATION_RANKS, "NULL")


def education_group(rank: str) -> str:
    low, middle, high, unknown = (quoted(g) for g in lookups.EDUCATION_GROUPS)
    return (
        f"CASE WHEN {rank} >= 6 THEN {high} WHEN {rank} BETWEEN 2 AND 5 THEN {middle} "
        f"WHEN {rank} <= 1 THEN {low} ELSE {unknown} END"
    )


AGE_BAND = (
    "CASE WHEN age < 40 THEN 'Under 40' WHEN age < 55 THEN '40-54' WHEN age < 70 THEN '55-69' "
    "WHEN age >= 70 THEN '70+' ELSE 'Unknown' END"
)

RAW = f"raw AS ({samples.for_duckdb(samples.CANDIDATES)})"
FUNDS_RAW = f"funds_raw AS ({samples.for_duckdb(samples.FUNDS)})"

_LABEL = title(collapse("coalesce(education, 'Not Given')"))

# Row-level rules and party groups over all raw rows; silver is general contests, one row per key.
CONFORMED = f"""{RAW},
conformed0 AS (
  SELECT election_year, {conform_state("coalesce(state, '')")} AS state,
         {title(strip_tag(tidy('constituency')))} AS constituency, constituency_id, candidate_id,
         {tidy('name')} AS name, upper(coalesce({tidy('party')}, 'UNKNOWN')) AS party,
         coalesce(criminal_cases, 0) AS criminal_cases, {_LABEL} AS education,
         CASE WHEN age BETWEEN 21 AND 100 THEN age END AS age,
         CASE WHEN assets >= 0 THEN assets END AS assets,
         CASE WHEN liabilities >= 0 THEN liabilities END AS liabilities,
         is_winner, is_bye_election, {seat_category(tidy('constituency'))} AS seat_category
  FROM raw),
conformed1 AS (
  SELECT *, {RANK} AS education_rank,
         assets - coalesce(liabilities, 0) AS net_worth, assets >= {lookups.CRORE} AS is_crorepati,
         criminal_cases > 0 AS has_criminal_case, {AGE_BAND} AS age_band
  FROM conformed0),
major AS (
  SELECT DISTINCT party FROM (
    SELECT election_year, party FROM conformed1 WHERE is_winner AND NOT is_bye_election
    GROUP BY ALL HAVING count(*) >= {lookups.MAJOR_PARTY_WINS})),
conformed AS (
  SELECT *, {education_group('education_rank')} AS education_group,
         CASE WHEN party IN ('IND', 'INDEPENDENT') THEN 'Independent'
              WHEN party IN (SELECT party FROM major) THEN party ELSE 'Other parties' END AS party_group
  FROM conformed1)"""

_BEST = """row_number() OVER (PARTITION BY election_year, constituency_id, candidate_id, name
    ORDER BY assets DESC NULLS LAST, candidate_id NULLS LAST, liabilities DESC NULLS LAST,
             criminal_cases DESC NULLS LAST, is_winner DESC NULLS LAST, party NULLS LAST) = 1"""

SILVER = f"""{CONFORMED},
silver AS (SELECT * FROM conformed WHERE NOT is_bye_election QUALIFY {_BEST}),
winners AS (SELECT * FROM silver WHERE is_winner),
cohorts AS (SELECT *, '{lookups.ALL_CANDIDATES}' AS cohort FROM silver
            UNION ALL SELECT *, '{lookups.WINNERS}' AS cohort FROM winners)"""


def on_silver(sql: str) -> str:
    return f"WITH {SILVER} {sql}"


_TREND = f"""count(*) AS n, {share('has_criminal_case')} AS pct_criminal,
  {share('(criminal_cases >= 2)')} AS pct_multi_case, {share('is_crorepati')} AS pct_crorepati,
  {mean('age')} AS avg_age, {share('(education_rank >= 6)')} AS pct_graduate_plus,
  {mean('criminal_cases', 2)} AS avg_cases, quantile_disc(assets, 0.5) AS median_assets"""

TRENDS = f"""{SILVER},
national AS (SELECT election_year, cohort, {_TREND} FROM cohorts GROUP BY ALL),
by_state AS (SELECT state, election_year, cohort, {_TREND} FROM cohorts WHERE state <> '' GROUP BY ALL)"""

_PARTY = f"""count(*) AS candidates, count(*) FILTER (WHERE is_winner) AS seats_won,
  {share('has_criminal_case')} AS pct_criminal, quantile_disc(assets, 0.5) AS median_assets"""

PARTY = f"""SELECT election_year, party_group, {_PARTY}, {share('is_crorepati')} AS pct_crorepati,
  {mean('age')} AS avg_age, {ratio('100 * count(*) FILTER (WHERE is_winner)', 'count(*)', 1)} AS strike_rate
FROM silver GROUP BY ALL HAVING count(*) >= 5"""

PARTY_STATE = f"""SELECT election_year, state, party_group, {_PARTY} FROM silver WHERE state <> ''
GROUP BY ALL HAVING count(*) >= 5 OR count(*) FILTER (WHERE is_winner) > 0"""

STATES = f"""SELECT election_year, state, count(*) AS seats, {share('has_criminal_case')} AS pct_criminal,
  {share('is_crorepati')} AS pct_crorepati, {mean('age')} AS avg_age,
  CAST(sum(criminal_cases) AS BIGINT) AS total_cases, quantile_disc(assets, 0.5) AS median_assets
FROM winners WHERE state <> '' GROUP BY ALL"""


def dist(label: str, state: bool = False) -> str:
    scope = "state, " if state else ""
    where = "WHERE state <> '' " if state else ""
    return (
        f"SELECT election_year, {scope}{label}, count(*) AS candidates, "
        f"count(*) FILTER (WHERE is_winner) AS winners FROM silver {where}GROUP BY ALL"
    )


WINNERS = """SELECT election_year, state, constituency, seat_category, name, party, party_group,
  criminal_cases, education, education_group, age, assets, liabilities, net_worth, is_crorepati,
  candidate_id FROM winners"""


def board(label: str, by: str) -> str:
    return f"""SELECT '{label}' AS board,
  CAST(row_number() OVER (PARTITION BY election_year ORDER BY {by} DESC, candidate_id NULLS LAST, name NULLS LAST,
                          constituency NULLS LAST) AS INT) AS rank,
  election_year, name, party, state, constituency, assets, liabilities, criminal_cases, education, age,
  is_winner, candidate_id
FROM silver WHERE {by} IS NOT NULL QUALIFY rank <= 50"""


BOARDS = f"{board(lookups.RICHEST, 'assets')} UNION ALL {board(lookups.MOST_CASES, 'criminal_cases')}"

REPEATS = f"""{SILVER},
yearly AS (
  SELECT *, regexp_replace(upper(name), '[^A-Z ]', '', 'g') AS person FROM silver WHERE assets IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY person, state, election_year
          ORDER BY assets DESC, coalesce(candidate_id, {2**62}), name DESC) = 1),
people AS (
  SELECT person, state, count(*) AS elections_contested, count(*) FILTER (WHERE is_winner) AS elections_won,
         min(election_year) AS first_year, max(election_year) AS last_year,
         arg_min(assets, election_year) AS min_assets, arg_max(assets, election_year) AS max_assets,
         max(criminal_cases) AS peak_cases, arg_max(name, election_year) AS name
  FROM yearly GROUP BY person, state HAVING count(*) >= 2),
repeats AS (
  SELECT state, name, elections_contested, elections_won, first_year, last_year, min_assets, max_assets,
         peak_cases, {ratio('100 * (max_assets - min_assets)', 'min_assets', 0)} AS asset_growth_pct
  FROM people)"""


def contains_any(columns: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({c}, '')), '{NEEDLE}')" for c in columns) + ")"


WINNER_SEARCH = contains_any(["name", "party", "constituency", "state"])

# ---- funds

_FUND_STATE = case_map("upper(trim(state))", lookups.FUND_STATE_ALIASES, "state")

KEYED = f"""{FUNDS_RAW},
funds AS (
  SELECT * REPLACE ({_FUND_STATE} AS state) FROM funds_raw
  QUALIFY row_number() OVER (PARTITION BY {_FUND_STATE}, constituency
          ORDER BY coalesce(allocated, 0) DESC, coalesce(expenditure, 0) DESC, mp_id, mp_name) = 1),
keyed AS (
  SELECT *, {key_part('state')} AS block, {key_part('constituency')} AS key,
         {ratio('100 * expenditure', 'allocated', 1)} AS pct_spent
  FROM funds)"""

HOLDERS = f"""{SILVER}, {KEYED},
holders AS (
  SELECT *, {key_part('state')} AS block, {key_part('constituency')} AS key FROM winners
  WHERE election_year = (SELECT max(election_year) FROM silver)
  QUALIFY row_number() OVER (PARTITION BY {key_part('state')}, {key_part('constituency')}
          ORDER BY candidate_id DESC NULLS LAST, name NULLS LAST) = 1)"""


def similar(a: str, b: str) -> str:
    longest = f"greatest(length({a}), length({b}))"
    return f"(CASE WHEN {longest} = 0 THEN 1.0::DOUBLE ELSE 1 - levenshtein({a}, {b}) / {longest} END)"


def matched_letters(name: str, pairs: str) -> str:
    """CTEs ending in {name}(a, b, score): the Ratcliff/Obershelp ratio of distinct pairs.

    Each node is a range of both texts; its longest common run, the first in a and then in b,
    splits it in two. The ratio is twice the letters in all runs over all letters.
    """

    def longest_run(nodes: str) -> str:
        return f"""
  SELECT a, b, al, ah, bl, bh, arg_max({{'i': i, 'j': j, 'n': n}}, (n, -i, -j)) AS run
  FROM (SELECT *, len(list_filter(range(1, least(ah - i, bh - j) + 1),
                                  lambda l: substr(a, i + 1, l) = substr(b, j + 1, l))) AS n
        FROM (SELECT *, unnest(range(bl, bh)) AS j FROM (SELECT *, unnest(range(al, ah)) AS i FROM {nodes})))
  GROUP BY a, b, al, ah, bl, bh HAVING max(n) > 0"""

    return f"""
{name}_nodes AS (
  SELECT a, b, CAST(0 AS BIGINT) AS al, CAST(length(a) AS BIGINT) AS ah, CAST(0 AS BIGINT) AS bl,
         CAST(length(b) AS BIGINT) AS bh FROM ({pairs}) WHERE a <> '' AND b <> ''
  UNION ALL
  SELECT a, b, part.al, part.ah, part.bl, part.bh FROM (
    SELECT a, b, unnest([{{'al': al, 'ah': run.i, 'bl': bl, 'bh': run.j}},
                         {{'al': run.i + run.n, 'ah': ah, 'bl': run.j + run.n, 'bh': bh}}]) AS part
    FROM ({longest_run(f"{name}_nodes")}))
  WHERE part.al < part.ah AND part.bl < part.bh),
{name} AS (
  SELECT a, b, 2.0::DOUBLE * sum(run.n) / (length(a) + length(b)) AS score
  FROM ({longest_run(f"{name}_nodes")}) GROUP BY a, b)"""


def fuzzy(metric: str) -> str:
    """CTEs ending in fuzzy(block, key, matched_key, similarity), scored over all pairs of a block."""
    pairs = "SELECT o.block, o.key, h.key AS matched_key FROM open_keys o JOIN holders h ON o.block = h.block"
    if metric == "levenshtein":
        scores = f"scores AS (SELECT *, {similar('key', 'matched_key')} AS score FROM ({pairs}))"
    else:
        distinct = f"SELECT DISTINCT key AS a, matched_key AS b FROM ({pairs})"
        scores = f"""{matched_letters('place_ratio', distinct)},
scores AS (
  SELECT p.*, coalesce(r.score, 0.0) AS score FROM ({pairs}) p LEFT JOIN place_ratio r ON key = a AND matched_key = b)"""
    return f"""{HOLDERS},
open_keys AS (
  SELECT DISTINCT block, key FROM keyed k
  WHERE key <> '' AND NOT EXISTS (SELECT 1 FROM holders h WHERE h.block = k.block AND h.key = k.key)),
{scores},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY block, key ORDER BY score DESC, matched_key) AS place,
         lead(score) OVER (PARTITION BY block, key ORDER BY score DESC, matched_key) AS second
  FROM scores),
fuzzy AS (
  SELECT block, key, matched_key, round(score, 3) AS similarity FROM placed
  WHERE place = 1 AND score >= 0.88 AND (second IS NULL OR score - second >= 0.04))"""


_TITLES = r"\b(" + "|".join(lookups.HONORIFICS) + r")\b\.?"


def clean_person(name: str, keep: bool) -> str:
    out = sub(f"upper(coalesce({name}, ''))", r"\bS\s*/\s*O\b.*$", " ")
    out = sub(out, r"\b(ALIAS|URF|@)\b", " ")
    out = sub(out, r"[()]" if keep else r"\([^)]*\)", " ")
    out = sub(sub(out, _TITLES, " "), "[^A-Z ]", " ")
    return f"array_to_string(list_filter(string_split({out}, ' '), lambda w: length(w) > 1), ' ')"


def name_scores(source: str, key: str, a: str, b: str, metric: str) -> str:
    """CTEs ending in names(key, score) over the pairs (a, b) of a relation."""
    combos = " UNION ALL ".join(
        f"SELECT {key} AS id, {clean_person(a, x)} AS x, {clean_person(b, y)} AS y FROM {source}"
        for x in (False, True)
        for y in (False, True)
    )
    forms = [("x", "y"), ("sx", "sy"), ("jx", "jy")]
    if metric == "levenshtein":
        best = f"greatest({', '.join(similar(p, q) for p, q in forms)})"
        scored = f"scored AS (SELECT id, certain, {best} AS score FROM judged)"
    else:
        open_forms = " UNION ".join(f"SELECT {p} AS a, {q} AS b FROM judged WHERE NOT certain" for p, q in forms)
        each = " UNION ALL ".join(f"SELECT id, certain, {p} AS p, {q} AS q FROM judged" for p, q in forms)
        scored = f"""{matched_letters('name_ratio', open_forms)},
scored AS (SELECT id, certain, coalesce(score, 0.0) AS score FROM ({each}) LEFT JOIN name_ratio ON p = a AND q = b)"""
    return f"""
forms AS ({combos}),
words AS (
  SELECT DISTINCT id, x, y, list_distinct(string_split(x, ' ')) AS wx, list_distinct(string_split(y, ' ')) AS wy
  FROM forms WHERE x <> '' AND y <> ''),
sided AS (
  SELECT *, CASE WHEN len(wx) <= len(wy) THEN wx ELSE wy END AS small,
         CASE WHEN len(wx) <= len(wy) THEN wy ELSE wx END AS large,
         array_to_string(list_sort(wx), ' ') AS sx, array_to_string(list_sort(wy), ' ') AS sy,
         replace(x, ' ', '') AS jx, replace(y, ' ', '') AS jy FROM words),
judged AS (
  SELECT *, x = y
         OR (list_has_all(large, small)
             AND (len(small) >= 2 OR len(list_filter(small, lambda w: length(w) >= 6)) > 0))
         OR (length(jx) >= 8 AND length(jy) >= 8 AND (contains(jx, jy) OR contains(jy, jx))) AS certain
  FROM sided),
{scored},
names AS (SELECT id, CASE WHEN bool_or(certain) THEN 1.0::DOUBLE ELSE max(score) END AS score FROM scored GROUP BY id)"""


def joined(metric: str) -> str:
    return f"""{fuzzy(metric)},
linked AS (
  SELECT k.*, f.similarity, f.matched_key, h.state AS h_state, h.constituency AS h_seat, h.name AS winner_name,
         h.party, h.party_group, h.criminal_cases, h.assets, h.candidate_id,
         CASE WHEN f.matched_key IS NOT NULL THEN 'fuzzy' WHEN h.key IS NOT NULL THEN 'exact' END AS match_kind
  FROM keyed k LEFT JOIN fuzzy f ON k.block = f.block AND k.key = f.key
       LEFT JOIN holders h ON h.block = k.block AND h.key = coalesce(f.matched_key, k.key)),
known AS (SELECT * FROM linked WHERE match_kind IS NOT NULL),
{name_scores('known', 'mp_id', 'winner_name', 'mp_name', metric)},
joined AS (
  SELECT coalesce(h_state, {title('state')}) AS state, coalesce(h_seat, {title('constituency')}) AS constituency,
         mp_id, mp_name, allocated, expenditure, pct_spent, works_recommended, works_sanctioned, works_completed,
         party, party_group, criminal_cases, assets, candidate_id, winner_name, match_kind, similarity,
         CASE WHEN match_kind IS NOT NULL THEN coalesce(score, 0.0) END AS name_similarity,
         CASE WHEN match_kind IS NOT NULL THEN coalesce(score, 0.0) < {lookups.SAME_PERSON} END AS holder_differs,
         constituency AS fund_seat
  FROM linked LEFT JOIN names ON id = mp_id)"""


JOINED = joined("ratcliff")

NAME_PAIRS = f"pairs AS ({samples.for_duckdb(samples.NAME_PAIRS)})"


def name_match(metric: str) -> str:
    return f"""WITH RECURSIVE {NAME_PAIRS},
{name_scores('pairs', 'c_custkey', 'pairs.a', 'pairs.b', metric)}
SELECT c_custkey, a, b, coalesce(score, 0.0) AS similarity FROM pairs LEFT JOIN names ON id = c_custkey"""


HOLDER_CHANGED = """SELECT constituency, state, winner_name, mp_name AS current_mp,
  round(name_similarity, 2) AS name_similarity FROM joined WHERE holder_differs"""

FUND_SEARCH = contains_any(["mp_name", "winner_name", "constituency", "party", "state"])

CROSS = f"theirs AS ({samples.for_duckdb(samples.CROSS_CHECK)})"


def reconcile_sql() -> str:
    parts = []
    for label, (mine, yours) in RECONCILED.items():
        parts.append(
            f"SELECT {quoted(label)} AS metric, (SELECT CAST(sum({mine}) AS BIGINT) FROM funds) AS ours, "
            f"(SELECT CAST(round(sum(CAST(\"{yours}\" AS DECIMAL(28, 4))), 0) AS BIGINT) FROM theirs WHERE house = 'Lok Sabha') AS theirs"
        )
    return (
        f"WITH {KEYED}, {CROSS}, totals AS ({' UNION ALL '.join(parts)}) "
        f"SELECT metric, ours, theirs, ours - theirs AS delta, {ratio('100 * (ours - theirs)', 'theirs', 2)} AS pct_delta "
        "FROM totals WHERE ours <> 0 AND theirs <> 0"
    )


def grouped(v: str) -> str:
    text = f"CAST({v} AS VARCHAR)"
    head = f"reverse(left({text}, length({text}) - 3))"
    pairs = f"reverse(rtrim(regexp_replace({head}, '(..)', '\\1,', 'g'), ','))"
    return (
        f"CASE WHEN {v} IS NULL THEN '—' WHEN {v} < 1000 THEN {text} "
        f"ELSE {pairs} || ',' || right({text}, 3) END"
    )


def short_money(v: str) -> str:
    def whole(unit: int) -> str:
        return f"CAST((2 * {v} + {unit}) // {2 * unit} AS VARCHAR)"

    def decimal(unit: int, digits: int) -> str:
        parts = f"((2 * {10**digits} * {v} + {unit}) // {2 * unit})"
        return (
            f"CAST({parts} // {10**digits} AS VARCHAR) || CASE WHEN {parts} % {10**digits} = 0 THEN '' "
            f"ELSE '.' || lpad(CAST({parts} % {10**digits} AS VARCHAR), {digits}, '0') END"
        )

    return (
        f"CASE WHEN {v} IS NULL THEN '—' WHEN {v} >= 100000000 THEN '₹' || {whole(10**7)} || ' Cr' "
        f"WHEN {v} >= 10000000 THEN '₹' || {decimal(10**7, 2)} || ' Cr' "
        f"WHEN {v} >= 1000000 THEN '₹' || {whole(10**5)} || ' L' "
        f"WHEN {v} >= 100000 THEN '₹' || {decimal(10**5, 1)} || ' L' "
        f"WHEN {v} >= 1000 THEN '₹' || {whole(1000)} || 'K' ELSE '₹' || CAST({v} AS VARCHAR) END"
    )


def matrix() -> str:
    columns = ", ".join(
        f"CAST(coalesce(sum(winners) FILTER (WHERE age_band = '{b}' AND election_year <> 1998), 0) AS BIGINT) AS \"{b}\""
        for b in lookups.AGE_BANDS
    )
    return on_silver(f"SELECT election_year, {columns} FROM ({dist('age_band')}) GROUP BY election_year")


def blocks(pattern: dict, extra: str = "") -> str:
    """Rows of the block with the most rows, the first on a tie."""
    return f"""WITH found AS (
  SELECT page_id, unnest(regexp_extract_all(html, {quoted(pattern['block'])})) AS block,
         generate_subscripts(regexp_extract_all(html, {quoted(pattern['block'])}), 1) AS i FROM pages),
counted AS (SELECT page_id, i, regexp_extract_all(block, {quoted(pattern['row'])}, 1) AS rows FROM found),
best AS (SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY len(rows) DESC, i) = 1)
{extra}"""


_FUND_AMOUNT = {
    "allocated": "allocated",
    "expenditure": "expenditure",
    "works_recommended": "works_recommended",
    "works_recommended_amt": "expenditure",
    "works_sanctioned": "CASE WHEN mp_id % 7 <> 0 THEN works_sanctioned END",
    "works_sanctioned_amt": "CASE WHEN mp_id % 7 <> 0 THEN expenditure END",
    "works_completed": "works_completed",
    "works_completed_amt": "expenditure",
}
_TILES = ", ".join(f"{sql} AS {name}" for name, sql in _FUND_AMOUNT.items())


_MEMBERS = "(VALUES (0, 0), (1000000, 0), (2000000, 10000000)) AS m(more, seat)"


def json_object(columns: dict[str, str]) -> str:
    """JSON text with the given SQL types: s text, n number."""
    parts = []
    for name, kind in columns.items():
        value = f"'\"' || {name} || '\"'" if kind == "s" else f"CAST({name} AS VARCHAR)"
        parts.append(f"'\"{name}\":' || coalesce({value}, 'null')")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


_MART_MEASURES = {"pct_criminal": "n", "pct_crorepati": "n", "avg_age": "n", "median_assets": "n"}
_TREND_FIELDS = {
    "n": "n", "pct_criminal": "n", "pct_multi_case": "n", "pct_crorepati": "n", "avg_age": "n", "pct_graduate_plus": "n",
    "avg_cases": "n", "median_assets": "n",
}
_DIST = {"candidates": "n", "winners": "n"}
_ALL_LAST = "NULLS LAST"

# Section -> rows, their fields in order, and the published order.
SECTIONS = {
    "summary/national_trends": ("SELECT * FROM national", {"election_year": "n", "cohort": "s"} | _TREND_FIELDS, "cohort, election_year"),
    "summary/party_summary": (
        PARTY,
        {"election_year": "n", "party_group": "s", "candidates": "n", "seats_won": "n"} | _MART_MEASURES | {"strike_rate": "n"},
        "election_year, seats_won DESC, party_group",
    ),
    "summary/state_summary": (
        STATES,
        {"election_year": "n", "state": "s", "seats": "n", "pct_criminal": "n", "pct_crorepati": "n", "avg_age": "n", "total_cases": "n",
         "median_assets": "n"},
        "election_year, seats DESC, state",
    ),
    "summary/education_dist": (
        dist("education_group"), {"election_year": "n", "education_group": "s"} | _DIST, "election_year, education_group",
    ),
    "summary/age_dist": (dist("age_band"), {"election_year": "n", "age_band": "s"} | _DIST, "election_year, age_band"),
    "winners/winners": (
        WINNERS,
        {"election_year": "n", "state": "s", "constituency": "s", "seat_category": "s", "name": "s", "party": "s", "party_group": "s",
         "criminal_cases": "n", "education": "s", "education_group": "s", "age": "n", "assets": "n", "liabilities": "n", "net_worth": "n",
         "is_crorepati": "n", "candidate_id": "n"},
        f"election_year, state, constituency, candidate_id {_ALL_LAST}, name",
    ),
    "leaderboards/entries": (
        BOARDS,
        {"board": "s", "rank": "n", "election_year": "n", "name": "s", "party": "s", "state": "s", "constituency": "s", "assets": "n",
         "liabilities": "n", "criminal_cases": "n", "education": "s", "age": "n", "is_winner": "n", "candidate_id": "n"},
        "board, election_year, rank",
    ),
    "repeat_candidates/candidates": (
        f"SELECT * FROM repeats ORDER BY asset_growth_pct DESC {_ALL_LAST}, name, state LIMIT 500",
        {"state": "s", "name": "s", "elections_contested": "n", "elections_won": "n", "first_year": "n", "last_year": "n", "min_assets": "n",
         "max_assets": "n", "peak_cases": "n", "asset_growth_pct": "n"},
        f"asset_growth_pct DESC {_ALL_LAST}, name, state",
    ),
    "states/state_trends": (
        "SELECT * FROM by_state", {"state": "s", "election_year": "n", "cohort": "s"} | _TREND_FIELDS, "state, cohort, election_year",
    ),
    "states/party_by_state": (
        PARTY_STATE,
        {"election_year": "n", "state": "s", "party_group": "s", "candidates": "n", "seats_won": "n", "pct_criminal": "n", "median_assets": "n"},
        "state, election_year, seats_won DESC, party_group",
    ),
    "states/education_by_state": (
        dist("education_group", True), {"election_year": "n", "state": "s", "education_group": "s"} | _DIST, "state, election_year, education_group",
    ),
    "states/age_by_state": (
        dist("age_band", True), {"election_year": "n", "state": "s", "age_band": "s"} | _DIST, "state, election_year, age_band",
    ),
}


def payload() -> str:
    parts = [
        f"SELECT {quoted(name)} AS section, CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) AS position, "
        f"{json_object(fields)} AS body FROM ({rows})"
        for name, (rows, fields, order) in SECTIONS.items()
    ]
    return f"WITH {TRENDS}, {REPEATS.removeprefix(SILVER + ',')} {' UNION ALL '.join(parts)}"


def changes_sql() -> str:
    """The two sections that list people differ once the latest winners have no cases."""
    same = set(SECTIONS) - {"winners/winners", "leaderboards/entries"}
    parts = [
        f"SELECT {quoted(name)} AS section, 'new' AS first_run, {quoted('unchanged' if name in same else 'updated')} AS second_run, "
        f"(SELECT count(*) FROM ({rows})) AS n_rows"
        for name, (rows, _, _) in SECTIONS.items()
    ]
    flat = f"(WITH {CONFORMED} SELECT count(*) FROM (SELECT 1 FROM conformed QUALIFY {_BEST}))"
    parts.append(f"SELECT 'candidates', 'new', 'unchanged', {flat}")
    return f"WITH {TRENDS}, {REPEATS.removeprefix(SILVER + ',')} {' UNION ALL '.join(parts)}"


def notes() -> str:
    return " ".join(f"WHEN {quoted(metric)} THEN {quoted(note)}" for metric, (_, _, note) in fund_plan.AUDIT_TOTALS.items())


CROSSCHECK = f"""WITH {KEYED}, {CROSS},
t AS (SELECT *, house = 'Lok Sabha' AS mine, coalesce("completedWorksCount", 0) > coalesce("recommendedWorksCount", 0) AS wrong FROM theirs),
a AS (
  SELECT count(*) AS total, count(*) FILTER (WHERE mine) AS mine, count(*) FILTER (WHERE wrong) AS records,
         {ratio('100 * count(*) FILTER (WHERE wrong)', 'count(*)', 1)} AS pct,
         CAST(round(sum("allocatedAmount") FILTER (WHERE mine)) AS BIGINT) AS m0,
         CAST(round(sum("totalExpenditure") FILTER (WHERE mine)) AS BIGINT) AS m1,
         CAST(sum("completedWorksCount") FILTER (WHERE mine) AS BIGINT) AS m2,
         CAST(sum("recommendedWorksCount") FILTER (WHERE mine) AS BIGINT) AS m3 FROM t),
o AS (
  SELECT CAST(sum(allocated) AS BIGINT) AS m0, CAST(sum(expenditure) AS BIGINT) AS m1, CAST(sum(works_completed) AS BIGINT) AS m2,
         CAST(sum(works_recommended) AS BIGINT) AS m3 FROM funds),
both_ AS (
  SELECT 'Allocated to Lok Sabha MPs' AS metric, (SELECT m0 FROM o) AS ours, (SELECT m0 FROM a) AS theirs
  UNION ALL SELECT 'Expenditure', (SELECT m1 FROM o), (SELECT m1 FROM a)
  UNION ALL SELECT 'Works completed', (SELECT m2 FROM o), (SELECT m2 FROM a)
  UNION ALL SELECT 'Works recommended', (SELECT m3 FROM o), (SELECT m3 FROM a))
SELECT metric, ours, theirs, CASE metric {notes()} END AS note, '2024-08-01' AS their_last_updated, 'daily' AS their_update_frequency,
       'as published' AS their_quality_claim, (SELECT total FROM a) AS records_total, (SELECT mine FROM a) AS records_lok_sabha,
       (SELECT total - mine FROM a) AS records_rajya_sabha, (SELECT records FROM a) AS inconsistent_records, (SELECT pct FROM a) AS inconsistent_pct,
       ours - theirs AS delta, {ratio('100 * (ours - theirs)', 'theirs', 2)} AS pct_delta
FROM both_ WHERE ours <> 0 AND theirs <> 0"""

_SEAT = "(constituency_id + CASE WHEN is_bye_election THEN 0 ELSE 1 END)"
_READABLE = f"{_SEAT} % 9 <> 0 AND {_SEAT} % 11 <> 0"
_SEAT_NAME = f"CASE WHEN {_SEAT} % 7 = 0 THEN 'ELSEWHERE' ELSE upper(regexp_replace(constituency, ' .*$', '')) END"
_SOURCE = f"'page ' || CAST({_SEAT} AS VARCHAR) || '#' || {_SEAT_NAME}"

_PAGE_FIELDS = f"""candidate_id AS entry_id, {collapse('state')} AS state, {collapse('constituency')} AS constituency"""

KPI_DELTA = f"""WITH {TRENDS}
SELECT state, cohort, election_year, lag(election_year) OVER s AS previous_year, n, pct_criminal,
  round(pct_criminal - lag(pct_criminal) OVER s, 1) AS pct_criminal_change, pct_crorepati,
  round(pct_crorepati - lag(pct_crorepati) OVER s, 1) AS pct_crorepati_change, median_assets,
  lag(median_assets) OVER s AS previous_median_assets, avg_age, pct_graduate_plus
FROM by_state WINDOW s AS (PARTITION BY state, cohort ORDER BY election_year)"""

ORACLES = {
    "bronze_from_pages": f"""WITH {RAW} SELECT election_year, {collapse('state')} AS state, {collapse('constituency')} AS constituency,
  CAST(constituency_id AS INT) AS constituency_id, CAST(candidate_id AS INT) AS candidate_id, {collapse('name')} AS name,
  coalesce({collapse('party')}, 'Unknown') AS party, criminal_cases, coalesce({collapse('education')}, 'Not Given') AS education, age, assets,
  CASE WHEN liabilities > 0 THEN liabilities ELSE 0 END AS liabilities, is_winner, is_bye_election, {_SOURCE} AS source_url
FROM raw WHERE {_READABLE}""",
    "bronze_rejects": f"""WITH {RAW} SELECT DISTINCT {_SOURCE} AS source_url, election_year, constituency_id,
  CASE WHEN {_SEAT} % 9 = 0 THEN 'empty page' ELSE 'no rows' END AS reason
FROM (SELECT DISTINCT election_year, constituency_id, state, constituency, is_bye_election FROM raw) WHERE NOT ({_READABLE})""",
    "seats_not_named": f"""WITH {RAW} SELECT {_SOURCE} AS source_url, {collapse('constituency')} AS constituency, {collapse('name')} AS name
FROM raw WHERE {_READABLE} AND {_SEAT} % 7 = 0""",
    "schema_tables": on_silver(
        f"""SELECT 'gold_winners' AS mart, (SELECT count(*) FROM ({WINNERS})) AS n_rows
UNION ALL SELECT 'gold_education_state', (SELECT count(*) FROM ({dist("education_group", True)}))
UNION ALL SELECT 'gold_age_dist', (SELECT count(*) FROM ({dist("age_band")}))"""
    ),
    "typed_rows": """WITH given(state, mp_id, allocated, pct_spent, works_completed) AS (VALUES
  ('Goa', 1, CAST(500 AS BIGINT), CAST(12.5 AS DOUBLE), CAST(NULL AS INTEGER)), ('Kerala', 2, NULL, NULL, 7), (NULL, 4, NULL, NULL, NULL), ('Goa', -1, NULL, NULL, NULL)),
held AS (SELECT o_custkey, count(*) AS n_orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY o_custkey)
SELECT state, mp_id, allocated, pct_spent, works_completed, n_orders, cents FROM given LEFT JOIN held ON o_custkey = mp_id""",
    "publish_changes": changes_sql(),
    "published_comparisons": reconcile_sql(),
    "crosscheck_payload": CROSSCHECK,
    "crosscheck_plain": CROSSCHECK,
    "ordered_marts": f"""WITH {REPEATS}, party AS ({PARTY})
SELECT 'party' AS mart, CAST(row_number() OVER (ORDER BY election_year, seats_won DESC, party_group) - 1 AS INTEGER) AS position,
  party_group AS label, CAST(election_year AS VARCHAR) AS scope FROM party
UNION ALL SELECT 'repeat', CAST(row_number() OVER (ORDER BY asset_growth_pct DESC NULLS LAST, name, state) - 1 AS INTEGER), name, state FROM repeats""",
    "jsonl_roundtrip": f"WITH {RAW} SELECT * FROM raw",
    "scan_pages": "SELECT CAST(page_id % 5 + 2000 AS INT) AS election_year, CAST(length(html) AS INT) AS n_chars, md5(html) AS digest FROM pages",
    "lineage_columns": "SELECT o_orderkey, 'orders feed' AS _source, '2024-08-01 10:30:00' AS _ingested_at FROM orders",
    "table_roundtrip": f"WITH {RAW} SELECT * FROM raw",
    "partitioned_roundtrip": f"WITH {RAW} SELECT * FROM raw",
    "document_read": on_silver(
        f"""SELECT CAST(row_number() OVER (ORDER BY election_year, age_band) - 1 AS INTEGER) AS position, *, 'orders' AS source
FROM ({dist("age_band")})"""
    ),
    "envelope_unwrap": """SELECT event_id,
  CASE WHEN event_id % 4 IN (0, 3) THEN CAST(json_extract_string(props, '$.k') AS INT) END AS k,
  CASE event_id % 4 WHEN 1 THEN 'other,data' WHEN 2 THEN '' ELSE array_to_string(json_keys(props), ',') END AS keys
FROM events""",
    "export_json_safe": """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts,
  CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 THEN round(value / 3, 2) END AS value, event_type FROM events""",
    "export_payload": payload(),
    "export_flat": f"""WITH {CONFORMED} SELECT election_year, state, constituency, seat_category, name, party, party_group,
  criminal_cases, education, age, assets, liabilities, net_worth, is_winner, is_bye_election FROM conformed QUALIFY {_BEST}""",
    "slice_csv": on_silver(
        f"""SELECT election_year, state, constituency, seat_category, name, party, criminal_cases, education, age,
  assets, liabilities FROM winners WHERE election_year = {LATEST}"""
    ),
    "run_meta": f"""WITH {RAW} SELECT '2024-08-01T00:00:00Z' AS generated_at, 'orders' AS source,
  (SELECT string_agg(y, ',' ORDER BY y) FROM
     (SELECT DISTINCT CAST(election_year AS VARCHAR) AS y FROM raw WHERE NOT is_bye_election)) AS election_years,
  count(*) FILTER (WHERE NOT is_bye_election) AS total_candidates,
  count(*) FILTER (WHERE NOT is_bye_election AND is_winner) AS total_winners,
  count(*) FILTER (WHERE is_bye_election) AS bye_election_rows_excluded FROM raw""",
    "snapshot_diff": f"""WITH o AS (SELECT * REPLACE (CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS o_custkey),
  CAST(year(o_orderdate) AS INT) AS order_year FROM orders),
now AS (SELECT o_custkey, order_year, count(*) AS n_new FROM o WHERE order_year > {FIRST} GROUP BY ALL),
was AS (
  SELECT o_custkey, order_year, count(*) AS n_old, bool_or(o_orderpriority = '1-URGENT') AS changed
  FROM o WHERE order_year < {LATEST} GROUP BY ALL)
SELECT coalesce(now.o_custkey, was.o_custkey) AS o_custkey, coalesce(now.order_year, was.order_year) AS order_year,
       CASE WHEN n_old IS NULL THEN 'new' WHEN n_new IS NULL THEN 'removed'
       WHEN changed THEN 'updated' ELSE 'unchanged' END AS status, n_old, n_new
FROM now FULL JOIN was ON coalesce(now.o_custkey, -1) = coalesce(was.o_custkey, -1) AND now.order_year = was.order_year""",
    "html_clean": f"SELECT page_id, {clean_html('html')} AS text FROM pages",
    "page_header": f"""WITH {RAW}, p AS (SELECT is_bye_election AS bye, {_PAGE_FIELDS} FROM raw)
SELECT entry_id, constituency,
       CASE WHEN bye THEN trim('BYE ELECTION ON 04-02-2017 : ' || state) ELSE state END AS state FROM p""",
    "page_special_flag": f"WITH {RAW} SELECT candidate_id AS entry_id, is_bye_election, {collapse('state')} AS state FROM raw",
    "best_block": blocks(
        LIST_BLOCK,
        """SELECT page_id, CAST(coalesce(len(rows), 0) AS INT) AS n_rows, coalesce(array_to_string(rows, '|'), '') AS rows
FROM pages LEFT JOIN best USING (page_id)""",
    ),
    "page_rows": f"""WITH {RAW} SELECT election_year, constituency_id, candidate_id AS entry_id, {collapse('state')} AS state,
  {collapse('constituency')} AS constituency, candidate_id, {collapse('name')} AS name,
  coalesce({collapse('party')}, 'Unknown') AS party, criminal_cases,
  coalesce({collapse('education')}, 'Not Given') AS education, age, assets,
  CASE WHEN liabilities > 0 THEN liabilities ELSE 0 END AS liabilities, is_winner, is_bye_election FROM raw""",
    "link_ids": f"""WITH {RAW}, p AS (SELECT state, election_year, list_sort(list_distinct(list(constituency_id))) AS ids FROM raw GROUP BY ALL)
SELECT state, election_year, true AS has_first, CAST(len(ids) AS INT) AS n_ids, array_to_string(ids, ',') AS ids, len(ids) < 3 AS is_scarce
FROM p""",
    "parse_money": samples.for_duckdb(samples.MONEY_CELLS),
    "parse_int": r"SELECT event_id, CAST(regexp_extract(props, '\d+') AS INT) AS k FROM events",
    "parse_amount": "SELECT event_id, CAST(trunc(abs(value)) AS BIGINT) AS amount FROM events",
    "education_rank": f"""WITH {RAW}, named AS (SELECT education AS raw, {_LABEL} AS education FROM raw),
ranked AS (SELECT *, {RANK} AS education_rank FROM named)
SELECT raw, education, education_rank, {education_group('education_rank')} AS education_group, count(*) AS n
FROM ranked GROUP BY ALL""",
    "tile_columns": f"WITH {FUNDS_RAW} SELECT mp_id + more AS mp_id, {_TILES} FROM funds_raw, {_MEMBERS}",
    "flatten_hierarchy": f"""WITH {FUNDS_RAW} SELECT '18th term' AS tenure, trim(state) AS state, mp_id % 25 AS state_id,
  trim(constituency) AS constituency, mp_id + 1 + seat AS constituency_id, trim(mp_name) AS mp_name, mp_id + more AS mp_id, {_TILES},
  {ratio('100 * expenditure', 'allocated', 1)} AS pct_spent FROM funds_raw, {_MEMBERS}""",
    "general_only": f"WITH {RAW} SELECT * FROM raw WHERE NOT is_bye_election",
    "tidy_text": f"SELECT doc_id, {tidy('text')} AS text, upper({tidy('source')}) AS label FROM documents",
    "title_case": f"SELECT doc_id, {title('text')} AS text FROM documents",
    "conform_state": f"WITH {RAW} SELECT state, {conform_state('state')} AS conformed, count(*) AS n FROM raw GROUP BY ALL",
    "seat_category": f"""WITH {RAW} SELECT constituency, {seat_category(tidy('constituency'))} AS category,
  {strip_tag(tidy('constituency'))} AS seat, count(*) AS n FROM raw GROUP BY ALL""",
    "derive_measures": f"""WITH {RAW} SELECT election_year, candidate_id, name,
  CASE WHEN assets >= 0 THEN assets END AS assets, CASE WHEN liabilities >= 0 THEN liabilities END AS liabilities,
  CASE WHEN assets >= 0 THEN assets - (CASE WHEN liabilities > 0 THEN liabilities ELSE 0 END) END AS net_worth,
  CASE WHEN assets >= 0 THEN assets >= {lookups.CRORE} END AS is_crorepati,
  coalesce(criminal_cases, 0) AS criminal_cases, coalesce(criminal_cases, 0) > 0 AS has_criminal_case,
  CASE WHEN age BETWEEN 21 AND 100 THEN age END AS age FROM raw""",
    "age_band": f"""WITH {RAW}, aged AS (SELECT CASE WHEN age BETWEEN 21 AND 100 THEN age END AS age FROM raw)
SELECT {AGE_BAND} AS age_band, count(*) AS n, min(age) AS youngest, max(age) AS oldest FROM aged GROUP BY 1""",
    "party_group": f"WITH {CONFORMED} SELECT party, party_group, count(*) AS n FROM conformed WHERE NOT is_bye_election GROUP BY ALL",
    "winners_view": on_silver(WINNERS),
    "norm_key_join": f"""WITH {HOLDERS} SELECT mp_id, k.block, k.key, h.name AS winner, h.candidate_id, h.party_group,
  h.key IS NOT NULL AS matched FROM keyed k LEFT JOIN holders h ON k.block = h.block AND k.key = h.key""",
    "unmatched_rows": f"""WITH {HOLDERS} SELECT mp_id, state, constituency, mp_name FROM keyed k
WHERE NOT EXISTS (SELECT 1 FROM holders h WHERE k.block = h.block AND k.key = h.key)""",
    "fuzzy_join": f"WITH RECURSIVE {fuzzy('ratcliff')} SELECT * FROM fuzzy",
    "fuzzy_join_levenshtein": f"WITH {fuzzy('levenshtein')} SELECT * FROM fuzzy",
    "name_match": name_match("ratcliff"),
    "name_match_levenshtein": name_match("levenshtein"),
    "joined_funds": f"WITH RECURSIVE {JOINED} SELECT * FROM joined",
    "holder_changed": f"WITH RECURSIVE {JOINED} {HOLDER_CHANGED}",
    "holder_changed_levenshtein": f"WITH {joined('levenshtein')} {HOLDER_CHANGED}",
    "match_report": f"""WITH RECURSIVE {JOINED} SELECT count(*) AS seats, count(*) FILTER (WHERE match_kind IS NULL) AS unmatched,
  count(*) FILTER (WHERE match_kind = 'fuzzy') AS fuzzy, count(*) FILTER (WHERE allocated <> 0) AS with_allocation,
  (SELECT count(*) FROM funds_raw) - count(*) AS rows_dropped,
  {ratio('100 * count(match_kind)', 'count(*)', 1)} AS match_rate_pct FROM joined""",
    "reconcile": reconcile_sql(),
    "consistency_audit": f"""WITH {CROSS}, t AS (SELECT *, house = 'Lok Sabha' AS mine,
  coalesce("completedWorksCount", 0) > coalesce("recommendedWorksCount", 0) AS wrong FROM theirs)
SELECT count(*) AS records_total, count(*) FILTER (WHERE mine) AS records_subset,
  count(*) FILTER (WHERE NOT mine) AS records_other,
  count(*) FILTER (WHERE wrong) AS records_completed_exceeds_recommended,
  {ratio('100 * count(*) FILTER (WHERE wrong)', 'count(*)', 1)} AS pct_inconsistent,
  CAST(round(sum("allocatedAmount") FILTER (WHERE mine)) AS BIGINT) AS subset_allocated,
  CAST(round(sum("totalExpenditure") FILTER (WHERE mine)) AS BIGINT) AS subset_expenditure,
  CAST(sum("completedWorksCount") FILTER (WHERE mine) AS BIGINT) AS subset_works_completed,
  CAST(sum("recommendedWorksCount") FILTER (WHERE mine) AS BIGINT) AS subset_works_recommended FROM t""",
    "state_utilisation": f"""WITH RECURSIVE {JOINED} SELECT state, count(*) AS seats, CAST(sum(allocated) AS BIGINT) AS allocated,
  CAST(sum(expenditure) AS BIGINT) AS expenditure, CAST(sum(works_completed) AS BIGINT) AS works_completed,
  {ratio('100 * sum(expenditure)', 'sum(allocated)', 1)} AS pct_spent FROM joined WHERE allocated <> 0 GROUP BY state""",
    "funds_kpis": f"""WITH RECURSIVE {JOINED}, s AS (
  SELECT coalesce(CAST(sum(allocated) AS BIGINT), 0) AS allocated,
         coalesce(CAST(sum(expenditure) FILTER (WHERE allocated <> 0) AS BIGINT), 0) AS expenditure,
         coalesce(CAST(sum(works_completed) AS BIGINT), 0) AS works_completed,
         coalesce(CAST(sum(works_recommended) AS BIGINT), 0) AS works_recommended
  FROM joined WHERE {FUND_SEARCH})
SELECT *, {ratio('100 * expenditure', 'allocated', 1)} AS pct_spent FROM s""",
    "funds_slice": f"WITH RECURSIVE {JOINED} SELECT * FROM joined WHERE {FUND_SEARCH}",
    "measures": f"""WITH l AS (
  SELECT l_returnflag, l_linestatus, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
         CAST(l_quantity AS INT) AS quantity, CASE WHEN l_tax > 0 THEN l_discount > 0.05 END AS deep FROM lineitem)
SELECT l_returnflag, l_linestatus, count(*) AS n, {share('deep')} AS pct_deep,
  {ratio('100 * count(*) FILTER (WHERE deep)', 'count(*)', 1)} AS pct_deep_of_all,
  {share('(quantity >= 25)')} AS pct_large, count(*) FILTER (WHERE deep) AS n_deep,
  {mean('quantity', 2)} AS avg_quantity, CAST(sum(cents) AS BIGINT) AS cents, quantile_disc(cents, 0.5) AS median_cents
FROM l GROUP BY ALL""",
    "quantiles": """SELECT l_returnflag, l_linestatus, count(*) AS n,
  quantile_disc(cents, 0.01) AS p01, quantile_disc(cents, 0.25) AS p25, quantile_disc(cents, 0.5) AS p50,
  quantile_disc(cents, 0.75) AS p75, quantile_disc(cents, 0.99) AS p99
FROM (SELECT l_returnflag, l_linestatus, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem) GROUP BY ALL""",
    "measures_two_pass": """SELECT l_returnflag,
  CAST(trunc(quantile_cont(CAST(round(l_extendedprice * 100) AS BIGINT), 0.5)) AS BIGINT) AS median
FROM lineitem GROUP BY ALL""",
    "national_trends": f"WITH {TRENDS} SELECT * FROM national",
    "party_summary": on_silver(PARTY),
    "state_summary": on_silver(STATES),
    "education_dist": on_silver(dist("education_group")),
    "age_dist": on_silver(dist("age_band")),
    "state_trends": f"WITH {TRENDS} SELECT * FROM by_state",
    "party_by_state": on_silver(PARTY_STATE),
    "education_by_state": on_silver(dist("education_group", True)),
    "age_by_state": on_silver(dist("age_band", True)),
    "repeat_entities": f"WITH {REPEATS} SELECT * FROM repeats",
    "repeat_top": f"WITH {REPEATS} SELECT * FROM repeats ORDER BY asset_growth_pct DESC NULLS LAST, name, state LIMIT 500",
    "leaderboards": on_silver(BOARDS),
    "dedupe_candidates": on_silver("SELECT * FROM silver"),
    "dedupe_first": """SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""",
    "dedupe_funded": f"""WITH {FUNDS_RAW} SELECT * FROM funds_raw
QUALIFY row_number() OVER (PARTITION BY state, constituency
        ORDER BY coalesce(allocated, 0) DESC, coalesce(expenditure, 0) DESC, mp_id, mp_name) = 1""",
    "dedupe_report": on_silver(
        """SELECT (SELECT count(*) FROM conformed WHERE NOT is_bye_election) AS rows_in, count(*) AS rows_out,
  (SELECT count(*) FROM conformed WHERE NOT is_bye_election) - count(*) AS rows_dropped FROM silver"""
    ),
    "ingest_profile": f"""WITH {RAW} SELECT election_year, count(*) AS candidates, count(*) FILTER (WHERE is_winner) AS winners,
  count(DISTINCT constituency_id) AS constituencies, count(DISTINCT state) AS states,
  {share('(assets IS NOT NULL)')} AS asset_cov_pct FROM raw GROUP BY ALL""",
    "silver_profile": on_silver(
        f"""SELECT election_year, count(*) AS candidates, count(*) FILTER (WHERE is_winner) AS winners,
  count(DISTINCT state) AS states, count(DISTINCT party) AS parties, {mean('age')} AS avg_age,
  {share('has_criminal_case')} AS pct_criminal, {share('is_crorepati')} AS pct_crorepati FROM silver GROUP BY ALL"""
    ),
    "completeness_violations": f"""WITH {RAW}, p AS (
  SELECT election_year, count(*) AS candidates, count(*) FILTER (WHERE is_winner) AS winners,
         count(DISTINCT constituency_id) AS constituencies, count(DISTINCT state) AS states,
         {share('(assets IS NOT NULL)')} AS asset_cov_pct FROM raw GROUP BY ALL)
SELECT *, concat_ws(',', CASE WHEN winners < 160 THEN 'winners' END,
                    CASE WHEN candidates < 2240 THEN 'candidates' END) AS broken_rules
FROM p WHERE winners < 160 OR candidates < 2240""",
    "one_winner_per_seat": f"""WITH {RAW} SELECT election_year, constituency_id, count(*) AS n_rows,
  count(*) FILTER (WHERE is_winner) AS n_winners FROM raw GROUP BY ALL HAVING count(*) FILTER (WHERE is_winner) <> 1""",
    "rejected_pages": blocks(
        SCARCE_BLOCK,
        """SELECT page_id, CAST(coalesce(len(rows), 0) AS INT) AS n_rows, 'no rows' AS reason
FROM pages LEFT JOIN best USING (page_id) WHERE coalesce(len(rows), 0) = 0""",
    ),
    "kpi_delta": KPI_DELTA,
    "refreshed_changes": KPI_DELTA,
    "trend_insights": f"""WITH {TRENDS},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY state, cohort ORDER BY election_year) AS i,
         count(*) OVER (PARTITION BY state, cohort) AS k FROM by_state WHERE n > 0)
SELECT f.state, f.cohort, f.election_year AS first_election_year, f.pct_criminal AS first_pct_criminal,
  f.median_assets AS first_median_assets, l.election_year AS last_election_year, l.pct_criminal AS last_pct_criminal,
  l.median_assets AS last_median_assets,
  CASE WHEN l.pct_criminal > f.pct_criminal THEN 'up from' WHEN l.pct_criminal <= f.pct_criminal THEN 'down from' END AS direction,
  CASE WHEN f.median_assets <> 0 AND l.median_assets <> 0 THEN
    CASE WHEN l.median_assets >= 10 * f.median_assets THEN {ratio('l.median_assets', 'f.median_assets', 0)}
         ELSE {ratio('l.median_assets', 'f.median_assets', 1)} END END AS asset_multiple
FROM placed f JOIN placed l ON f.state = l.state AND f.cohort = l.cohort AND f.i = 1 AND l.i = l.k AND f.k >= 2""",
    "cohort_premium": f"""WITH {TRENDS},
series AS (
  SELECT state, election_year, cohort = '{lookups.WINNERS}' AS won,
         CASE WHEN election_year = {LATEST} AND length(state) % 2 = 0 AND cohort = '{lookups.WINNERS}' THEN NULL ELSE median_assets END AS median_assets,
         CASE WHEN election_year = {LATEST} AND length(state) % 2 = 1 AND cohort <> '{lookups.WINNERS}' THEN NULL ELSE pct_crorepati END AS pct_crorepati
  FROM by_state),
med AS (
  SELECT w.state, w.election_year AS median_year, w.median_assets AS winner_median, f.median_assets AS field_median
  FROM (SELECT * FROM series WHERE won AND median_assets <> 0 QUALIFY row_number() OVER (PARTITION BY state ORDER BY election_year DESC) = 1) w
  JOIN series f ON f.state = w.state AND f.election_year = w.election_year AND NOT f.won AND f.median_assets <> 0),
cr AS (
  SELECT w.state, w.election_year AS pct_crorepati_year, w.pct_crorepati AS winner_pct_crorepati, f.pct_crorepati AS field_pct_crorepati
  FROM (SELECT * FROM series WHERE won AND pct_crorepati IS NOT NULL QUALIFY row_number() OVER (PARTITION BY state ORDER BY election_year DESC) = 1) w
  JOIN series f ON f.state = w.state AND f.election_year = w.election_year AND NOT f.won AND f.pct_crorepati IS NOT NULL)
SELECT state, median_year, winner_median, field_median, pct_crorepati_year, winner_pct_crorepati, field_pct_crorepati,
  {ratio('winner_median', 'field_median', 1)} AS premium
FROM med FULL JOIN cr USING (state)""",
    "state_vs_all": f"""WITH {TRENDS},
mine AS (SELECT * FROM by_state WHERE cohort = '{lookups.WINNERS}'),
years AS (SELECT DISTINCT election_year FROM silver), states AS (SELECT DISTINCT state FROM mine)
SELECT state, election_year, mine.pct_criminal AS state_value, a.pct_criminal AS all_value
FROM states CROSS JOIN years LEFT JOIN mine USING (state, election_year)
     LEFT JOIN (SELECT * FROM national WHERE cohort = '{lookups.WINNERS}') a USING (election_year)""",
    "dist_matrix": matrix(),
    "trend_slice": f"WITH {TRENDS} SELECT * EXCLUDE (state) FROM by_state WHERE state = '{STATE}' AND cohort = '{lookups.WINNERS}'",
    "winners_slice": on_silver(
        f"SELECT * FROM ({WINNERS}) WHERE election_year = {LATEST} AND party_group = 'Independent' AND {WINNER_SEARCH}"
    ),
    "text_search": on_silver(f"SELECT * FROM ({WINNERS}) WHERE {WINNER_SEARCH}"),
    "slice_counts": on_silver(
        f"SELECT count(*) FILTER (WHERE {WINNER_SEARCH}) AS shown, count(*) AS total FROM winners WHERE election_year = {LATEST}"
    ),
    "sorted_view": on_silver(f"SELECT * FROM ({WINNERS}) WHERE election_year = {LATEST}"),
    "party_chart": on_silver(
        f"SELECT * FROM ({PARTY}) WHERE election_year = {LATEST} AND seats_won > 0 ORDER BY seats_won DESC, party_group LIMIT 12"
    ),
    "party_chart_state": on_silver(
        f"""SELECT * FROM ({PARTY_STATE}) WHERE election_year = {LATEST} AND state = '{STATE}' AND seats_won > 0
ORDER BY seats_won DESC, party_group LIMIT 12"""
    ),
    "state_ranking": on_silver(
        f"SELECT * FROM ({STATES}) WHERE election_year = {LATEST} AND seats >= 3 ORDER BY coalesce(pct_criminal, 0) DESC, state LIMIT 36"
    ),
    "leaderboard_slice": on_silver(
        f"SELECT * FROM ({board(lookups.MOST_CASES, 'criminal_cases')}) WHERE election_year = {LATEST}"
    ),
    "repeat_slice": f"""WITH {REPEATS} SELECT * FROM repeats WHERE {contains_any(['name', 'state'])}
ORDER BY asset_growth_pct DESC NULLS LAST, name, state LIMIT 200""",
    "missing_slices": on_silver(
        """, present AS (SELECT DISTINCT state, election_year FROM winners
  WHERE state <> '' AND (election_year + length(state)) % 3 <> 0),
years AS (SELECT DISTINCT election_year FROM silver)
SELECT state, election_year FROM (SELECT DISTINCT state FROM present) CROSS JOIN years
EXCEPT SELECT state, election_year FROM present"""
    ),
    "trend_spine": f"""WITH {TRENDS}, years AS (SELECT DISTINCT election_year FROM silver)
SELECT state, cohort, election_year, median_assets
FROM (SELECT DISTINCT state, cohort FROM by_state) CROSS JOIN years LEFT JOIN by_state USING (state, cohort, election_year)""",
    "filter_options": on_silver(
        """SELECT DISTINCT 'election_year' AS "column", CAST(election_year AS VARCHAR) AS value FROM winners
UNION SELECT 'state', state FROM winners WHERE state <> '' UNION SELECT 'party_group', party_group FROM winners"""
    ),
    "format_money": f"""WITH f AS ({samples.for_duckdb(samples.FIGURES)})
SELECT o_orderkey, {short_money('figure')} AS short, {grouped('figure')} AS grouped,
  CASE WHEN figure IS NULL THEN '—' ELSE CAST((figure % 1000) // 10 AS VARCHAR) || '.' ||
       CAST(figure % 10 AS VARCHAR) || '%' END AS percent FROM f""",
    "stream_ingest": f"WITH {RAW} SELECT * FROM raw",
    "restated_pages": """WITH p AS (SELECT page_id, page_id || chr(10) || html AS body FROM pages)
SELECT page_id, CAST(1 AS BIGINT) AS version, md5(body) AS digest FROM p
UNION ALL SELECT page_id, 2, md5(body || '<!-- restated -->') FROM p WHERE page_id % 5 = 0""",
    "stream_merge": """WITH all_ AS (
  SELECT user_id, event_type, event_id, value FROM events
  UNION ALL SELECT user_id, event_type, event_id, value + 5 FROM events WHERE event_id % 10 = 3)
SELECT user_id, event_type, event_id, value FROM all_
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC NULLS LAST, event_id) = 1""",
}
