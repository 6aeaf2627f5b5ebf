"""Reference SQL for the registered queries, for DuckDB over the same tables.

Percentages and averages with two decimals are computed in integers, (2·100·100·part + whole) // (2·whole) / 100,
which is exact rounding half up; other figures by floor(x·unit + 0.5) / unit, money in cents and the rest in millionths.
"""

from __future__ import annotations

LINES = """
lines AS (
  SELECT l_orderkey, CAST(count(*) AS INTEGER) AS n, CAST(sum(l_quantity) AS INTEGER) AS q,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R' AND l_discount >= 0.08) AS INTEGER) AS d
  FROM lineitem GROUP BY l_orderkey
)"""

RAW = f"""{LINES},
raw AS (
  SELECT printf('801-%06d', o_custkey) AS sec_number, CAST(o_custkey AS VARCHAR) AS crd_number, o_custkey AS crd,
         CAST(o_orderdate AS DATE) AS filing_date, o_orderkey AS filing_key,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN 0
              ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2))
                   * CASE o_custkey % 4 WHEN 0 THEN 100 WHEN 1 THEN 1000 WHEN 2 THEN 10000 ELSE 100000 END
                   AS DECIMAL(20,2)) END AS raum,
         o_orderpriority AS cco_name, coalesce(n, 0) AS client_count, q AS account_count,
         coalesce(d, 0) AS disciplinary_disclosures, c_name AS firm_name, c_mktsegment AS firm_type,
         r_name AS sec_region, n_name AS main_office_country
  FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
)"""

FILINGS = f"""{RAW},
filings AS (
  SELECT *, CAST(filing_date AS VARCHAR) AS day FROM raw
  QUALIFY row_number() OVER (PARTITION BY sec_number, filing_date ORDER BY filing_key DESC) = 1
)"""


def _share(part: str, whole: str) -> str:
    return f"((20000 * CAST({part} AS HUGEINT) + {whole}) // (2 * {whole})) / 100.0"


def _mean2(total: str, count: str) -> str:
    return f"((200 * CAST({total} AS HUGEINT) + {count}) // (2 * {count})) / 100.0"


def _round6(value: str) -> str:
    return f"floor(CAST({value} AS DOUBLE) * 1e6 + 0.5) / 1e6"


def _round2(value: str) -> str:
    return f"floor(CAST({value} AS DOUBLE) * 100.0 + 0.5) / 100.0"


def _pct(previous: str, current: str) -> str:
    """Drop in hundredths of a percent, of whole numbers."""
    p, c = f"CAST({previous} AS HUGEINT)", f"CAST({current} AS HUGEINT)"
    return f"CASE WHEN {previous} > 0 AND {current} < {previous} THEN ((20000 * ({p} - {c}) + {p}) // (2 * {p})) / 100.0 ELSE 0.0 END"


def _changes(mode: str = "fractional") -> str:
    if mode == "as_written":
        clients = """CASE WHEN p.client_count > 0 AND f.client_count < p.client_count
          THEN least((p.client_count - f.client_count) // p.client_count * 100, 100) ELSE 0 END"""
        accounts = """CASE WHEN p.account_count > 0 AND f.account_count IS NOT NULL
          THEN least((p.account_count - f.account_count) // p.account_count * 100, 100) ELSE 0 END"""
    else:
        clients = _pct("p.client_count", "f.client_count")
        accounts = _pct("p.account_count", "f.account_count")
    if mode == "require_prev":
        scope, before = "p.sec_number IS NOT NULL", "coalesce(p.disciplinary_disclosures, 0)"
    else:
        scope, before = "f.raum > 0", "p.disciplinary_disclosures"
    return f"""{FILINGS},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY sec_number ORDER BY filing_date) AS i FROM filings
),
compared AS (
  SELECT f.sec_number, f.filing_date, f.day, f.raum,
         CASE WHEN p.raum > 0 AND f.raum < p.raum THEN 100.0 * CAST(p.raum - f.raum AS DOUBLE) / CAST(p.raum AS DOUBLE)
              ELSE 0.0 END AS raum_drop,
         {_pct("CAST(p.raum * 100 AS HUGEINT)", "CAST(f.raum * 100 AS HUGEINT)")} AS raum_drop_pct,
         CAST({clients} AS DOUBLE) AS client_drop_pct, CAST({accounts} AS DOUBLE) AS acct_drop_pct,
         coalesce(f.disciplinary_disclosures > {before}, FALSE) AS new_disc_flag,
         coalesce(f.cco_name <> p.cco_name, FALSE) AS cco_changed
  FROM numbered f LEFT JOIN numbered p ON p.sec_number = f.sec_number AND p.i = f.i - 1
  WHERE {scope}
),
changes AS (
  SELECT sec_number, filing_date, day, raum_drop_pct, client_drop_pct, acct_drop_pct, new_disc_flag, cco_changed,
         raum_drop + coalesce(lag(raum_drop, 1) OVER w, 0) + coalesce(lag(raum_drop, 2) OVER w, 0) >= 21 AS trend_down_flag,
         0 AS owner_moves_12m,
         CAST(year(filing_date) - year(min(filing_date) OVER (PARTITION BY sec_number)) AS INTEGER) AS adviser_age_years,
         raum
  FROM compared WINDOW w AS (PARTITION BY sec_number ORDER BY filing_date)
)"""


POINTS = {
    "new_disclosure": "CASE WHEN new_disc_flag THEN 40 ELSE 0 END",
    "raum_drop_severe": "CASE WHEN raum_drop_pct >= 25 THEN 25 ELSE 0 END",
    "raum_drop_moderate": "CASE WHEN raum_drop_pct BETWEEN 15 AND 24.9 THEN 15 ELSE 0 END",
    "client_drop_severe": "CASE WHEN client_drop_pct >= 25 THEN 15 ELSE 0 END",
    "client_drop_moderate": "CASE WHEN client_drop_pct BETWEEN 15 AND 24.9 THEN 8 ELSE 0 END",
    "account_drop_severe": "CASE WHEN acct_drop_pct >= 25 THEN 10 ELSE 0 END",
    "account_drop_moderate": "CASE WHEN acct_drop_pct BETWEEN 15 AND 24.9 THEN 5 ELSE 0 END",
    "officer_changed": "CASE WHEN cco_changed THEN 10 ELSE 0 END",
    "trend_down": "CASE WHEN trend_down_flag THEN 10 ELSE 0 END",
    "owner_moves": "CASE WHEN owner_moves_12m >= 2 THEN 10 ELSE 0 END",
    "young_adviser": "CASE WHEN adviser_age_years < 3 THEN 5 ELSE 0 END",
    "small_raum": "CASE WHEN raum < 50000000 THEN 5 ELSE 0 END",
}


def _category(score: str, critical: float, high: float, medium: float) -> str:
    return (
        f"CASE WHEN {score} >= {critical} THEN 'Critical' WHEN {score} >= {high} THEN 'High' "
        f"WHEN {score} >= {medium} THEN 'Medium' ELSE 'Low' END"
    )


def _scores(mode: str = "fractional") -> str:
    return f"""{_changes(mode)},
summed AS (SELECT *, {' + '.join(POINTS.values())} AS score FROM changes),
scores AS (
  SELECT sec_number, filing_date, day, score, {_category("score", 80, 60, 30)} AS risk_category,
         raum_drop_pct AS aum_drop_pct, client_drop_pct, acct_drop_pct, CAST(new_disc_flag AS INTEGER) AS new_disc,
         CAST(cco_changed AS INTEGER) AS cco_changed, CAST(trend_down_flag AS INTEGER) AS trend_down,
         owner_moves_12m, adviser_age_years AS adviser_age_yrs, CAST(raum < 50000000 AS INTEGER) AS small_raum
  FROM summed
)"""


SCORES = _scores()
SCORE_COLUMNS = """sec_number, day AS filing_date, score, risk_category, aum_drop_pct, client_drop_pct, acct_drop_pct,
  new_disc, cco_changed, trend_down, owner_moves_12m, adviser_age_yrs, small_raum"""
CHANGE_COLUMNS = """sec_number, day AS filing_date, raum_drop_pct, client_drop_pct, acct_drop_pct, new_disc_flag,
  cco_changed, trend_down_flag, owner_moves_12m, adviser_age_years, CAST(raum AS DOUBLE) AS raum"""
FACTOR_NAMES = (
    "aum_drop_pct", "client_drop_pct", "acct_drop_pct", "new_disc", "cco_changed", "trend_down",
    "owner_moves_12m", "adviser_age_yrs", "small_raum",
)

SINGLE = f"""{FILINGS},
single_factors AS (
  SELECT sec_number, filing_date, day,
         CASE WHEN disciplinary_disclosures > 0 THEN least(25, disciplinary_disclosures * 10) END AS disciplinary_risk,
         CASE WHEN raum > 10000000000 THEN 5 WHEN raum > 1000000000 THEN 10 WHEN raum > 100000000 THEN 15 ELSE 20 END
           AS size_factor_risk,
         CASE WHEN client_count <> 0 THEN CASE WHEN raum > 10000000 * client_count THEN 15
           WHEN raum > 1000000 * client_count THEN 10 WHEN raum > 100000 * client_count THEN 5 ELSE 0 END END
           AS client_concentration_risk,
         0 AS filing_compliance_risk, 0 AS cco_stability_risk, 0 AS aum_volatility_risk
  FROM filings WHERE raum > 0
),
single_scores AS (
  SELECT *, {_category("score", 50, 30, 15)} AS risk_category FROM (
    SELECT *, coalesce(disciplinary_risk, 0) + size_factor_risk + coalesce(client_concentration_risk, 0) AS score
    FROM single_factors)
)"""
SINGLE_NAMES = (
    "disciplinary_risk", "size_factor_risk", "client_concentration_risk", "filing_compliance_risk",
    "cco_stability_risk", "aum_volatility_risk",
)

MODEL = f"""{FILINGS},
stepped AS (
  SELECT *, CAST(raum AS DOUBLE) AS aum, disciplinary_disclosures > 0 AS disclosed,
         CASE WHEN raum IS NOT NULL THEN lag(CAST(raum AS DOUBLE)) OVER (
           PARTITION BY crd, raum IS NULL ORDER BY filing_date) END AS prev_aum,
         lag(cco_name) OVER (PARTITION BY crd ORDER BY filing_date) AS prev_cco,
         row_number() OVER (PARTITION BY crd ORDER BY filing_date DESC) AS newest,
         CAST(client_count AS DOUBLE) / greatest(account_count, 1) AS ratio
  FROM filings
),
stepped2 AS (SELECT *, CASE WHEN prev_aum <> 0 THEN aum / prev_aum - 1 END AS aum_change FROM stepped),
counted AS (
  SELECT crd, client_count AS total_clients, account_count AS total_accounts, ratio AS client_account_ratio
  FROM stepped WHERE client_count IS NOT NULL AND account_count IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY crd ORDER BY filing_date DESC) = 1
),
scale AS (
  SELECT quantile_cont(ratio, 0.95) AS scale FROM stepped WHERE client_count IS NOT NULL AND account_count IS NOT NULL
),
measures AS (
  SELECT crd, count(*) FILTER (WHERE disclosed) AS disclosure_count, count(*) AS filing_count,
         date_diff('day', min(filing_date), max(filing_date)) / 365.25 AS years_active,
         count(raum) AS aum_data_points, stddev_samp(aum_change) AS aum_volatility, avg(aum_change) AS aum_trend,
         max(aum) FILTER (WHERE newest = 1) AS aum,
         count(cco_name) AS officer_filings,
         count(*) FILTER (WHERE cco_name IS NOT NULL AND (prev_cco IS NULL OR prev_cco <> cco_name)) AS cco_changes
  FROM stepped2 GROUP BY crd
),
components AS (
  SELECT m.*, total_clients, total_accounts, client_account_ratio, years_active AS officer_years,
         least(greatest(ln(1 + disclosure_count / greatest(years_active, 0.1)) / ln(10), 0), 1) AS disclosure_risk,
         CASE WHEN aum_data_points >= 2 THEN coalesce(least(aum_volatility * 10, 1), 0) ELSE 0 END AS aum_volatility_risk,
         coalesce(least(greatest(client_account_ratio / (SELECT scale FROM scale), 0), 1), 0) AS client_concentration_risk,
         least(greatest(1 - filing_count / greatest(years_active, 0.1) / 4, 0), 1) AS filing_compliance_risk,
         CASE WHEN officer_filings >= 2 THEN least(cco_changes / 5.0, 1) ELSE 0 END AS cco_stability_risk,
         tanh(abs(coalesce(aum, 0) - 5e9) / 5e9) AS size_factor_risk
  FROM measures m LEFT JOIN counted c ON c.crd = m.crd
),
weighted_raw AS (
  SELECT *, least(greatest(disclosure_risk * 0.35 + aum_volatility_risk * 0.20 + client_concentration_risk * 0.15
       + filing_compliance_risk * 0.15 + cco_stability_risk * 0.10 + size_factor_risk * 0.05, 0), 1) AS total
  FROM components
),
weighted AS (
  SELECT crd, {', '.join(f"floor({c} * 1e4 + 0.5) / 1e4 AS {a}" for c, a in (
      ("total", "overall_risk_score"), ("disclosure_risk", "disclosure_risk"),
      ("aum_volatility_risk", "aum_volatility_risk"), ("client_concentration_risk", "client_concentration_risk"),
      ("filing_compliance_risk", "filing_compliance_risk"), ("cco_stability_risk", "cco_stability_risk"),
      ("size_factor_risk", "size_factor_risk")))},
      {_category("total", 0.8, 0.6, 0.3)} AS risk_category
  FROM weighted_raw
)"""
WEIGHTED_COLUMNS = """overall_risk_score, risk_category, disclosure_risk, aum_volatility_risk,
  client_concentration_risk, filing_compliance_risk, cco_stability_risk, size_factor_risk"""

WEIGHTED_OF_W = ", ".join(f"w.{c.strip()}" for c in WEIGHTED_COLUMNS.split(","))
OFFICER_CHANGES = "CASE WHEN officer_filings >= 2 THEN cco_changes ELSE 0 END"
FACTOR_VALUES = {
    "disclosure_rate": "disclosure_count / greatest(years_active, 0.1)",
    "years_active": "years_active",
    "aum_volatility": "CASE WHEN aum_data_points >= 2 THEN aum_volatility ELSE 0 END",
    "aum_trend": "CASE WHEN aum_data_points >= 2 THEN aum_trend ELSE 0 END",
    "client_account_ratio": "client_account_ratio",
    "filing_frequency": "filing_count / greatest(years_active, 0.1)",
    "compliance_ratio": "filing_count / greatest(years_active, 0.1) / 4",
    "avg_tenure_years": "CASE WHEN officer_filings >= 2 THEN officer_years / greatest(cco_changes, 1) ELSE 0 END",
    "aum": "aum",
    "size_deviation": "abs(coalesce(aum, 0) - 5e9) / 5e9",
}
CALCULATED = "strftime((SELECT max(CAST(o_orderdate AS DATE)) FROM orders), '%Y-%m-%d 00:00:00') AS last_calculation_date"
DOCUMENT = f"c.disclosure_count, {OFFICER_CHANGES} AS cco_changes, c.filing_count"


def _component(name: str, *columns: str) -> str:
    shown = ", ".join(columns)
    return f"WITH {MODEL} SELECT crd, {shown + ', ' if shown else ''}{_round6(name)} AS {name} FROM components"


def _top_drops(column: str, pct: str) -> str:
    return f"""WITH {FILINGS}, stepped AS (
      SELECT sec_number, filing_date, day, {column},
             lag({column}) OVER (PARTITION BY sec_number ORDER BY filing_date) AS prev_{column} FROM filings)
    SELECT sec_number, day AS filing_date, {column}, prev_{column}, {pct} AS drop_pct FROM stepped
    WHERE prev_{column} > 0 AND {column} < prev_{column} ORDER BY drop_pct DESC, sec_number, stepped.filing_date LIMIT 10"""


def _asof(inner: bool) -> str:
    return f"""WITH {RAW}, dates AS (
      SELECT sec_number, filing_date, raum, cco_name FROM raw
      QUALIFY row_number() OVER (PARTITION BY sec_number, filing_date ORDER BY filing_key DESC) = 1),
    stepped AS (SELECT sec_number, filing_date, lag(filing_date) OVER w AS pd, lag(raum) OVER w AS pr, lag(cco_name) OVER w AS pc
      FROM dates WINDOW w AS (PARTITION BY sec_number ORDER BY filing_date))
    SELECT r.sec_number, CAST(r.filing_date AS VARCHAR) AS filing_date, filing_key,
           CAST(pd AS VARCHAR) AS prev_filing_date, CAST(pr AS DOUBLE) AS prev_raum, pc AS prev_cco_name
    FROM raw r JOIN stepped s ON s.sec_number = r.sec_number AND s.filing_date = r.filing_date
    {"WHERE pd IS NOT NULL" if inner else ""}"""


def _factor_stats(source: str, table: str, names: tuple[str, ...], null_as_absent: bool) -> str:
    parts = " UNION ALL ".join(f"SELECT '{n}' AS factor, CAST({n} AS DOUBLE) AS value FROM {table}" for n in names)
    present = "WHERE value IS NOT NULL" if null_as_absent else ""
    return f"""WITH {source}, pairs AS ({parts})
    SELECT factor, count(*) AS scores, count(*) FILTER (WHERE value > 0) AS non_zero,
           {_share("count(*) FILTER (WHERE value > 0)", "count(*)")} AS non_zero_pct,
           {_round6("avg(value)")} AS avg_value, greatest(max(value), 0.0) AS max_value,
           count(*) FILTER (WHERE value > 0) > 0 AS working
    FROM pairs {present} GROUP BY factor"""


def _statistics(source: str, distinct: bool) -> str:
    counted = "count(DISTINCT sec_number)" if distinct else "count(*)"
    scope = "" if distinct else "WHERE filing_date = (SELECT max(filing_date) FROM scores)"
    return f"""WITH {source}, g AS (
      SELECT risk_category, {counted} AS firm_count, {_mean2("sum(score)", "count(*)")} AS avg_score
      FROM scores {scope} GROUP BY risk_category)
    SELECT risk_category, firm_count,
           {_share("firm_count", "CAST(sum(firm_count) OVER () AS BIGINT)")} AS percentage, avg_score FROM g"""


def _summary(source: str, table: str, score: str, round_range: bool = False) -> str:
    low, high = (f"{_round6(f'{f}({score})')}" if round_range else f"{f}({score})" for f in ("min", "max"))
    return f"""WITH {source} SELECT risk_category, count(*) AS count, {_round6(f"avg({score})")} AS avg_score,
      {low} AS min_score, {high} AS max_score FROM {table} GROUP BY risk_category"""


def _page(where: str, order: str, offset: int) -> str:
    return f"""WITH {MODEL}, found AS (
      SELECT f.crd, f.raum AS aum, f.client_count AS total_clients, f.account_count AS total_accounts,
             f.day AS last_filing_date, {WEIGHTED_COLUMNS}
      FROM (SELECT * FROM stepped WHERE newest = 1) f LEFT JOIN weighted w ON w.crd = f.crd WHERE {where})
    SELECT crd, CAST(aum AS DOUBLE) AS aum, total_clients, total_accounts, last_filing_date, {WEIGHTED_COLUMNS},
           (SELECT count(*) FROM found) AS total, CAST(ceil((SELECT count(*) FROM found) / 20.0) AS BIGINT) AS total_pages
    FROM found ORDER BY {order} LIMIT 20 OFFSET {offset}"""


def _first_after(order: str) -> str:
    """The second page of 20 without the totals."""
    return f"SELECT * EXCLUDE (total, total_pages) FROM ({_page('TRUE', order, 20)})"


FILE_KINDS = """(VALUES ('in/ia', '.csv', TRUE, FALSE), ('in/ia-', '.XLSX', TRUE, FALSE),
  ('in/', 'exempt.csv', FALSE, TRUE), ('in/FOIA', '.csv', FALSE, FALSE), ('in/._ia', '.csv', FALSE, FALSE),
  ('in/note', '.txt', FALSE, FALSE)) AS kinds(a, b, yes, exempt)"""

FILES = f"""{FILINGS},
report AS (
  SELECT printf('%012d-%d.zip!/form/ia%s.csv', crd, year(filing_date), strftime(filing_date, '%m%d%Y')) AS source_file,
         CASE WHEN crd % 5 = 0 AND raum IS NOT NULL THEN 1::BIGINT ELSE 0 END AS rows_loaded,
         CASE WHEN crd % 5 = 0 AND raum IS NULL THEN 1::BIGINT ELSE 0 END AS rows_rejected,
         crd % 5 = 0 AND raum IS NOT NULL AS success,
         CASE WHEN crd % 5 = 0 AND raum IS NOT NULL THEN 'Success' WHEN crd % 5 IN (0, 1) THEN 'No valid records'
              WHEN crd % 5 = 2 THEN 'empty file' WHEN crd % 5 = 3 THEN 'archive member cannot be read'
              ELSE 'archive member is encrypted' END AS message
  FROM filings
)"""


def _disclosed(how: str, limit: int) -> str:
    return f"""WITH {SCORES} SELECT f.sec_number, f.day AS filing_date, firm_name, CAST(raum AS DOUBLE) AS raum,
      disciplinary_disclosures, score, risk_category
    FROM filings f {how} JOIN scores s ON s.sec_number = f.sec_number AND s.filing_date = f.filing_date
    WHERE disciplinary_disclosures > 0
    ORDER BY disciplinary_disclosures DESC, score DESC NULLS LAST, f.sec_number, f.filing_date LIMIT {limit}"""


def _gap(source: str, table: str, carried: str) -> str:
    return f"""WITH {source}, e AS (SELECT count(*) AS firms_with_raum,
        count(*) FILTER (WHERE disciplinary_disclosures > 0) AS firms_with_disclosures FROM filings WHERE raum > 0),
      c AS (SELECT count(*) AS total_risk_scores, count(*) FILTER (WHERE {carried}) AS with_disciplinary FROM {table})
    SELECT *, firms_with_disclosures - with_disciplinary AS missing FROM e, c"""


def _json_object(names: tuple[str, ...], text_of: dict[str, str]) -> str:
    parts = [f"""CASE WHEN {n} IS NULL THEN '' ELSE ',"{n}":' || CAST({text_of.get(n, n)} AS VARCHAR) END""" for n in names]
    return "'{' || substr(" + " || ".join(parts) + ", 2) || '}'"


_FORM_TYPES = """
  CAST(NULL AS VARCHAR) AS legal_name, CAST(NULL AS VARCHAR) AS sec_status, day AS sec_status_date,
  CAST(NULL AS VARCHAR) AS cco_phone, CAST(NULL AS VARCHAR) AS cco_email, CAST(NULL AS VARCHAR) AS website,
  CAST(NULL AS VARCHAR) AS main_office_city, CAST(NULL AS VARCHAR) AS main_office_state,
  CASE firm_type WHEN 'BUILDING' THEN TRUE WHEN 'MACHINERY' THEN FALSE END AS umbrella_registration"""


def _normalized(where: str = "raum IS NOT NULL", accounts: str = "account_count", disclosures: str | None = None) -> str:
    disclosed = disclosures or "CASE WHEN disciplinary_disclosures > 0 THEN 1 ELSE 0 END"
    return f"""WITH {FILINGS} SELECT sec_number, lpad(crd_number, 12, '0') AS crd_number, day AS filing_date,
      'Société ' || firm_name AS firm_name, sec_region, CAST(raum AS DOUBLE) AS raum, client_count,
      {accounts} AS account_count, cco_name, firm_type, main_office_country,
      {disclosed} AS disciplinary_disclosures, {_FORM_TYPES}
    FROM filings WHERE {where}"""


_NAME_FORMS = """
  SELECT 'ia' || strftime(filing_date, '%m%d%Y') || '.zip' AS file_name, filing_date AS d, year(filing_date) AS y FROM dates
  UNION ALL SELECT 'IA' || strftime(filing_date, '%m%d%y') || '.xlsx', short_date, NULL FROM dates
  UNION ALL SELECT 'raw/ia-' || strftime(filing_date, '%m%d%y') || '.zip', short_date, year(short_date) FROM dates
  UNION ALL SELECT 'ia' || strftime(filing_date, '%m%d%y') || '-2.zip', short_date, year(short_date) FROM dates
  UNION ALL SELECT 'summary' || strftime(filing_date, '%m%d%y') || '.csv', NULL, NULL FROM dates"""


def _grouped(value: str) -> str:
    """Whole number with thousands separators."""
    return f"format('{{:,}}', CAST({value} AS BIGINT))"


def _in_units(unit: int, suffix: str) -> str:
    tenths = f"((CAST(raum AS HUGEINT) * 20 + {unit}) // {2 * unit})"
    return f"'$' || ({tenths} // 10) || '.' || ({tenths} % 10) || '{suffix}'"


_PROFILED = (
    ("sec_number", "string"), ("crd_number", "string"), ("filing_date", "date"), ("filing_key", "bigint"),
    ("raum", "decimal(20,2)"), ("cco_name", "string"), ("client_count", "int"), ("account_count", "int"),
    ("disciplinary_disclosures", "int"), ("firm_name", "string"), ("firm_type", "string"), ("sec_region", "string"),
    ("main_office_country", "string"),
)


def _profile() -> str:
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS total_rows, count({c}) AS non_null, count(DISTINCT {c}) AS distinct_values,
        min(CAST({c} AS VARCHAR)) AS min_text, max(CAST({c} AS VARCHAR)) AS max_text, '{t}' AS data_type FROM filings"""
        for c, t in _PROFILED
    )
    return f"WITH {FILINGS} {parts}"


def _ranges() -> str:
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value,
        (SELECT coalesce(string_agg(CAST(v AS VARCHAR), ' | ' ORDER BY v), '') FROM
          (SELECT DISTINCT {c} AS v FROM filings WHERE {c} IS NOT NULL ORDER BY v LIMIT 10)) AS sample_values FROM filings"""
        for c, _ in _PROFILED
    )
    return f"WITH {FILINGS} {parts}"


ORACLES: dict[str, str] = {
    "filing_changes": f"WITH {_changes()} SELECT {CHANGE_COLUMNS} FROM changes",
    "filing_changes_as_written": f"WITH {_changes('as_written')} SELECT {CHANGE_COLUMNS} FROM changes",
    "filing_changes_require_prev": f"WITH {_changes('require_prev')} SELECT {CHANGE_COLUMNS} FROM changes",
    "population_report": f"""WITH {_changes()} SELECT count(*) AS records,
      count(*) FILTER (WHERE new_disc_flag) AS new_disclosures, count(*) FILTER (WHERE cco_changed) AS officer_changes,
      count(*) FILTER (WHERE raum_drop_pct >= 25) AS large_raum_drops FROM changes""",
    "risk_points": f"""WITH {_changes()} SELECT sec_number, day AS filing_date,
      {', '.join(f'{sql} AS {name}' for name, sql in POINTS.items())}, {' + '.join(POINTS.values())} AS score FROM changes""",
    "risk_scores": f"WITH {SCORES} SELECT {SCORE_COLUMNS} FROM scores",
    "risk_scores_as_written": f"WITH {_scores('as_written')} SELECT {SCORE_COLUMNS} FROM scores",
    "risk_factors_json": f"""WITH {SCORES} SELECT sec_number, day AS filing_date,
      {_json_object(FACTOR_NAMES, {})} AS factors_json FROM scores""",
    "client_drop_top": _top_drops("client_count", _pct("prev_client_count", "client_count")),
    "account_drop_top": _top_drops("account_count", _pct("prev_account_count", "account_count")),
    "account_drop_top_as_written": _top_drops(
        "account_count", "CAST((prev_account_count - account_count) // prev_account_count * 100 AS DOUBLE)"
    ),
    "dedupe_filings": f"""WITH {FILINGS} SELECT sec_number, day AS filing_date, filing_key,
      CAST(raum AS DOUBLE) AS raum, cco_name FROM filings""",
    "duplicate_filings": f"""WITH {RAW} SELECT sec_number, CAST(filing_date AS VARCHAR) AS filing_date, filing_key,
      CAST(raum AS DOUBLE) AS raum FROM raw
      QUALIFY row_number() OVER (PARTITION BY sec_number, filing_date ORDER BY filing_key DESC) > 1""",
    "asof_previous_filing": _asof(False),
    "asof_previous_filing_inner": _asof(True),
    "latest_per_firm": f"""WITH {RAW} SELECT sec_number, CAST(filing_date AS VARCHAR) AS filing_date, filing_key,
      CAST(raum AS DOUBLE) AS raum, firm_name FROM raw
      QUALIFY row_number() OVER (PARTITION BY sec_number ORDER BY raw.filing_date DESC, filing_key DESC) = 1""",
    "latest_per_firm_ties": f"""WITH {RAW} SELECT sec_number, CAST(filing_date AS VARCHAR) AS filing_date, filing_key,
      CAST(raum AS DOUBLE) AS raum FROM raw QUALIFY rank() OVER (PARTITION BY sec_number ORDER BY raw.filing_date DESC) = 1""",
    "risk_statistics_latest": _statistics(SCORES, distinct=False),
    "risk_stats_latest_minmax": f"""WITH {SCORES} SELECT risk_category, count(*) AS firm_count, avg(score) AS avg_score,
      min(score) AS min_score, max(score) AS max_score FROM scores
      WHERE filing_date = (SELECT max(filing_date) FROM scores) GROUP BY risk_category""",
    "risk_statistics_all_dates": _statistics(SCORES, distinct=True),
    "category_summary": _summary(SCORES, "scores", "score"),
    "category_cards": f"""WITH {SCORES} SELECT count(DISTINCT sec_number) AS total_firms,
      {', '.join(f"count(DISTINCT sec_number) FILTER (WHERE risk_category = '{c}') AS {c.lower()}_firms"
                 for c in ('Critical', 'High', 'Medium', 'Low'))} FROM scores""",
    "dashboard_summary": f"""WITH {SCORES}, g AS (
        SELECT risk_category, count(DISTINCT sec_number) AS firm_count, {_mean2("sum(score)", "count(*)")} AS avg_score
        FROM scores GROUP BY risk_category)
      SELECT risk_category, firm_count, {_share("firm_count", "CAST(sum(firm_count) OVER () AS BIGINT)")} AS percentage,
        avg_score, (SELECT count(DISTINCT sec_number) FROM scores) AS total_firms,
        (SELECT count(*) FROM filings WHERE filing_date >= (SELECT max(filing_date) FROM filings) - 30) AS recent_filings
      FROM g""",
    "risk_run_summary": f"""WITH {SCORES} SELECT risk_category, count(*) AS firm_count,
        (SELECT count(*) FROM scores) AS total_scores, CAST(max(filing_date) AS VARCHAR) AS latest_date
      FROM scores WHERE filing_date = (SELECT max(filing_date) FROM scores) GROUP BY risk_category""",
    "dashboard_stats": f"""WITH {FILINGS} SELECT count(DISTINCT sec_number) AS total_firms, count(*) AS total_filings,
      max(day) AS latest_filing_date, {_round2("sum(CAST(raum AS DECIMAL(38,2))) / CAST(count(raum) AS DOUBLE)")} AS avg_raum,
      count(*) FILTER (WHERE raum >= 1000000000) AS firms_over_1b,
      count(*) FILTER (WHERE raum >= 100000000) AS firms_over_100m,
      count(*) FILTER (WHERE raum < 100000000) AS firms_under_100m FROM filings""",
    "filing_census": f"""WITH {FILINGS} SELECT count(*) AS total_filings, count(DISTINCT sec_number) AS unique_firms,
      count(DISTINCT filing_date) AS unique_dates, min(day) AS first_date, max(day) AS last_date,
      count(*) FILTER (WHERE sec_number IS NULL) AS null_sec_numbers,
      count(*) FILTER (WHERE filing_date IS NULL) AS null_filing_dates FROM filings""",
    "asset_filing_census": f"""WITH {FILINGS} SELECT count(*) AS total_filings, count(DISTINCT sec_number) AS unique_firms,
      count(DISTINCT filing_date) AS unique_dates, min(day) AS first_date, max(day) AS last_date,
      count(*) FILTER (WHERE sec_number IS NULL) AS null_sec_numbers,
      count(*) FILTER (WHERE filing_date IS NULL) AS null_filing_dates FROM filings WHERE raum > 0""",
    "filing_sample": f"""WITH {FILINGS} SELECT sec_number, day AS filing_date, firm_name, CAST(raum AS DOUBLE) AS raum,
      client_count, account_count FROM filings ORDER BY sec_number, filings.filing_date LIMIT 10""",
    "standing_views": f"""WITH {SCORES} SELECT risk_category, count(*) AS firm_count, min(score) AS min_score,
        max(score) AS max_score, (SELECT count(DISTINCT sec_number) FROM filings) AS total_firms,
        (SELECT count(*) FROM filings) AS total_filings
      FROM scores WHERE filing_date = (SELECT max(filing_date) FROM scores) GROUP BY risk_category""",
    "recent_filings": f"""WITH {FILINGS} SELECT count(*) AS recent_filings FROM filings
      WHERE filing_date >= (SELECT max(filing_date) FROM filings) - 30""",
    "raum_counts": f"""WITH {FILINGS} SELECT count(*) AS total_firms, count(*) FILTER (WHERE raum > 0) AS firms_with_raum,
      count(*) FILTER (WHERE raum = 0) AS firms_raum_zero, count(*) FILTER (WHERE raum IS NULL) AS firms_raum_null,
      count(*) FILTER (WHERE raum = 0 OR raum IS NULL) AS missing_firms,
      count(*) FILTER (WHERE (raum = 0 OR raum IS NULL) AND disciplinary_disclosures > 0) AS missing_with_disclosures
      FROM filings""",
    "raum_status_breakdown": f"""WITH {FILINGS} SELECT
        CASE WHEN raum > 0 THEN 'RAUM > 0' WHEN raum = 0 THEN 'RAUM = 0' WHEN raum IS NULL THEN 'RAUM = NULL' END AS raum_status,
        count(*) AS total_firms, count(*) FILTER (WHERE disciplinary_disclosures > 0) AS firms_with_disclosures,
        {_share("count(*) FILTER (WHERE disciplinary_disclosures > 0)", "count(*)")} AS disclosure_pct
      FROM filings GROUP BY 1""",
    "scoring_coverage": f"""WITH {FILINGS}, latest AS (SELECT * FROM filings WHERE raum > 0
        QUALIFY row_number() OVER (PARTITION BY sec_number ORDER BY filing_date DESC) = 1)
      SELECT count(*) AS firms_processed, count(*) FILTER (WHERE disciplinary_disclosures > 0) AS with_disclosures,
        {_share("count(*) FILTER (WHERE disciplinary_disclosures > 0)", "count(*)")} AS disclosure_pct FROM latest""",
    "disclosure_counts": f"""WITH {FILINGS} SELECT count(*) AS total_firms,
      count(*) FILTER (WHERE disciplinary_disclosures > 0) AS with_disclosures,
      count(*) FILTER (WHERE disciplinary_disclosures = 0) AS zero_disclosures,
      count(*) FILTER (WHERE disciplinary_disclosures IS NULL) AS null_disclosures,
      CAST(sum(disciplinary_disclosures) AS BIGINT) AS total_disclosures FROM filings""",
    "disclosure_histogram": f"""WITH {FILINGS} SELECT disciplinary_disclosures, count(*) AS count FROM filings
      GROUP BY disciplinary_disclosures""",
    "count_anomalies": f"""WITH {FILINGS} SELECT count(*) AS total_records,
      {', '.join(f'''count(*) FILTER (WHERE {c} IS NULL) AS null_{n}, count(*) FILTER (WHERE {c} < 0) AS negative_{n},
        count(*) FILTER (WHERE {c} = 0) AS zero_{n}, count(*) FILTER (WHERE {c} > 1000000) AS huge_{n}, max({c}) AS max_{n}'''
                 for c, n in (('client_count', 'clients'), ('account_count', 'accounts')))} FROM filings""",
    "raum_percentiles": f"""WITH {FILINGS} SELECT count(*) AS total_firms, count(*) FILTER (WHERE raum > 0) AS firms_with_raum,
      CAST(min(raum) AS DOUBLE) AS min_raum, CAST(max(raum) AS DOUBLE) AS max_raum,
      {_round2("sum(CAST(raum AS DECIMAL(38,2))) / CAST(count(raum) AS DOUBLE)")} AS avg_raum,
      {', '.join(f"{_round2(f'quantile_cont(CAST(raum AS DOUBLE), {p})')} AS {n}"
                 for n, p in (('median_raum', 0.5), ('p95_raum', 0.95), ('p99_raum', 0.99)))} FROM filings""",
    "filings_by_date": f"WITH {FILINGS} SELECT day AS filing_date, count(*) AS count FROM filings GROUP BY day",
    "filings_by_year": f"""WITH {FILINGS} SELECT CAST(year(filing_date) AS INTEGER) AS year, count(*) AS count
      FROM filings GROUP BY 1""",
    "multi_filing_firms": f"""WITH {FILINGS} SELECT sec_number, count(*) AS filing_count FROM filings WHERE raum > 0
      GROUP BY sec_number HAVING count(*) > 1 ORDER BY filing_count DESC, sec_number LIMIT 10""",
    "column_profile": _profile(),
    "column_ranges": _ranges(),
    "firms_by_category": f"""WITH {SCORES} SELECT s.sec_number, coalesce(firm_name, 'Unknown') AS firm_name, score,
        risk_category, s.day AS filing_date
      FROM scores s LEFT JOIN filings f ON f.sec_number = s.sec_number AND f.filing_date = s.filing_date
      ORDER BY score DESC, s.filing_date DESC, s.sec_number LIMIT 100""",
    "firms_latest_profile": f"""WITH {SCORES}, latest AS (SELECT * FROM filings
        QUALIFY row_number() OVER (PARTITION BY sec_number ORDER BY filing_date DESC) = 1)
      SELECT s.sec_number, s.day AS filing_date, score, risk_category, coalesce(firm_name, 'Unknown') AS firm_name,
        l.day AS latest_filing_date, CAST(raum AS DOUBLE) AS raum, client_count, account_count
      FROM scores s LEFT JOIN latest l ON l.sec_number = s.sec_number WHERE risk_category = 'Critical'
      ORDER BY score DESC, l.filing_date DESC, s.sec_number, s.filing_date LIMIT 100""",
    "top_risky_firms": f"""WITH {SCORES} SELECT s.sec_number, s.day AS filing_date, score, risk_category,
        coalesce(firm_name, 'Unknown') AS firm_name
      FROM scores s LEFT JOIN filings f ON f.sec_number = s.sec_number AND f.filing_date = s.filing_date
      WHERE risk_category IN ('High', 'Critical') ORDER BY score DESC, s.filing_date DESC, s.sec_number LIMIT 10""",
    "firm_explorer": f"""WITH {SCORES}, latest AS (SELECT * FROM filings
        QUALIFY row_number() OVER (PARTITION BY sec_number ORDER BY filing_date DESC) = 1)
      SELECT s.sec_number, s.day AS filing_date, score, risk_category, coalesce(firm_name, 'Unknown') AS firm_name,
        l.day AS latest_filing_date, CAST(raum AS DOUBLE) AS raum, client_count, account_count
      FROM scores s LEFT JOIN latest l ON l.sec_number = s.sec_number
      WHERE score >= 60 AND score < 80 AND new_disc <> 0
        AND (contains(lower(firm_name), 'customer#0000001') OR contains(lower(s.sec_number), 'customer#0000001'))
      ORDER BY score DESC, l.filing_date DESC, s.sec_number, s.filing_date LIMIT 50""",
    "firm_page": _page("TRUE", "crd", 20),
    "firm_page_search": _page(
        "contains(CAST(f.crd AS VARCHAR), '1') AND raum BETWEEN 1e8 AND 1e11", "found.aum DESC NULLS FIRST, crd", 0
    ),
    "firm_detail": f"""WITH {MODEL} SELECT f.crd, CAST(raum AS DOUBLE) AS aum, client_count AS total_clients,
        account_count AS total_accounts, day AS last_filing_date, {WEIGHTED_COLUMNS}
      FROM stepped f LEFT JOIN weighted w ON w.crd = f.crd WHERE newest = 1""",
    "top_raum": f"""WITH {FILINGS} SELECT sec_number, firm_name, CAST(raum AS DOUBLE) AS raum, day AS filing_date
      FROM filings WHERE raum > 0 ORDER BY filings.raum DESC, sec_number, filings.filing_date LIMIT 10""",
    "top_disclosures": f"""WITH {FILINGS} SELECT sec_number, day AS filing_date, firm_name, disciplinary_disclosures
      FROM filings WHERE disciplinary_disclosures > 0
      ORDER BY disciplinary_disclosures DESC, sec_number, filings.filing_date LIMIT 10""",
    "disclosed_firms": _disclosed("INNER", 10),
    "disclosed_firms_left": _disclosed("LEFT", 5),
    "excluded_disclosed_firms": f"""WITH {FILINGS} SELECT firm_name, sec_number, CAST(raum AS DOUBLE) AS raum,
        disciplinary_disclosures, day AS filing_date
      FROM filings WHERE disciplinary_disclosures > 0 AND (filings.raum = 0 OR filings.raum IS NULL)
      ORDER BY filings.filing_date DESC, sec_number LIMIT 10""",
    "coverage_gap": _gap(SINGLE, "single_scores", "disciplinary_risk IS NOT NULL"),
    "coverage_gap_change_model": _gap(SCORES, "scores", "FALSE"),
    "disclosure_arrays": f"""WITH {SCORES} SELECT sec_number, day AS filing_date, new_disc AS disclosures,
      new_disc AS new_disclosures, new_disc = 1 AND risk_category IN ('High', 'Critical') AS has_high_severity,
      CASE WHEN new_disc = 1 THEN risk_category END AS first_severity FROM scores""",
    "factor_contribution": _factor_stats(SCORES, "scores", FACTOR_NAMES, False),
    "factor_contribution_single": _factor_stats(SINGLE, "single_scores", SINGLE_NAMES, True),
    "factor_presence": f"""WITH {SCORES} SELECT count(*) AS total, CAST(0 AS BIGINT) AS empty_factors,
      count(*) AS has_factors FROM scores""",
    "top_factors": f"""WITH {SCORES}, top AS (SELECT * FROM scores ORDER BY score DESC, sec_number, filing_date LIMIT 10),
      pairs AS ({' UNION ALL '.join(
          f"SELECT sec_number, filing_date, score, risk_category, '{n}' AS factor, CAST({n} AS DOUBLE) AS value FROM top"
          for n in FACTOR_NAMES)})
      SELECT p.sec_number, day AS filing_date, coalesce(firm_name, 'Unknown') AS firm_name, score, risk_category,
        CAST(raum AS DOUBLE) AS raum, client_count, disciplinary_disclosures, factor, value
      FROM pairs p LEFT JOIN filings f ON f.sec_number = p.sec_number AND f.filing_date = p.filing_date""",
    "single_filing_score": f"""WITH {SINGLE} SELECT sec_number, day AS filing_date, score, risk_category,
      {', '.join(SINGLE_NAMES)} FROM single_scores""",
    "single_filing_json": f"""WITH {SINGLE} SELECT sec_number, day AS filing_date,
      {_json_object(SINGLE_NAMES, {})} AS factors_json FROM single_scores""",
    "single_filing_summary": _summary(SINGLE, "single_scores", "score"),
    "single_filing_top": f"""WITH {SINGLE} SELECT s.sec_number, s.day AS filing_date, score, risk_category,
        coalesce(firm_name, 'Unknown') AS firm_name
      FROM single_scores s LEFT JOIN filings f ON f.sec_number = s.sec_number AND f.filing_date = s.filing_date
      ORDER BY score DESC, s.filing_date DESC, s.sec_number LIMIT 10""",
    "preview_score": f"""WITH {FILINGS}, p AS (SELECT sec_number, day AS filing_date,
        10 * coalesce(disciplinary_disclosures, 0) AS disciplinary_risk,
        CASE WHEN raum > 1000000000 THEN 5 WHEN raum > 100000000 THEN 3 WHEN raum > 10000000 THEN 1 ELSE 0 END AS size_risk
        FROM filings) SELECT *, disciplinary_risk + size_risk AS overall_risk FROM p""",
    "disclosure_component": _component(
        "disclosure_risk", "disclosure_count", "filing_count", f"{_round6('years_active')} AS years_active"
    ),
    "aum_volatility_component": _component(
        "aum_volatility_risk", "aum_data_points", f"{_round6('aum_volatility')} AS aum_volatility",
        f"{_round6('aum_trend')} AS aum_trend",
    ),
    "concentration_component": _component(
        "client_concentration_risk", f"{_round6('client_account_ratio')} AS client_account_ratio", "total_clients",
        "total_accounts",
    ),
    "filing_compliance_component": _component(
        "filing_compliance_risk", "filing_count", f"{_round6('years_active')} AS years_active"
    ),
    "cco_component": _component(
        "cco_stability_risk", "officer_filings", "cco_changes", f"{_round6('officer_years')} AS officer_years"
    ),
    "size_component": _component("size_factor_risk", f"{_round6('aum')} AS aum"),
    "ratio_scale": f"WITH {MODEL} SELECT {_round6('scale')} AS scale FROM scale",
    "period_changes": f"""WITH {MODEL} SELECT crd, day AS filing_date, aum AS raum, {_round6('aum_change')} AS aum_change
      FROM stepped2 WHERE raum IS NOT NULL""",
    "weighted_score": f"WITH {MODEL} SELECT crd, {WEIGHTED_COLUMNS} FROM weighted",
    "weighted_factors": f"""WITH {MODEL} SELECT crd, disclosure_count, aum_data_points, total_clients, total_accounts,
        filing_count, {OFFICER_CHANGES} AS cco_changes, {', '.join(f'{_round6(v)} AS {k}' for k, v in FACTOR_VALUES.items())}
      FROM components""",
    "firm_detail_factors": f"""WITH {MODEL} SELECT f.crd, CAST(f.raum AS DOUBLE) AS aum, f.client_count AS total_clients,
        f.account_count AS total_accounts, f.day AS last_filing_date, {WEIGHTED_OF_W}, {CALCULATED}, {DOCUMENT}
      FROM stepped f LEFT JOIN weighted w ON w.crd = f.crd LEFT JOIN components c ON c.crd = f.crd WHERE newest = 1""",
    "firm_page_factors": f"""SELECT page.*, {CALCULATED}, {DOCUMENT}
      FROM ({_page('TRUE', 'overall_risk_score DESC NULLS FIRST, crd', 0)}) page
      LEFT JOIN (WITH {MODEL} SELECT * FROM components) c ON c.crd = page.crd""",
    "weighted_summary": _summary(MODEL, "weighted", "overall_risk_score", round_range=True),
    "category_distribution_filled": f"""WITH {MODEL}, kinds(position, risk_category, description) AS (VALUES
        (0, 'Low', 'Minimal risk indicators'), (1, 'Medium', 'Some risk indicators present'),
        (2, 'High', 'Multiple risk indicators'), (3, 'Critical', 'Severe risk indicators requiring immediate attention')),
      n AS (SELECT risk_category, count(*) AS n FROM weighted GROUP BY risk_category)
      SELECT position, kinds.risk_category, description, coalesce(n, 0) AS count,
        {_share("coalesce(n, 0)", "(SELECT count(*) FROM weighted)")} AS percentage
      FROM kinds LEFT JOIN n ON n.risk_category = kinds.risk_category""",
    "risk_trends": f"""WITH {MODEL} SELECT day AS filing_date,
        {', '.join(f"count(*) FILTER (WHERE risk_category = '{c}') AS {c.lower()}" for c in ('Low', 'Medium', 'High', 'Critical'))},
        count(*) FILTER (WHERE risk_category IS NULL) AS unscored
      FROM filings f LEFT JOIN weighted w ON w.crd = f.crd
      WHERE filing_date >= (SELECT max(filing_date) FROM filings) - 365 GROUP BY day""",
    "overview_stats": f"""WITH {MODEL}, {SCORES[SCORES.index('numbered AS'):]},
      latest AS (SELECT max(filing_date) AS d FROM filings)
      SELECT 'total_firms' AS metric, CAST(count(DISTINCT crd) AS DOUBLE) AS value FROM filings
      UNION ALL SELECT 'firms_with_recent_activity', count(DISTINCT crd) FROM filings, latest WHERE filing_date >= d - 30
      UNION ALL SELECT 'new_disclosures', count(DISTINCT crd) FROM filings, latest
        WHERE filing_date >= d - 30 AND disciplinary_disclosures > 0
      UNION ALL SELECT 'total_aum', coalesce(CAST(sum(raum) AS DOUBLE), 0) FROM filings, latest WHERE filing_date = d
      UNION ALL SELECT 'high_severity_alerts', count(*) FROM weighted WHERE risk_category IN ('Critical', 'High')
      UNION ALL SELECT 'risk_distribution.' || risk_category, count(*) FROM scores
        WHERE filing_date = (SELECT max(filing_date) FROM scores) GROUP BY risk_category""",
    "overview_stats_as_of": f"""WITH {MODEL}, {SCORES[SCORES.index('numbered AS'):]}
      SELECT 'total_firms' AS metric, CAST(count(DISTINCT crd) AS DOUBLE) AS value FROM filings
      UNION ALL SELECT 'firms_with_recent_activity', count(DISTINCT crd) FROM filings WHERE filing_date >= DATE '1998-04-01'
      UNION ALL SELECT 'new_disclosures', count(DISTINCT crd) FROM filings
        WHERE filing_date >= DATE '1998-04-01' AND disciplinary_disclosures > 0
      UNION ALL SELECT 'total_aum', coalesce(CAST(sum(raum) AS DOUBLE), 0) FROM filings
        WHERE filing_date = (SELECT max(filing_date) FROM filings)
      UNION ALL SELECT 'high_severity_alerts', count(*) FROM weighted WHERE risk_category IN ('Critical', 'High')
      UNION ALL SELECT 'risk_distribution.' || risk_category, count(*) FROM scores
        WHERE filing_date = (SELECT max(filing_date) FROM scores) GROUP BY risk_category""",
    "file_name_dates": f"""WITH {FILINGS}, dates AS (SELECT DISTINCT filing_date, CAST(make_date(
        CAST(2000 + year(filing_date) % 100 AS BIGINT), CAST(month(filing_date) AS BIGINT), CAST(day(filing_date) AS BIGINT))
        AS DATE) AS short_date FROM filings), names AS ({_NAME_FORMS})
      SELECT file_name, CAST(d AS VARCHAR) AS file_date, CAST(y AS INTEGER) AS archive_year FROM names""",
    "money_format": f"""WITH {FILINGS} SELECT sec_number, day AS filing_date,
        CASE WHEN raum IS NULL THEN 'N/A' WHEN raum >= 1e12 THEN {_in_units(10**12, 'T')}
          WHEN raum >= 1e9 THEN {_in_units(10**9, 'B')} WHEN raum >= 1e6 THEN {_in_units(10**6, 'M')}
          ELSE '$' || {_grouped('raum')} END AS label,
        CASE WHEN raum IS NULL THEN 'N/A' WHEN raum >= 1e6 THEN {_in_units(10**6, 'M')}
          ELSE '$' || ((CAST(raum AS HUGEINT) * 2 + 1000) // 2000) || 'K' END AS short_label,
        CASE WHEN raum IS NULL OR raum = 0 THEN 'N/A' ELSE '$' || {_grouped('raum')} END AS grouped
      FROM filings""",
    # By plain string functions: the given pages write every anchor as <a href="...">.
    "page_links": r"""WITH shown AS (
        SELECT page_id, url, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)<script.*?</script>', '', 'g') AS html
        FROM pages),
      parts AS (SELECT page_id, url, unnest(string_split(html, '<a href="')[2:]) AS part,
        generate_subscripts(string_split(html, '<a href="')[2:], 1) - 1 AS position FROM shown),
      parsed AS (SELECT page_id, url, position, string_split(part, '"')[1] AS href,
        string_split(part[instr(part, '>') + 1:], '</a>')[1] AS inner_html FROM parts),
      plain AS (SELECT page_id, url, position, trim(replace(replace(replace(replace(href, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) AS href,
        trim(replace(replace(replace(replace(regexp_replace(inner_html, '(?s)<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) AS label FROM parsed)
      SELECT page_id, CAST(position AS INTEGER) AS position, href, label, CASE WHEN starts_with(href, 'http') THEN href
        ELSE regexp_extract(url, '^([a-zA-Z]+://[^/]+)', 1) || href END AS link FROM plain""",
    "archive_links": f"""WITH {FILINGS}, dates AS (SELECT DISTINCT filing_date AS d FROM filings WHERE year(filing_date) >= 1998),
      numbered AS (SELECT d, strftime(d, '%m%d%Y') AS t, CAST(year(d) * 100 + month(d) AS BIGINT) AS page_id FROM
        (SELECT DISTINCT filing_date AS d FROM filings)),
      placed AS (SELECT *, 4 * (row_number() OVER (PARTITION BY page_id ORDER BY t) - 1) AS position FROM numbered)
      SELECT page_id, CAST(position AS INTEGER) AS position, '/files/ia' || t || '.zip' AS href,
        'Registered ' || t AS label, 'https://data.example.org/files/ia' || t || '.zip' AS link,
        CAST(year(d) AS INTEGER) AS year FROM placed WHERE year(d) >= 1998""",
    "normalize_raw": _normalized(),
    "normalize_raw_counts": _normalized(disclosures="disciplinary_disclosures"),
    "load_report": f"""WITH {FILINGS} SELECT 'ia' || strftime(filing_date, '%m%d%Y') || '.csv' AS source_file,
        count(raum) AS rows_loaded, count(*) - count(raum) AS rows_rejected, count(raum) > 0 AS success,
        CASE WHEN count(raum) > 0 THEN 'Success' ELSE 'No valid records' END AS message FROM filings GROUP BY filing_date""",
    "load_totals": f"""WITH {FILINGS}, r AS (SELECT filing_date, count(raum) AS ok, count(*) - count(raum) AS bad
        FROM filings GROUP BY filing_date)
      SELECT count(*) AS files, count(*) FILTER (WHERE ok > 0) AS files_loaded,
        count(*) FILTER (WHERE ok = 0) AS files_failed, CAST(sum(ok) AS BIGINT) AS rows_loaded,
        CAST(sum(bad) AS BIGINT) AS rows_rejected FROM r""",
    "csv_ingest": _normalized(
        "TRUE",
        "CASE WHEN filing_date < DATE '1998-01-01' THEN account_count END",
        """CASE WHEN filing_date < DATE '1998-01-01' THEN disciplinary_disclosures
           WHEN disciplinary_disclosures > 0 THEN 1 ELSE 0 END""",
    ),
    "zip_members": _normalized(),
    "archive_census": f"""WITH {FILINGS} SELECT lpad(crd_number, 12, '0') || '-' || year(filing_date) || '.zip' AS archive,
        count(*) + 1 AS files, count(*) AS csv_files, CAST(0 AS BIGINT) AS workbooks, CAST(1 AS BIGINT) AS other_files
      FROM filings GROUP BY crd_number, year(filing_date)""",
    "workbook_rows": _normalized(),
    "load_report_files": f"WITH {FILES} SELECT * FROM report",
    "failed_files": f"""WITH {FILES} SELECT source_file, message FROM report WHERE NOT success
      ORDER BY source_file LIMIT 10""",
    "incremental_store": f"WITH {SCORES} SELECT {SCORE_COLUMNS} FROM scores",
    "firm_page_after": _first_after("found.aum DESC NULLS FIRST, crd"),
    "sql_functions": f"""WITH stats AS ({_statistics(SCORES, distinct=False)}),
      high AS (WITH {SCORES} SELECT risk_category, count(*) AS n FROM scores WHERE score >= 50 GROUP BY risk_category)
      SELECT stats.*, coalesce(n, 0) AS high_scores FROM stats LEFT JOIN high USING (risk_category)""",
    "raum_percentiles_merged": f"""WITH {FILINGS} SELECT count(raum) AS "values", TRUE AS median_within, TRUE AS p95_within,
      TRUE AS p99_within FROM filings""",
    "append_roundtrip": f"""WITH {SCORES} SELECT sec_number, day AS filing_date, score, risk_category,
      CAST(year(filing_date) AS INTEGER) AS filing_year FROM scores""",
    "firm_detail_one": f"""WITH {MODEL} SELECT f.crd, CAST(raum AS DOUBLE) AS aum, client_count AS total_clients,
        account_count AS total_accounts, day AS last_filing_date, {WEIGHTED_COLUMNS}
      FROM stepped f LEFT JOIN weighted w ON w.crd = f.crd
      WHERE newest = 1 AND f.crd = (SELECT min(o_custkey) FROM orders)""",
    "loadable_files": f"""WITH d AS (SELECT DISTINCT strftime(CAST(o_orderdate AS DATE), '%m%d%Y') AS day FROM orders)
      SELECT a || day || b AS path, yes AS loadable, yes OR exempt AS loadable_exempt FROM d, {FILE_KINDS}""",
    "pending_files": f"""WITH d AS (SELECT DISTINCT strftime(CAST(o_orderdate AS DATE), '%m%d%Y') AS day FROM orders
        WHERE CAST(o_orderdate AS DATE) >= DATE '1996-01-01')
      SELECT a || day || b AS path FROM d, {FILE_KINDS} WHERE yes""",
    "replace_roundtrip": f"""WITH {SCORES} SELECT sec_number, day AS filing_date, score, risk_category FROM scores
      WHERE risk_category IN ('High', 'Critical')""",
    "incremental_ingest": f"WITH {SCORES} SELECT {SCORE_COLUMNS} FROM scores",
    "upsert_scores": f"""WITH {SCORES}, {_scores('as_written')[len(FILINGS) + 2:]
        .replace('numbered', 'numbered2').replace('compared', 'compared2').replace('changes AS', 'changes2 AS')
        .replace('FROM changes', 'FROM changes2').replace('summed', 'summed2').replace('scores AS', 'scores2 AS')}
      SELECT w.sec_number, w.day AS filing_date,
        CASE WHEN s.risk_category IN ('High', 'Critical') THEN s.score ELSE w.score END AS score,
        CASE WHEN s.risk_category IN ('High', 'Critical') THEN s.risk_category ELSE w.risk_category END AS risk_category,
        w.day AS created_at
      FROM scores2 w JOIN scores s ON s.sec_number = w.sec_number AND s.filing_date = w.filing_date""",
    "score_documents": f"""WITH {SCORES} SELECT '{{"risk_category":"' || risk_category || '","firm_count":' ||
        count(DISTINCT sec_number) || '}}' AS document FROM scores GROUP BY risk_category""",
}

ORACLES["upsert_roundtrip"] = ORACLES["upsert_scores"]
