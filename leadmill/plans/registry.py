"""Registry of named reports: a DataFrame builder and, where SQL can say it, the same result in ANSI SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from leadmill import constants as K
from leadmill.sources.contacts import sql_cte
from leadmill.sources.tables import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF_SQL = f"TIMESTAMP '{K.AS_OF:%Y-%m-%d %H:%M:%S}'"


def query(name: str, sql: str | None = None):
    """Register a report builder under ``name``."""
    def wrap(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build
    return wrap


# --- SQL text helpers --------------------------------------------------------

def quoted(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def sql_cut(col: str, edges: Sequence[float], labels: Sequence, lowest: bool = True) -> str:
    op = ">=" if lowest else ">"
    parts = [f"WHEN {col} IS NULL OR NOT ({col} {op} {edges[0]}) THEN NULL"]
    for upper, label in zip(edges[1:], labels):
        bound = "TRUE" if upper == K.INF else f"{col} <= {upper}"
        parts.append(f"WHEN {bound} THEN {quoted(label)}")
    return "CASE " + " ".join(parts) + " END"


def sql_ladder(col: str, steps, missing, op: str = "<=") -> str:
    parts = [f"WHEN {col} IS NULL THEN {quoted(missing)}"]
    for bound, label in steps:
        parts.append(f"WHEN {'TRUE' if bound is None else f'{col} {op} {bound}'} THEN {quoted(label)}")
    return "CASE " + " ".join(parts) + " END"


def sql_rules(col: str, rules, last: bool = False, default: str | None = "Other") -> str:
    parts = []
    for category, words in (list(rules)[::-1] if last else rules):
        hits = " OR ".join(f"contains(lower({col}), {quoted(w.lower())})" for w in words)
        parts.append(f"WHEN {hits} THEN {quoted(category)}")
    return "CASE " + " ".join(parts) + f" ELSE {quoted(default)} END"


def sql_map(col: str, mapping, default) -> str:
    return (f"CASE {col} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in mapping.items())
            + f" ELSE {quoted(default)} END")


def sql_days(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS BIGINT)"


def sql_fallback(first: str, second: str) -> str:
    return f"CASE WHEN {first} = 'Other' THEN {second} ELSE {first} END"


INDUSTRY_SQL = sql_rules("organization_industry", K.INDUSTRY_RULES, last=True)
SENIORITY_SQL = sql_fallback(sql_rules("seniority", K.SENIORITY_RULES, last=True),
                             sql_rules("title", K.TITLE_SENIORITY_RULES))
TITLE_SQL = sql_rules("title", K.TITLE_RULES, last=True)
SIZE_SQL = sql_cut("coalesce(organization_employees, -1)", *K.SIZE_BINS, lowest=False)

SEGMENTS_CTE = f"""segments AS (SELECT *,
  CASE WHEN email_open_count > 0 THEN 1 ELSE 0 END AS opened,
  CASE WHEN email_click_count > 0 THEN 1 ELSE 0 END AS clicked,
  CASE WHEN email_reply_count > 0 THEN 1 ELSE 0 END AS replied,
  {SIZE_SQL} AS company_size,
  {INDUSTRY_SQL} AS industry_category,
  {SENIORITY_SQL} AS seniority_category,
  {TITLE_SQL} AS title_category
  FROM contacts)"""


def on_contacts(select: str, ctes: str = "") -> str:
    """SQL over the contact table."""
    return f"WITH {sql_cte()}{', ' + ctes if ctes else ''}\n{select}"


def on_segments(select: str, ctes: str = "") -> str:
    """SQL over the contact table with outcome flags and categories."""
    return on_contacts(select, SEGMENTS_CTE + (", " + ctes if ctes else ""))


def kpi_sql(keys: Sequence[str], min_contacts: int = 0, min_rate: float | None = None, top: int | None = None,
            source: str = "segments") -> str:
    """The segment key figures as one grouped SELECT."""
    k = ", ".join(keys)
    having = [f"count(*) >= {min_contacts}"] if min_contacts else []
    if min_rate is not None:
        having.append(f"round_even(avg(opened), 4) >= {min_rate}")
    return f"""SELECT {k}, count(*) AS contact_count,
  CAST(sum(opened) AS BIGINT) AS total_opens, round_even(avg(opened), 4) AS open_rate,
  CAST(sum(clicked) AS BIGINT) AS total_clicks, round_even(avg(clicked), 4) AS click_rate,
  CAST(sum(replied) AS BIGINT) AS total_replies, round_even(avg(replied), 4) AS reply_rate
  FROM {source} WHERE {' AND '.join(c + ' IS NOT NULL' for c in keys)} GROUP BY {k}{' HAVING ' + ' AND '.join(having) if having else ''}""" + (
        f" ORDER BY open_rate DESC, {', '.join(c + ' NULLS LAST' for c in keys)} LIMIT {top}" if top else "")
