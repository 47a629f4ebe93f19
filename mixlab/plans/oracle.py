"""The same tables stated in SQL, as named steps that a check query builds on."""

from __future__ import annotations

import math

from mixlab.config import CHANNELS as MEDIA
from mixlab.functions.calendar import FIXED_HOLIDAYS, PROMO_DAYS, SHORT_PI, UK_HOLIDAYS
from mixlab.functions.carryover import channel_weights, geometric_weights
from mixlab.operators.simulate import QUARTERLY_GROWTH
from mixlab.plans.settings import CHANNELS, COEFS, INTERCEPT, MAX_PCT, MIN_PCT, PARAMS, TOTAL


def number(value: float) -> str:
    """A literal that is read as a double, with every digit."""
    return f"{float(value):.17e}"


def adstock_sql(col: str, weights, window: str) -> str:
    terms = [
        f"coalesce({f'lag({col}, {lag}) OVER {window}' if lag else col}, 0.0e0) * {number(w)}"
        for lag, w in enumerate(weights)
        if not lag or w != 0.0
    ]
    return " + ".join(terms)


def hill_sql(x: str, k: float, S: float) -> str:
    return f"power({x}, {number(k)}) / (power({x}, {number(k)}) + power({number(S)}, {number(k)}))"


def calendar_sql(pi: float, full: bool) -> str:
    dow = "(dayofweek(date) + 1)"
    parts = [f"CAST({dow} AS INTEGER) AS day_of_week"]
    if full:
        parts.append("CAST(day(date) AS INTEGER) AS day_of_month")
    parts.append("CAST(month(date) AS INTEGER) AS month")
    if full:
        parts += ["CAST(quarter(date) AS INTEGER) AS quarter", "CAST(year(date) AS INTEGER) AS year"]
    parts.append(f"CASE WHEN {dow} IN (1, 7) THEN 1 ELSE 0 END AS is_weekend")
    for name, value, period in (("day_of_week", dow, 7), ("month", "month(date)", 12)):
        for fn in ("sin", "cos"):
            parts.append(f"{fn}({number(2 * pi)} * {value} / {number(period)}) AS {name}_{fn}")
    return ", ".join(parts)


def dates_sql(days) -> str:
    listed = ", ".join(f"DATE '{d}'" for d in days)
    return f"CASE WHEN date IN ({listed}) THEN 1 ELSE 0 END"


def wave_sql(value: str, period: int) -> str:
    return f"sin({number(2 * math.pi)} * {value} / {number(period)})"


def uniform_sql(key: str, seed: int, tag: str) -> str:
    digest = f"md5(concat_ws('|', {key}, '{seed}', '{tag}'))"
    return f"(CAST(('0x' || substr({digest}, 1, 8)) AS BIGINT) / {number(2**32)})"


def total(parts) -> str:
    return " + ".join(parts)


_COLUMNS = ", ".join(CHANNELS)
_SALES_COLUMNS = ("revenue", "transactions", "unique_customers")
_EXTERNAL = ("consumer_confidence", "gdp_growth", "unemployment", "is_holiday", "is_promo_event")
_GROWTH = ", ".join(number(g) for g in QUARTERLY_GROWTH)

STEPS: dict[str, tuple[tuple[str, ...], str]] = {}


def _step(name: str, deps: tuple[str, ...], sql: str) -> None:
    STEPS[name] = (deps, sql)


_step("retail", (), """
SELECT *, Quantity * UnitPrice AS TotalAmount FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS InvoiceNo, l_partkey AS StockCode, p_name AS Description,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INT) AS Quantity,
         CAST(o_orderdate AS DATE) AS InvoiceDate,
         CAST(p_retailprice AS DECIMAL(10,2)) AS UnitPrice,
         CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_custkey END AS CustomerID,
         n_name AS Country, lower(p_type) AS channel,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS spend
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey)""")

_step("days", ("retail",), "SELECT DISTINCT InvoiceDate AS date FROM retail")

_step("sales", ("retail",), """
SELECT InvoiceDate AS date, CAST(sum(TotalAmount) AS DOUBLE) AS revenue,
       count(InvoiceNo) AS transactions, count(CustomerID) AS unique_customers
FROM retail GROUP BY 1""")

_step("entity_days", ("retail",), """
SELECT Country, channel, InvoiceDate AS date, CAST(sum(TotalAmount) AS DOUBLE) AS revenue, count(InvoiceNo) AS transactions,
       CAST(sum(spend) AS DOUBLE) AS spend
FROM retail GROUP BY 1, 2, 3""")

_step("entities", ("entity_days",), f"""
SELECT *, {adstock_sql('spend', geometric_weights(0.5, 5), 'w')} AS spend_adstock,
       CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
FROM entity_days WINDOW w AS (PARTITION BY Country, channel ORDER BY date)""")

_step("country_sales", ("retail",), """
SELECT Country, InvoiceDate AS date, CAST(sum(TotalAmount) AS DOUBLE) AS revenue,
       count(InvoiceNo) AS transactions, count(CustomerID) AS unique_customers
FROM retail GROUP BY 1, 2""")

_step("spend", ("retail",), """
SELECT InvoiceDate AS date, channel, CAST(sum(spend) AS DOUBLE) AS spend
FROM retail GROUP BY 1, 2""")


def _pivot(keys: str) -> str:
    sums = ", ".join(
        f"CAST(sum(CASE WHEN channel = '{c}' THEN spend END) AS DOUBLE) AS {c}" for c in CHANNELS
    )
    return f"SELECT {keys}, {sums} FROM retail GROUP BY ALL"


_step("wide", ("retail",), _pivot("InvoiceDate AS date"))
_step("country_wide", ("retail",), _pivot("Country, InvoiceDate AS date"))

_step("external", ("days",), f"""
SELECT date, 1.0e2 + 5.0e0 * {wave_sql('dayofyear(date)', 365)} + 0.0e0 AS consumer_confidence,
       (ARRAY[{_GROWTH}])[CAST(floor(month(date) / 3.0e0) AS BIGINT) % {len(QUARTERLY_GROWTH)} + 1] + 0.0e0 AS gdp_growth,
       5.0e0 + 3.0e-1 * {wave_sql('dayofyear(date)', 365)} + 0.0e0 AS unemployment,
       {dates_sql(UK_HOLIDAYS)} AS is_holiday, {dates_sql(PROMO_DAYS)} AS is_promo_event
FROM days""")

_step("joined", ("sales", "wide", "external"), "SELECT date, " + ", ".join(
    f"coalesce({c}, 0) AS {c}" for c in (*_SALES_COLUMNS, *CHANNELS, *_EXTERNAL)
) + " FROM sales JOIN wide USING (date) LEFT JOIN external USING (date)")

_step("carried", ("joined",), "SELECT *, " + ", ".join(
    f"{adstock_sql(c, channel_weights(PARAMS[c]), 'w')} AS {c}_carried" for c in CHANNELS
) + " FROM joined WINDOW w AS (ORDER BY date)")

_step("panel", ("carried",), "SELECT date, " + ", ".join(
    [*_SALES_COLUMNS, *CHANNELS, *_EXTERNAL]
    + [f"{hill_sql(f'{c}_carried', PARAMS[c]['k'], PARAMS[c]['S'])} AS {c}_adstock" for c in CHANNELS]
) + f", {calendar_sql(math.pi, False)} FROM carried")

_step("scored", ("panel",), "SELECT *, " + total(
    [number(INTERCEPT), *[f"{number(b)} * {f}" for f, b in COEFS.items()]]
) + " AS predicted_revenue FROM panel")

_effect = {c: f"{number(COEFS[f'{c}_adstock'])} * {c}_adstock" for c in CHANNELS}
_step("effects", ("scored",), "SELECT date, revenue AS actual_revenue, predicted_revenue, " + ", ".join(
    [f"{e} AS {c}_contribution" for c, e in _effect.items()]
    + [f"({e}) / nullif({c}, 0) AS {c}_roi" for c, e in _effect.items()]
) + ", predicted_revenue - (" + total(["0.0e0", *[f"({e})" for e in _effect.values()]]) +
    ") AS baseline_contribution FROM scored")

_PARTS = (*CHANNELS, "baseline")
_step("contributions", ("effects",), "SELECT *, " + ", ".join(
    f"{p}_contribution / nullif(predicted_revenue, 0) * 100 AS {p}_contribution_pct" for p in _PARTS
) + " FROM effects")

_step("long", ("contributions",), " UNION ALL ".join(
    f"SELECT date, '{p}' AS channel, {p}_contribution AS contribution FROM contributions" for p in _PARTS
))

_step("shares", ("contributions",), " UNION ALL ".join(
    f"SELECT '{p}' AS channel, avg({p}_contribution) AS mean_contribution, "
    f"avg({p}_contribution) / avg(predicted_revenue) * 100 AS share FROM contributions" for p in _PARTS
))

_step("roi", ("contributions",), " UNION ALL ".join(
    f"SELECT '{c}' AS channel, median({c}_roi) AS roi FROM contributions" for c in CHANNELS
))

_LOW, _HIGH = number(TOTAL * MIN_PCT), number(TOTAL * MAX_PCT)
_step("ranked", ("roi",), f"""
SELECT channel, roi, row_number() OVER (ORDER BY roi DESC NULLS LAST, channel) AS i,
       count(*) OVER () AS n,
       coalesce(sum(CASE WHEN roi > 0 THEN roi END) OVER (), 0) AS pool,
       {number(TOTAL)} - {_LOW} * count(*) OVER () AS rest0
FROM roi""")

_TAKES = "r.rest0 > 0 AND r.roi > 0"
_STEP_SUM = f"({_LOW} + f.rest * (r.roi / r.pool))"
_step("fold", ("ranked",), f"""
SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS VARCHAR) AS channel, CAST(NULL AS DOUBLE) AS budget,
       CAST(min(rest0) AS DOUBLE) AS rest FROM ranked
UNION ALL
SELECT r.i, r.channel,
       CASE WHEN NOT ({_TAKES}) THEN {_LOW} WHEN {_STEP_SUM} > {_HIGH} THEN {_HIGH} ELSE {_STEP_SUM} END,
       CASE WHEN NOT ({_TAKES}) THEN f.rest WHEN {_STEP_SUM} > {_HIGH} THEN {_STEP_SUM} - {_HIGH}
            ELSE f.rest - f.rest * (r.roi / r.pool) END
FROM fold f JOIN ranked r ON r.i = f.i + 1""")

_step("allocation", ("fold", "ranked"), f"""
SELECT channel, budget, budget / {number(TOTAL)} * 100 AS budget_pct, roi FROM (
  SELECT r.channel, r.roi,
         CASE WHEN l.rest > 0 AND f.budget < {_HIGH}
              THEN f.budget + least(l.rest / r.n, {_HIGH} - f.budget) ELSE f.budget END AS budget
  FROM fold f JOIN ranked r ON r.i = f.i
  CROSS JOIN (SELECT rest FROM fold ORDER BY i DESC LIMIT 1) l)""")

_step("scenarios", ("spend",), f"""
SELECT CAST(date AS VARCHAR) AS scenario, channel, spend AS allocation_pct,
       {number(TOTAL)} AS total_budget FROM spend""")

_step("simulated", ("scenarios", "roi"), """
SELECT scenario, channel, pct / 100 * total_budget AS budget, pct AS budget_pct,
       coalesce(roi, 0) AS roi, pct / 100 * total_budget * coalesce(roi, 0) AS contribution
FROM (SELECT *, CASE WHEN sum(allocation_pct) OVER (PARTITION BY scenario) > 0
                THEN allocation_pct * (1.0e2 / sum(allocation_pct) OVER (PARTITION BY scenario))
                ELSE allocation_pct END AS pct FROM scenarios)
LEFT JOIN roi USING (channel)""")

_step("scenario_rows", ("simulated", "contributions"), """
SELECT * FROM simulated UNION ALL
SELECT scenario, 'Baseline', 0.0e0, 0.0e0, 0.0e0, (SELECT avg(baseline_contribution) FROM contributions)
FROM (SELECT DISTINCT scenario FROM simulated)""")

_step("simulated_spend", ("days",), f"""
SELECT date, channel, i,
  1.0e3 * (i + 1) * (3.0e-1 * {wave_sql('(month(date) - i)', 12)} + 1)
  * (2.0e-1 * {wave_sql('((dayofweek(date) + 6) % 7)', 7)} + 1)
  * (1.0e0 + 1.0e-3 * (i % 3) * (row_number() OVER (PARTITION BY channel ORDER BY date) - 1)) AS clean
FROM days CROSS JOIN (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(MEDIA))}) AS t(i, channel)""")



def least_squares(name: str, source: str, features, target: str = "revenue", by=()) -> dict[str, str]:
    """Steps by elimination on scaled covariances; the last one, ``name``, has (by, n, b0, b1, ..., spread)."""
    size, tol = len(features), number(1e-9)
    x = [*features, target]
    keys = ", ".join(by)
    lead = f"{keys}, " if by else ""
    means = [f"avg({c}) AS m{i}" for i, c in enumerate(x)]
    products = [f"covar_pop({x[i]}, {x[j]}) AS c{i}_{j}" for i in range(size + 1) for j in range(i, size + 1)]
    present = " AND ".join(f"{c} IS NOT NULL" for c in x)
    steps = {
        f"{name}_m": f"SELECT {lead}count(*) AS n, {', '.join(means + products)} FROM {source} WHERE {present}"
        + (f" GROUP BY {keys}" if by else "")
    }
    scale = [f"nullif(sqrt(c{i}_{i}), 0)" for i in range(size)]
    unit = [f"coalesce(c{i}_{j} / {scale[i]} / {scale[j]}, 0) AS a{i}_{j}" for i in range(size) for j in range(i, size)]
    unit += [f"coalesce(c{i}_{size} / {scale[i]}, 0) AS r{i}" for i in range(size)]
    steps[f"{name}_0"] = f"SELECT *, {', '.join(unit)} FROM {name}_m"
    for c in range(size - 1):
        swept = [f"CASE WHEN a{c}_{c} > {tol} THEN a{i}_{j} - a{c}_{i} * a{c}_{j} / a{c}_{c} ELSE a{i}_{j} END AS a{i}_{j}" for i in range(c + 1, size) for j in range(i, size)]
        swept += [f"CASE WHEN a{c}_{c} > {tol} THEN r{i} - a{c}_{i} * r{c} / a{c}_{c} ELSE r{i} END AS r{i}" for i in range(c + 1, size)]
        steps[f"{name}_{c + 1}"] = f"SELECT * REPLACE ({', '.join(swept)}) FROM {name}_{c}"
    last = f"{name}_{size - 1}"
    for i in reversed(range(size)):
        rest = "".join(f" - a{i}_{j} * v{j}" for j in range(i + 1, size))
        steps[f"{name}_v{i}"] = f"SELECT *, CASE WHEN a{i}_{i} > {tol} THEN (r{i}{rest}) / a{i}_{i} ELSE 0.0e0 END AS v{i} FROM {last}"
        last = f"{name}_v{i}"
    steps[f"{name}_b"] = "SELECT *, " + ", ".join(f"coalesce(v{i} / {scale[i]}, 0.0e0) AS b{i + 1}" for i in range(size)) + f" FROM {last}"
    offset = "".join(f" - b{i + 1} * m{i}" for i in range(size))
    steps[name] = f"SELECT {lead}n, m{size}{offset} AS b0, {', '.join(f'b{i + 1}' for i in range(size))}, c{size}_{size} * n AS spread FROM {name}_b"
    return steps


def fitted_value(features) -> str:
    return "b0" + "".join(f" + b{i + 1} * {c}" for i, c in enumerate(features))


HOLIDAY_FLAGS = [
    (name, f"month(date) = {m} AND day(date) = {d}") for m, d, name in FIXED_HOLIDAYS["FR"]
]
SHORT_CALENDAR = calendar_sql(SHORT_PI, True)
FULL_CALENDAR = calendar_sql(math.pi, False)


def build(sql: str, *names: str, **own: str) -> str:
    """``sql`` preceded by the named steps, all they rest on, and its own steps."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for dep in STEPS[name][0]:
                visit(dep)
            order.append(name)

    for name in names:
        visit(name)
    steps = [f"{n} AS ({STEPS[n][1]})" for n in order] + [f"{n} AS ({body})" for n, body in own.items()]
    return "WITH RECURSIVE " + ",\n".join(steps) + f"\n{sql}" if steps else sql


def rounds(columns, places: int) -> str:
    return ", ".join(f"round({c}, {places}) AS {c}" for c in columns)
