"""Oracle SQL (DuckDB dialect) built from named common table expressions.

Each query's SQL is ``WITH <the CTEs it needs, in dependency order> SELECT ...``.
Literals with a fraction are written as DOUBLE casts: DuckDB reads ``3.5``
as DECIMAL, which would change the arithmetic.
"""

from __future__ import annotations

from tidemark.plans.feeds import BASE_YEAR, K, SINCE, URGENT, YOY_DAYS
from tidemark.operators.indices import (LOG_SCALE, SEASONAL_GROWTH, SEASONAL_MODEL,
                                        SEASONAL_WEEKS)


def D(x: float) -> str:
    """A DOUBLE literal."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def week_end(d: str) -> str:
    """SQL: the Saturday on or after a date."""
    return f"({d} + CAST((13 - isodow({d})) % 7 AS INTEGER))"


def last_sat(d: str) -> str:
    """SQL: the Saturday on or before a date."""
    return f"({d} - CAST((isodow({d}) + 1) % 7 AS INTEGER))"


def isoweek(d: str) -> str:
    """SQL: ISO week number as INTEGER."""
    return f"CAST(week({d}) AS INTEGER)"


def cap(x: str, limit: float = 100.0) -> str:
    """SQL: cap at ``limit``, NULL stays NULL."""
    return f"(CASE WHEN {x} > {D(limit)} THEN {D(limit)} ELSE {x} END)"


def ratio(num: str, den: str) -> str:
    """SQL of ``functions.ratio``: IEEE rules for a zero base, 0 over 0 is NULL."""
    return (f"(CASE WHEN {den} <> 0 THEN ({num}) / CAST({den} AS DOUBLE) WHEN {den} = 0 AND ({num}) > 0 THEN CAST('Infinity' AS DOUBLE) "
            f"WHEN {den} = 0 AND ({num}) < 0 THEN CAST('-Infinity' AS DOUBLE) END)")


def rollmean(x: str, order: str, partition: str = "", k: int = K, align: str = "right") -> str:
    """SQL: the k-row mean as an explicit sum of lagged values (same order as Spark)."""
    over = f"OVER ({'PARTITION BY ' + partition + ' ' if partition else ''}ORDER BY {order})"
    if align == "right":
        terms = [f"lag({x}, {i}) {over}" for i in range(k - 1, 0, -1)] + [x]
    else:
        terms = [x] + [f"lead({x}, {i}) {over}" for i in range(1, k)]
    return f"(CAST(({' + '.join(terms)}) AS DOUBLE) / {D(k)})"


def rhe(num: str, den: str, scale: int = 2, mult: int = 1) -> str:
    """Exact half-even rounding of num*mult/den (integral), as DOUBLE."""
    p = 10 ** scale
    a = f"(abs(CAST({num} AS HUGEINT)) * {mult * p})"
    b = f"abs(CAST({den} AS HUGEINT))"
    r = f"({a} % {b})"
    q = f"(({a} - {r}) // {b})"
    q2 = f"(CASE WHEN {r} * 2 > {b} THEN {q} + 1 WHEN {r} * 2 = {b} THEN {q} + {q} % 2 ELSE {q} END)"
    signed = f"(CASE WHEN (({num}) < 0) <> (({den}) < 0) AND ({num}) <> 0 THEN -{q2} ELSE {q2} END)"
    return f"(CASE WHEN ({den}) <> 0 THEN CAST({signed} AS DOUBLE) / {D(p)} END)"


def pct_chg(new: str, old: str) -> str:
    """SQL: exact half-even percent change."""
    return rhe(f"({new}) - ({old})", old, 2, 100)


def baseline_ctes(prefix: str, src: str, value: str = "n", keys: str = "",
                  week53: bool = True) -> dict[str, str]:
    """CTEs ``{prefix}_by``, ``{prefix}_b0``, ``{prefix}`` (keys, iso_week, base):
    circular centred 3-week mean of BASE_YEAR, week 53 = mean(last, 1)."""
    k = f"{keys}, " if keys else ""
    nw = f"CAST(week(make_date({BASE_YEAR}, 12, 28)) AS INTEGER)"
    out = {
        f"{prefix}_by": f"SELECT {k}{isoweek('week_end')} AS w, {value} AS v, {nw} AS nw "
                        f"FROM {src} WHERE isoyear(week_end) = {BASE_YEAR}",
        f"{prefix}_sp": f"SELECT {k}((w - 2 + nw) % nw) + 1 AS iso_week, v, nw FROM {prefix}_by "
                        f"UNION ALL SELECT {k}w, v, nw FROM {prefix}_by "
                        f"UNION ALL SELECT {k}(w % nw) + 1, v, nw FROM {prefix}_by",
        f"{prefix}_b0": f"SELECT {k}iso_week, CASE WHEN count(v) = 3 THEN CAST(sum(v) AS DOUBLE) / {D(3)} END AS base, max(nw) AS nw "
                        f"FROM {prefix}_sp GROUP BY {k}iso_week",
    }
    if week53:
        grp = f" GROUP BY {keys}" if keys else ""
        out[prefix] = (f"SELECT {k}iso_week, base FROM {prefix}_b0 UNION ALL "
                       f"SELECT {k}53, sum(base) / {D(2)} FROM {prefix}_b0 "
                       f"WHERE (iso_week = nw OR iso_week = 1) AND nw = 52{grp} HAVING count(*) = 2")
    else:
        out[prefix] = f"SELECT {k}iso_week, base FROM {prefix}_b0"
    return out


MODEL_CASE = "(CASE " + " ".join(
    f"WHEN m = {m} THEN {D(v)}" for m, v in SEASONAL_MODEL.items()) + " END)"

CTES: dict[str, str] = {
    "od": (f"SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n, "
           f"CAST(count_if(o_orderpriority = '{URGENT}') AS BIGINT) AS n_urgent, "
           f"CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue "
           f"FROM orders GROUP BY 1"),
    "ld": ("SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n_lines, "
           "CAST(count_if(l_returnflag = 'R') AS BIGINT) AS n_returned, "
           "CAST(coalesce(round(sum(CAST(l_quantity AS DECIMAL(18,2)))), 0) AS BIGINT) AS qty FROM lineitem GROUP BY 1"),
    "aw": f"SELECT {last_sat('max(d)')} AS asof FROM od",
    "wk": f"SELECT {week_end('d')} AS week_end, CAST(sum(n) AS BIGINT) AS n FROM od GROUP BY 1",
    "wr": f"SELECT {week_end('d')} AS week_end, CAST(sum(n_returned) AS BIGINT) AS n FROM ld GROUP BY 1",
    "wq": f"SELECT {week_end('d')} AS week_end, CAST(sum(qty) AS BIGINT) AS qty FROM ld GROUP BY 1",
    **baseline_ctes("bw", "wk"),
    **baseline_ctes("br", "wr"),
    # D6 home sales
    "home": (f"SELECT wk.week_end, b.iso_week, wk.n, b.base, {ratio('wk.n', 'b.base')} * {D(100)} AS index_original, "
             f"{cap(ratio('wk.n', 'b.base') + ' * ' + D(100))} AS index "
             f"FROM wk JOIN bw b ON b.iso_week = {isoweek('wk.week_end')}, aw "
             f"WHERE wk.week_end BETWEEN DATE '{SINCE}' AND aw.asof"),
    # D3 claims
    "claims_p": (f"SELECT wr.week_end, {isoweek('wr.week_end')} AS iso_week, wr.n, b.base, "
                 f"{ratio('wr.n - b.base', 'b.base')} AS pct_change "
                 f"FROM wr LEFT JOIN br b ON b.iso_week = {isoweek('wr.week_end')} "
                 f"WHERE wr.week_end >= DATE '{SINCE}'"),
    "claims": (f"SELECT week_end, iso_week, n, base, pct_change, io * {D(100)} AS index_original, {cap(f'io * {D(100)}')} AS index "
               f"FROM (SELECT *, {ratio(D(100), f'({D(100)} * pct_change + {D(100)})')} AS io FROM claims_p)"),
    # D4 rentals
    "jan": (f"SELECT CAST(sum(qty) AS DOUBLE) / count(*) AS scale FROM wq "
            f"WHERE year(week_end) = {BASE_YEAR} AND month(week_end) = 1"),
    "rent_a": (f"SELECT {isoweek('wq.week_end')} AS iso_week, wq.week_end, month(wq.week_end) AS m, wq.qty, "
               f"(wq.qty - wq.qty * ({D(SEASONAL_GROWTH)} - {D(1)}) * {isoweek('wq.week_end')} / {D(SEASONAL_WEEKS)})"
               f" / NULLIF(jan.scale, 0) AS adjusted "
               f"FROM wq, jan, aw WHERE wq.week_end BETWEEN DATE '{SINCE}' AND aw.asof"),
    "rent_b": (f"SELECT iso_week, week_end, {MODEL_CASE} AS model, qty, adjusted, "
               f"abs(adjusted / NULLIF({MODEL_CASE}, 0) - {D(1)}) AS difference FROM rent_a"),
    "rentals": (f"SELECT iso_week, week_end, model, qty, adjusted, difference, "
                f"{D(100)} / (difference + {D(1)}) AS index_original, "
                f"{cap(f'{D(100)} / (difference + {D(1)})')} AS index FROM rent_b"),
    # D5 hospitalisations
    "hosp_f": ("SELECT s.d, COALESCE(od.n_urgent, 0) AS n FROM "
               "(SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM od) s "
               "LEFT JOIN od ON od.d = s.d"),
    "hosp_m": f"SELECT d, n, {rollmean('n', 'd')} AS rolling_seven FROM hosp_f",
    "hosp_i": (f"SELECT d, n, rolling_seven, log10(rolling_seven + {D(1)}) AS log_hosp, "
               f"({D(1)} - log10(rolling_seven + {D(1)}) / {D(LOG_SCALE)}) * {D(100)} AS index_original FROM hosp_m"),
    "hospital": (f"SELECT d, n, rolling_seven, log_hosp, index_original, {cap('index_original')} AS index "
                 f"FROM hosp_i, aw WHERE {cap('index_original')} IS NOT NULL AND d <= aw.asof"),
    # D2 subway
    "sub_base": (f"SELECT CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, "
                 f"CAST(CAST(sum(revenue) AS DECIMAL(18,2)) AS DOUBLE) / count(*) AS base_revenue "
                 f"FROM od WHERE year(d) = {BASE_YEAR} GROUP BY 1"),
    "sub_c": (f"SELECT b.day_of_week, od.d, CAST(od.revenue AS DOUBLE) AS revenue, "
              f"{ratio('CAST(od.revenue AS DOUBLE)', 'b.base_revenue')} - {D(1)} AS comparable "
              f"FROM od JOIN sub_base b ON b.day_of_week = CAST(dayofweek(od.d) + 1 AS INTEGER)"),
    "sub_m": (f"SELECT day_of_week, d, comparable, {rollmean('comparable', 'd')} AS avg7, "
              f"{rollmean('revenue', 'd')} AS avg_revenue FROM sub_c"),
    "subway": (f"SELECT day_of_week, d, comparable, avg7, ({D(1)} + avg7) * {D(100)} AS index_original, "
               f"{cap(f'({D(1)} + avg7) * {D(100)}')} AS index, avg_revenue FROM sub_m, aw WHERE d <= aw.asof"),
    # D1 restaurants
    "yoy": (f"SELECT a.d, a.n, b.n AS n_old, {ratio('a.n - b.n', 'b.n')} * {D(100)} AS yoy "
            f"FROM od a JOIN od b ON a.d = b.d + {YOY_DAYS}"),
    "rest_m": f"SELECT d, yoy, {rollmean('yoy', 'd')} AS avg7 FROM yoy",
    "restaurants": (f"SELECT CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, d, yoy, avg7, "
                    f"avg7 + {D(100)} AS index_original, {cap(f'avg7 + {D(100)}')} AS index "
                    f"FROM rest_m, aw WHERE d <= aw.asof"),
    # J4 six-way join
    "six": ("SELECT h.d AS date, h.index AS hosp_index, c.index AS claims_index, "
            "hs.index AS home_sales_index, r.index AS rental_index, s.index AS subway_index, "
            "rr.index AS restaurant_index "
            "FROM hospital h JOIN claims c ON c.week_end = h.d JOIN home hs ON hs.week_end = h.d "
            "JOIN rentals r ON r.week_end = h.d JOIN subway s ON s.d = h.d JOIN restaurants rr ON rr.d = h.d"),
}

def _deps(name: str) -> list[str]:
    import re
    body = CTES[name]
    found = []
    for other in CTES:
        if other != name and re.search(rf"(?<![\w.]){re.escape(other)}(?![\w(])", body):
            found.append(other)
    return found


def with_ctes(select: str, *roots: str) -> str:
    """``WITH`` the named CTEs (and everything they use) ``select``."""
    import re
    if not roots:
        roots = tuple(n for n in CTES if re.search(rf"(?<![\w.]){re.escape(n)}(?![\w(])", select))
    order: list[str] = []
    seen: set[str] = set()

    def visit(n: str):
        if n in seen:
            return
        seen.add(n)
        for d in _deps(n):
            visit(d)
        order.append(n)

    for r in roots:
        visit(r)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + select


SEGMENTS_SQL = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
CTES.update({
    "sd": ("SELECT c.c_mktsegment AS area, CAST(o.o_orderdate AS DATE) AS d, count(*) AS n "
           "FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2"),
    "sw": f"SELECT area, {week_end('d')} AS week_end, CAST(sum(n) AS BIGINT) AS n FROM sd GROUP BY 1, 2",
    "swa": "SELECT * FROM sw UNION ALL SELECT 'ALL', week_end, CAST(sum(n) AS BIGINT) FROM sw GROUP BY 2",
})
