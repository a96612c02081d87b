"""SQL that computes the same results as the bound queries, for a second engine to check them."""

from __future__ import annotations

from ..functions.items import CATEGORIES
from .bindings import WEAPONS

ORACLE: dict[str, str] = {}


def r6(**columns: str) -> str:
    """Doubles rounded to six places."""
    return ", ".join(f"round({sql}, 6) + 0.0 AS {name}" for name, sql in columns.items())


# --- tails -----------------------------------------------------------------------------------------


def erfc(x: str) -> str:
    """Complementary error function of a value by the series of erf."""
    series = (
        f"list_sum(list_transform(range(0, 400), lambda n: "
        f"exp(-({x})*({x}) + (2*n+1)*ln(abs({x})) - lgamma(n+1.5))))"
    )
    erf = f"(CASE WHEN ({x}) = 0 THEN 0.0 WHEN abs({x}) > 7 THEN 1.0 ELSE {series} END) * sign({x})"
    return f"(1.0 - {erf})"


def p_chi2(x: str) -> str:
    return f"greatest(0.0, {erfc(f'sqrt(({x})/2.0)')})"


def p_upper(z: str) -> str:
    return f"greatest(0.0, 0.5*{erfc(f'(({z})/sqrt(2.0))')})"


def _log_choose(n: str, k: str) -> str:
    return f"(lgamma(({n})+1.0) - lgamma(({k})+1.0) - lgamma(({n})-({k})+1.0))"


def p_fisher(a: str = "a", b: str = "b", c: str = "c", d: str = "d", greater: bool = False) -> str:
    """Sum of hypergeometric point probabilities over the support."""
    r, o, col = f"({a}+{b})", f"({c}+{d})", f"({a}+{c})"

    def log_p(k: str) -> str:
        return f"({_log_choose(r, k)} + {_log_choose(o, f'{col}-({k})')} - {_log_choose(f'{r}+{o}', col)})"

    support = f"range(CAST(greatest(0, {col}-{o}) AS BIGINT), CAST(least({r}, {col}) AS BIGINT) + 1)"
    keep = f"k >= {a}" if greater else f"{log_p('k')} <= {log_p(a)} + 1e-7"
    return f"least(1.0, list_sum(list_transform({support}, lambda k: CASE WHEN {keep} THEN exp({log_p('k')}) ELSE 0.0 END)))"


def p_binomial(k: str, n: str) -> str:
    def log_p(x: str) -> str:
        return f"({_log_choose(n, x)} - ({n})*ln(2.0))"

    return (
        f"least(1.0, list_sum(list_transform(range(0, CAST({n} AS BIGINT) + 1), lambda j: "
        f"CASE WHEN {log_p('j')} <= {log_p(k)} + 1e-7 THEN exp({log_p('j')}) ELSE 0.0 END)))"
    )


def wilson(k: str, n: str, rate: str = "rate", lo: str = "ci_lo", hi: str = "ci_hi") -> dict[str, str]:
    p = f"(({k})/CAST({n} AS DOUBLE))"
    denom = f"(1+1.96*1.96/({n}))"
    center = f"(({p}+1.96*1.96/(2.0*({n})))/{denom})"
    half = f"(1.96*sqrt({p}*(1-{p})/({n})+1.96*1.96/(4.0*({n})*({n})))/{denom})"
    return {rate: p, lo: f"{center}-{half}", hi: f"{center}+{half}"}


def chi2(a: str = "a", b: str = "b", c: str = "c", d: str = "d") -> str:
    n = f"CAST({a}+{b}+{c}+{d} AS DOUBLE)"
    terms = []
    for cell, row, col in ((a, f"({a}+{b})", f"({a}+{c})"), (b, f"({a}+{b})", f"({b}+{d})"), (c, f"({c}+{d})", f"({a}+{c})"), (d, f"({c}+{d})", f"({b}+{d})")):
        e = f"({row}*{col}/{n})"
        gap = f"abs({cell}-{e})"
        terms.append(f"pow({gap}-least(0.5,{gap}),2)/{e}")
    return "(" + " + ".join(terms) + ")"


def odds(haldane: bool = True) -> dict[str, str]:
    if haldane:
        h = "(CASE WHEN least(a,b,c,d)=0 THEN 0.5 ELSE 0.0 END)"
        a, b, c, d = (f"({x}+{h})" for x in "abcd")
        ratio = f"({a}*{d}/({b}*{c}))"
        se = f"sqrt(1.0/{a}+1.0/{b}+1.0/{c}+1.0/{d})"
    else:
        ratio = "(CAST(a AS DOUBLE)*d/greatest(1,b*c))"
        se = "sqrt(1.0/greatest(1,a)+1.0/greatest(1,b)+1.0/greatest(1,c)+1.0/greatest(1,d))"
    return {
        "odds_ratio": ratio,
        "or_lo": f"exp(ln({ratio})-1.96*{se})",
        "or_hi": f"exp(ln({ratio})+1.96*{se})",
    }


def tests(haldane: bool = True, fisher: bool = True, one_sided: bool = False) -> str:
    """Columns of the tests on cells a, b, c, d."""
    doubles = odds(haldane) | {"chi2": chi2(), "p_chi2": p_chi2(chi2())}
    if fisher:
        doubles["p_fisher"] = p_fisher()
    if one_sided:
        doubles["p_greater"] = p_fisher("d", "c", "b", "a", greater=True)
    return "a, b, c, d, a+b+c+d AS n, " + r6(**doubles)


STARS = "CASE WHEN {p}<1e-3 THEN '***' WHEN {p}<1e-2 THEN '**' WHEN {p}<0.05 THEN '*' ELSE '' END"

# --- roles of the tables -----------------------------------------------------------------------------

DAYS = "date_diff('day', TIMESTAMP '1992-01-01', {})"

ROLES = f"""
rounds AS (
  SELECT o_orderkey AS round, o_custkey AS match_id,
         CASE o_orderstatus WHEN 'F' THEN 'ct' WHEN 'O' THEN 't' END AS winner,
         {DAYS.format('o_orderdate')} AS start
  FROM orders
),
header AS (
  SELECT c_custkey AS match_id, c_mktsegment AS map_name,
         CASE c_nationkey % 3 WHEN 0 THEN 64.0 WHEN 1 THEN 128.0 END::DOUBLE AS tickrate
  FROM customer
),
kills AS (
  SELECT l_orderkey AS round, {DAYS.format('l_shipdate')} AS tick,
         CASE l_linestatus WHEN 'F' THEN 'ct' WHEN 'O' THEN 't' END AS "killerSide"
  FROM lineitem
),
first_kill AS (
  SELECT k.round, k.tick, k."killerSide" AS opening_side
  FROM kills k JOIN (SELECT round, min(tick) AS tick FROM kills GROUP BY round) f
    ON k.round = f.round AND k.tick = f.tick
),
opening AS (
  SELECT r.round, r.match_id, r.winner, f.opening_side FROM rounds r JOIN first_kill f ON r.round = f.round
),
players AS (
  SELECT l_orderkey AS round, CASE l_linestatus WHEN 'F' THEN 'CT' WHEN 'O' THEN 'T' END AS team,
         CAST(l_quantity > 25 AS INT) AS has_helmet, lower(p_name) AS item1, lower(p_type) AS item2
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
teams AS (
  SELECT round, team,
         max(CAST(contains(item1,'widget') OR contains(item2,'widget') AS BIGINT)) AS awp,
         CAST(sum(CAST(contains(item1,'ring') AS INT) + CAST(contains(item2,'ring') AS INT)) AS BIGINT) AS rifles,
         CAST(sum(CAST(contains(item1,'bolt') AS INT) + CAST(contains(item2,'bolt') AS INT)) AS BIGINT) AS smgs,
         CAST(sum(has_helmet) AS DOUBLE) AS helmets, count(*) AS players
  FROM players WHERE team IN ('CT','T') GROUP BY round, team
),
scored AS (
  SELECT *, 6.0*awp + 3.0*rifles + 1.5*smgs + 0.75*helmets AS score FROM teams
)
"""


def roles(body: str, *more: str) -> str:
    return "WITH " + ",\n".join([ROLES, *more]) + "\n" + body


CELLS = """
  count(*) FILTER (WHERE winner='ct' AND opening_side='ct') AS a,
  count(*) FILTER (WHERE winner='ct' AND opening_side='t') AS b,
  count(*) FILTER (WHERE winner='t' AND opening_side='ct') AS c,
  count(*) FILTER (WHERE winner='t' AND opening_side='t') AS d
"""

# --- openings ------------------------------------------------------------------------------------------

ORACLE["opening_win"] = roles(
    f"SELECT {tests()}, a+d AS opening_wins, {r6(share='(a+d)/CAST(a+b+c+d AS DOUBLE)')}, "
    f"{p_chi2(chi2())} < 0.05 AS rejected FROM cells",
    f"cells AS (SELECT {CELLS} FROM opening)",
)

ORACLE["opening_win_by_map"] = roles(
    f"""
SELECT map_name, a, b, c, d, n, {r6(odds_ratio='odds_ratio', or_lo='or_lo', or_hi='or_hi', chi2='x', p_chi2='p')},
       a+d AS opening_wins, {r6(share='(a+d)/CAST(n AS DOUBLE)', p_holm='p_holm')},
       {STARS.format(p='p_holm')} AS sig,
       {r6(err_lo='odds_ratio-or_lo', err_hi='or_hi-odds_ratio')},
       printf('%.2f [%.2f–%.2f]', odds_ratio, or_lo, or_hi) AS or_text
FROM (SELECT *, max(least(1.0, p*(m-rank+1))) OVER (ORDER BY rank) AS p_holm FROM ranked)
""",
    f"cells AS (SELECT map_name, {CELLS} FROM opening JOIN header USING (match_id) GROUP BY map_name)",
    f"""tested AS (
      SELECT *, a+b+c+d AS n, {', '.join(f'{sql} AS {k}' for k, sql in odds().items())},
             {chi2('greatest(a,0.5)', 'greatest(b,0.5)', 'greatest(c,0.5)', 'greatest(d,0.5)')} AS x FROM cells)""",
    f"withp AS (SELECT *, {p_chi2('x')} AS p FROM tested)",
    "ranked AS (SELECT *, row_number() OVER (ORDER BY p) AS rank, count(*) OVER () AS m FROM withp)",
)

ORACLE["first_kills"] = roles('SELECT round, tick, opening_side AS "killerSide" FROM first_kill')
ORACLE["opening_margins"] = roles(
    "SELECT winner, opening_side, count(*) AS n FROM opening "
    "WHERE winner IS NOT NULL AND opening_side IS NOT NULL GROUP BY CUBE (winner, opening_side)"
)
ORACLE["opening_row_pct"] = roles(
    "SELECT winner, opening_side, n, round(100.0*n/sum(n) OVER (PARTITION BY winner), 2)::DOUBLE AS pct FROM "
    "(SELECT winner, opening_side, count(*) AS n FROM opening WHERE winner IS NOT NULL GROUP BY ALL)"
)
ORACLE["opening_outcomes"] = roles(
    "SELECT outcome, count(winner) AS n FROM (VALUES ('won'), ('lost'), ('drawn')) v(outcome) LEFT JOIN "
    "(SELECT * FROM opening WHERE winner IS NOT NULL) ON outcome = CASE WHEN winner = opening_side THEN 'won' ELSE 'lost' END "
    "GROUP BY outcome"
)

# --- flags and rates -----------------------------------------------------------------------------------

ORACLE["flag_test"] = f"""
WITH joined AS (
  SELECT l_returnflag = 'R' AS y, p_size > 25 AS x FROM lineitem JOIN part ON l_partkey = p_partkey
), cells AS (
  SELECT count(*) FILTER (WHERE NOT x AND NOT y) AS a, count(*) FILTER (WHERE NOT x AND y) AS b,
         count(*) FILTER (WHERE x AND NOT y) AS c, count(*) FILTER (WHERE x AND y) AS d FROM joined
)
SELECT {tests(haldane=False)}, a+b AS n0, c+d AS n1,
       {r6(**wilson('b', '(a+b)', 'rate_0', 'ci_lo_0', 'ci_hi_0'), **wilson('d', '(c+d)', 'rate_1', 'ci_lo_1', 'ci_hi_1'))},
       {p_chi2(chi2())} < 0.05 AS reject_chi2, {p_fisher()} < 0.05 AS reject_fisher
FROM cells
"""

ORACLE["label_cells"] = f"""
WITH cells AS (
  SELECT count(*) FILTER (WHERE quality=1 AND toxic=1) AS a, count(*) FILTER (WHERE quality=1 AND toxic<>1) AS b,
         count(*) FILTER (WHERE quality<>1 AND toxic=1) AS c, count(*) FILTER (WHERE quality<>1 AND toxic<>1) AS d
  FROM labels
)
SELECT {tests(one_sided=True)} FROM cells
"""


def _side_rate(by: str, source: str) -> str:
    names = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return roles(
        f"SELECT {names}n, t_wins, {r6(**wilson('t_wins', 'n'), diff_pp='(t_wins/CAST(n AS DOUBLE)-0.5)*100', p_binom='p')}, "
        f"n-t_wins AS ct_wins, {STARS.format(p='p')} AS sig, p < 0.05 AS rejected "
        f"FROM (SELECT *, {p_binomial('t_wins', 'n')} AS p FROM counted)",
        f"counted AS (SELECT {names}count(*) AS n, count(*) FILTER (WHERE winner='t') AS t_wins FROM {source} "
        f"WHERE winner IN ('ct','t') {group})",
    )


ORACLE["side_rate"] = _side_rate("", "rounds")
ORACLE["side_rate_by_map"] = _side_rate("map_name", "rounds JOIN header USING (match_id)")

# --- durations -------------------------------------------------------------------------------------------

DURATIONS = """
ends AS (SELECT round, max(tick) AS last FROM kills GROUP BY round),
durations AS (
  SELECT r.round, h.map_name, (e.last - r.start)/h.tickrate AS dur_s,
         r.round IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag='R') AS planted
  FROM rounds r JOIN ends e USING (round) LEFT JOIN header h USING (match_id)
  WHERE h.tickrate IS NOT NULL
)
"""


def _ranked(by: str) -> str:
    part = f"PARTITION BY {by} " if by else ""
    names = f"{by}, " if by else ""
    return f"""
ranked AS (
  SELECT *, rank() OVER ({part}ORDER BY dur_s) + (count(*) OVER ({part + ',' if by else 'PARTITION BY '} dur_s) - 1)/2.0 AS rk,
         count(*) OVER ({part + ',' if by else 'PARTITION BY '} dur_s) AS t FROM durations
),
u AS (
  SELECT {names}count(*) FILTER (WHERE planted) AS n1, count(*) FILTER (WHERE NOT planted) AS n0,
         CAST(sum(rk) FILTER (WHERE planted) AS DOUBLE) AS r1, CAST(sum(CAST(t AS DOUBLE)*t - 1) AS DOUBLE) AS ties,
         quantile_cont(dur_s, 0.5) FILTER (WHERE planted) AS median_1,
         quantile_cont(dur_s, 0.5) FILTER (WHERE NOT planted) AS median_0
  FROM ranked {'GROUP BY ' + by if by else ''}
),
z AS (
  SELECT *, r1 - n1*(n1+1)/2.0 AS "U", CAST(n1 AS DOUBLE)*n0 AS nn,
         sqrt(CAST(n1 AS DOUBLE)*n0/12.0*((n1+n0+1) - ties/(CAST(n1+n0 AS DOUBLE)*(n1+n0-1)))) AS sd FROM u
  WHERE n1 > 0 AND n0 > 0
)"""


def _duration(by: str, sig: bool) -> str:
    names = f"{by}, " if by else ""
    two = f"least(1.0, 2*{p_upper('(greatest(z.U, nn-z.U) - nn/2 - 0.5)/sd')})"
    return roles(
        f"SELECT {names}n1, n0, {r6(U='z.U', median_1='median_1', median_0='median_0', cles='z.U/nn', rbc='2*z.U/nn-1', p_greater=p_upper('(z.U - nn/2 - 0.5)/sd'), p_two=two, median_diff='median_1-median_0')}, "
        f"{two} < 0.05 AS rejected {', ' + STARS.format(p=two) + ' AS sig' if sig else ''} FROM z",
        DURATIONS.strip(),
        _ranked(by).strip(),
    ).replace(' AS U,', ' AS "U",')


ORACLE["branch_duration"] = _duration("", False)
ORACLE["branch_duration_by_map"] = _duration("map_name", True)
ORACLE["branch_summary"] = roles(
    f"SELECT CASE WHEN planted THEN 'yes' ELSE 'no' END AS planted, count(*) AS n, "
    f"{r6(mean='avg(dur_s)', std='stddev_samp(dur_s)', q1='quantile_cont(dur_s,0.25)', median='quantile_cont(dur_s,0.5)', q3='quantile_cont(dur_s,0.75)')} "
    "FROM durations GROUP BY ALL",
    DURATIONS.strip(),
)
_QUANTILES = (
    "SELECT event_type, count(value) AS count, "
    + r6(p10="quantile_cont(value,0.1)", q1="quantile_cont(value,0.25)", median="quantile_cont(value,0.5)", p99="quantile_cont(value,0.99)")
    + " FROM events GROUP BY event_type"
)
ORACLE["value_quantiles"] = _QUANTILES
ORACLE["value_quantiles_ranged"] = _QUANTILES

# --- equipment ---------------------------------------------------------------------------------------------

ORACLE["team_loadout"] = roles(
    f"SELECT round, team, awp, rifles, smgs, CAST(0 AS BIGINT) AS heavy, CAST(0 AS BIGINT) AS pistols, players, "
    f"{r6(helmets='helmets', helmet_share='helmets/players', score='score')} FROM scored"
)


def _category_cells(row: str, col: str) -> str:
    return (
        f"count(*) FILTER (WHERE {row} AND {col}) AS a, count(*) FILTER (WHERE {row} AND NOT {col}) AS b, "
        f"count(*) FILTER (WHERE NOT {row} AND {col}) AS c, count(*) FILTER (WHERE NOT {row} AND NOT {col}) AS d"
    )


ORACLE["token_open"] = roles(
    f"SELECT {tests()} FROM cells",
    f"cells AS (SELECT {_category_cells('t.awp=1', '(t.team = upper(f.opening_side))')} "
    "FROM scored t JOIN first_kill f ON t.round=f.round JOIN rounds r ON t.round=r.round)",
)
_CONVERSION = (
    "FROM opening o LEFT JOIN scored t ON o.round=t.round AND upper(o.opening_side)=t.team"
)
ORACLE["token_conversion"] = roles(
    f"SELECT {tests()} FROM cells",
    f"cells AS (SELECT {_category_cells('coalesce(t.awp=1, true)', 'coalesce(o.winner=o.opening_side, false)')} {_CONVERSION})",
)
ORACLE["token_conversion_known"] = roles(
    f"SELECT {tests()} FROM cells",
    f"cells AS (SELECT {_category_cells('(t.rifles>0)', 'coalesce(o.winner=o.opening_side, false)')} {_CONVERSION} WHERE t.rifles IS NOT NULL)",
)
ORACLE["underdog_conversion"] = roles(
    f"SELECT {tests(one_sided=True)}, a+b AS underdog_n, c+d AS favorite_n, "
    f"{r6(**wilson('a', '(a+b)', 'underdog_rate', 'underdog_ci_lo', 'underdog_ci_hi'), **wilson('c', '(c+d)', 'favorite_rate', 'favorite_ci_lo', 'favorite_ci_hi'))} FROM cells",
    """paired AS (
      SELECT o.winner = o.opening_side AS won, s.score - t.score AS d_score
      FROM opening o JOIN scored s ON o.round=s.round AND upper(o.opening_side)=s.team
                     JOIN scored t ON o.round=t.round AND upper(o.opening_side)<>t.team
      WHERE o.winner IS NOT NULL)""",
    f"cells AS (SELECT {_category_cells('d_score<0', 'won')} FROM paired WHERE d_score <> 0)",
)
ORACLE["paired_sides"] = roles(
    f"""SELECT f.round, f."killerSide", upper(f."killerSide") AS open_team,
       CASE f."killerSide" WHEN 'ct' THEN 'T' ELSE 'CT' END AS other_team,
       s.awp AS awp_open, t.awp AS awp_other, s.awp-t.awp AS d_awp,
       {r6(helmets_open='s.helmets', helmets_other='t.helmets', d_helmets='s.helmets-t.helmets', score_open='s.score', score_other='t.score', d_score='s.score-t.score')},
       CASE WHEN s.score<t.score THEN 'underdog' WHEN s.score>t.score THEN 'favorite' WHEN s.score=t.score THEN 'even' END AS state
     FROM (SELECT round, min_by("killerSide", tick*10 + CASE "killerSide" WHEN 'ct' THEN 0 ELSE 1 END) AS "killerSide" FROM kills GROUP BY round) f
     LEFT JOIN scored s ON f.round=s.round AND upper(f."killerSide")=s.team
     LEFT JOIN scored t ON f.round=t.round AND upper(f."killerSide")<>t.team"""
)
ORACLE["inventory_json"] = """
SELECT p_partkey, '["' || p_name || '", "' || p_type || '"]' AS from_array,
       '["' || p_name || '", "' || p_type || '"]' AS from_text, '[" ' || p_name || '"]' AS from_bare,
       '[]' AS from_broken, '[]' AS from_null
FROM part
"""
ORACLE["explode_items"] = """
SELECT l_orderkey AS round, team, substr(sha1(l_orderkey || '|' || team || '|'), 1, 16) AS row_id, item
FROM (SELECT *, CASE l_linestatus WHEN 'F' THEN 'CT' ELSE 'T' END AS team, unnest([p_name, p_type]) AS item
      FROM lineitem JOIN part ON l_partkey = p_partkey)
"""
ORACLE["item_flags"] = """
SELECT p_partkey,
       CAST(len(list_filter(items, lambda x: contains(x,'widget') OR contains(x,'economy'))) > 0 AS BIGINT) AS any_token,
       CAST(len(list_filter(items, lambda x: contains(x,'ring') OR contains(x,'brand#1') OR contains(x,'small'))) AS BIGINT) AS token_count,
       array_to_string(items, '/') AS items
FROM (SELECT p_partkey, [lower(p_name), lower(p_type), lower(p_brand)] AS items FROM part)
"""

# --- timing --------------------------------------------------------------------------------------------------

SECONDS = """
seconds AS (
  SELECT (f.tick - r.start)/coalesce(h.tickrate, (SELECT coalesce(floor(min_by(struct_pack(x := tickrate), match_id).x), 64.0) FROM header)) AS sec
  FROM rounds r JOIN (SELECT round, min(tick) AS tick FROM kills GROUP BY round) f USING (round)
       LEFT JOIN header h USING (match_id)
)"""
ORACLE["opening_timing"] = roles(
    f"SELECT count(sec) AS count, count(*) AS n, {r6(q1='quantile_cont(sec,0.25)', median='quantile_cont(sec,0.5)', q3='quantile_cont(sec,0.75)')} FROM seconds",
    SECONDS.strip(),
)
ORACLE["timing_hist"] = roles(
    f"SELECT g.bin, {r6(bin_lo='lo+(hi-lo)/20*(g.bin-1)', bin_hi='lo+(hi-lo)/20*g.bin')}, count(p.bin) AS n "
    "FROM (SELECT unnest(range(1,21)) AS bin) g CROSS JOIN edges LEFT JOIN placed p ON g.bin=p.bin GROUP BY g.bin, lo, hi",
    SECONDS.strip(),
    "edges AS (SELECT min(sec) AS lo, max(sec) AS hi FROM seconds)",
    "placed AS (SELECT CAST(least(20, 1+floor((sec-lo)/(hi-lo)*20)) AS BIGINT) AS bin FROM seconds, edges)",
)
ANSWERS = """
opened AS (
  SELECT round, min(tick) AS t0, min_by("killerSide", tick*10 + CASE "killerSide" WHEN 'ct' THEN 0 ELSE 1 END) AS side0
  FROM kills GROUP BY round
),
answers AS (
  SELECT o.round, any_value(o.t0) AS t0, any_value(o.side0) AS side0, min(k.tick) AS t1
  FROM opened o LEFT JOIN kills k ON k.round=o.round AND k.tick>o.t0 AND k."killerSide"<>o.side0 GROUP BY o.round
)"""
ORACLE["next_opposite_kill"] = roles("SELECT round, t0, side0, t1 FROM answers", ANSWERS.strip())
_CURVE = (
    "SELECT g.\"T\", count(*) FILTER (WHERE (t1-t0)/30.0 <= g.\"T\") AS n_within, "
    "round(count(*) FILTER (WHERE (t1-t0)/30.0 <= g.\"T\")/CAST(count(*) AS DOUBLE), 6) AS ret_rate "
    "FROM answers CROSS JOIN (SELECT unnest({points}) AS \"T\") g GROUP BY g.\"T\""
)
ORACLE["trade_curve"] = roles(_CURVE.format(points="range(1,13)"), ANSWERS.strip())
ORACLE["trade_curve_points"] = roles(_CURVE.format(points="[1,3,5,10]::BIGINT[]"), ANSWERS.strip())

# --- features ------------------------------------------------------------------------------------------------

FEATURES = """
features AS (
  SELECT o.o_orderkey AS round, o.o_totalprice, c.c_acctbal, l.lines::DOUBLE AS lines, (n.t0 - r.start)::DOUBLE AS first_delay,
         (n.t1 - n.t0)/30.0::DOUBLE AS dt_s,
         CASE WHEN n.t0 IS NOT NULL THEN coalesce((n.t1-n.t0)/30.0 <= 3, false)::INT::DOUBLE END AS trade_3s,
         CASE WHEN n.t0 IS NOT NULL THEN coalesce((n.t1-n.t0)/30.0 <= 5, false)::INT::DOUBLE END AS trade_5s,
         CASE WHEN n.t0 IS NOT NULL THEN coalesce((n.t1-n.t0)/30.0 <= 10, false)::INT::DOUBLE END AS trade_10s,
         coalesce(r.winner = n.side0, false)::INT::DOUBLE AS open_won,
         s.score - t.score AS d_score, s.score AS score_open, t.score AS score_other
  FROM orders o LEFT JOIN customer c ON o.o_custkey=c.c_custkey
  LEFT JOIN (SELECT round, count(*) AS lines FROM kills GROUP BY round) l ON l.round=o.o_orderkey
  LEFT JOIN answers n ON n.round=o.o_orderkey
  LEFT JOIN rounds r ON r.round=o.o_orderkey
  LEFT JOIN scored s ON s.round=o.o_orderkey AND s.team=upper(n.side0)
  LEFT JOIN scored t ON t.round=o.o_orderkey AND t.team<>upper(n.side0)
)"""
_NAMES = [
    "o_totalprice", "c_acctbal", "lines", "first_delay", "dt_s", "trade_3s", "trade_5s", "trade_10s", "open_won",
    "d_score", "score_open", "score_other",
]
ORACLE["round_features"] = roles(
    f"SELECT round, {r6(**{n: n for n in _NAMES})} FROM features", ANSWERS.strip(), FEATURES.strip()
)


def _spearman(features: str, names: list[str]) -> str:
    """Average ranks inside each pair, then Pearson."""
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS f1, '{g}' AS f2, {f} AS x, {g} AS y FROM features WHERE {f} IS NOT NULL AND {g} IS NOT NULL"
        for f in names for g in names
    )
    return roles(
        """SELECT g.f1, g.f2, round(CASE WHEN vx > 1e-9 AND vy > 1e-9 THEN cxy/sqrt(vx)/sqrt(vy) END, 6) + 0.0 AS rho, coalesce(n, 0) AS n
        FROM (SELECT a.name AS f1, b.name AS f2 FROM names a CROSS JOIN names b) g LEFT JOIN (SELECT f1, f2, count(*) AS n, sum((rx-m)*(ry-m)) AS cxy, sum((rx-m)*(rx-m)) AS vx, sum((ry-m)*(ry-m)) AS vy
              FROM ranks GROUP BY f1, f2) s ON g.f1=s.f1 AND g.f2=s.f2""",
        ANSWERS.strip(),
        features.strip(),
        f"names AS (SELECT unnest({names}) AS name)",
        f"pairs AS ({long})",
        """ranks AS (
          SELECT f1, f2, rank() OVER (PARTITION BY f1, f2 ORDER BY x) + (count(*) OVER (PARTITION BY f1, f2, x) - 1)/2.0::DOUBLE AS rx,
                 rank() OVER (PARTITION BY f1, f2 ORDER BY y) + (count(*) OVER (PARTITION BY f1, f2, y) - 1)/2.0::DOUBLE AS ry,
                 (count(*) OVER (PARTITION BY f1, f2) + 1)/2.0::DOUBLE AS m FROM pairs)""",
    )


MATCH_FEATURES = """
ends AS (SELECT round, max(tick) AS last FROM kills GROUP BY round),
planted AS (SELECT l_orderkey AS round, min(l_quantity) AS t_sec FROM lineitem WHERE l_returnflag='R' GROUP BY l_orderkey),
rated AS (
  SELECT r.match_id, n.round, n.t0, n.t1, n.side0, r.winner, r.start, e.last, coalesce(h.tickrate, 64.0) AS rate
  FROM answers n JOIN rounds r USING (round) JOIN ends e USING (round) LEFT JOIN header h USING (match_id)
),
features AS (
  SELECT r.match_id, r.round, coalesce(winner=side0, false)::INT::DOUBLE AS open_won, (t0-start)/rate AS time_to_ok_s,
         coalesce((t1-t0)/rate <= 3, false)::INT::DOUBLE AS trade_3s, coalesce((t1-t0)/rate <= 5, false)::INT::DOUBLE AS trade_5s,
         coalesce((t1-t0)/rate <= 10, false)::INT::DOUBLE AS trade_10s,
         (p.t_sec IS NOT NULL)::INT::DOUBLE AS plant, p.t_sec AS time_to_plant_s, (last-start)/rate AS round_dur_s,
         s.score-t.score AS d_score, (s.awp-t.awp)::BIGINT AS d_awp, (s.rifles-t.rifles)::BIGINT AS d_rifles, (s.smgs-t.smgs)::BIGINT AS d_smgs,
         CASE WHEN s.score+t.score IS NOT NULL THEN 0::BIGINT END AS d_heavy, CASE WHEN s.score+t.score IS NOT NULL THEN 0::BIGINT END AS d_pistols,
         s.helmets-t.helmets AS d_helmets, s.score AS score_open, t.score AS score_other
  FROM rated r LEFT JOIN planted p ON p.round=r.round
  LEFT JOIN scored s ON s.round=r.round AND s.team=upper(side0) LEFT JOIN scored t ON t.round=r.round AND t.team<>upper(side0)
)"""
_MATCH_NAMES = [
    "open_won", "time_to_ok_s", "trade_3s", "trade_5s", "trade_10s", "plant", "time_to_plant_s", "round_dur_s",
    "d_score", "d_awp", "d_rifles", "d_smgs", "d_heavy", "d_pistols", "d_helmets", "score_open", "score_other",
]
_WHOLE = ["d_awp", "d_rifles", "d_smgs", "d_heavy", "d_pistols"]
ORACLE["match_features"] = roles(
    f"SELECT match_id, round, {', '.join(_WHOLE)}, {r6(**{n: n for n in _MATCH_NAMES if n not in _WHOLE})} FROM features",
    ANSWERS.strip(),
    MATCH_FEATURES.strip(),
)
ORACLE["feature_correlations"] = _spearman(MATCH_FEATURES, _MATCH_NAMES)
ORACLE["trade_curve_rated"] = roles(
    'SELECT g."T", count(*) FILTER (WHERE (t1-t0)/rate <= g."T") AS n_within, '
    'round(count(*) FILTER (WHERE (t1-t0)/rate <= g."T")/CAST(count(*) AS DOUBLE), 6) AS ret_rate '
    'FROM rated CROSS JOIN (SELECT unnest(range(1,13)) AS "T") g GROUP BY g."T"',
    ANSWERS.strip(),
    MATCH_FEATURES.strip(),
)
ORACLE["spearman"] = _spearman(FEATURES, _NAMES)
ORACLE["spearman_ranged"] = ORACLE["spearman"]

# --- intervals and snapshots ---------------------------------------------------------------------------------

MICROS = "date_diff('microsecond', TIMESTAMP '2024-01-01', ts)"
SIGNUPS = f"""
timed AS (SELECT *, {MICROS} AS tick FROM events),
starts AS (SELECT user_id, event_id AS round, tick AS start FROM timed WHERE event_type='signup'),
closed AS (
  SELECT s.user_id, s.round, min(e.tick) AS last
  FROM (SELECT * FROM timed WHERE event_type='error') e ASOF JOIN starts s ON e.user_id=s.user_id AND e.tick>=s.start
  GROUP BY ALL
),
spans AS (SELECT s.user_id, s.round, s.start, c.last FROM starts s LEFT JOIN closed c USING (user_id, round)),
attached AS (
  SELECT e.event_id, e.user_id, e.tick, s.round, s.start
  FROM timed e ASOF LEFT JOIN spans s ON e.user_id=s.user_id AND e.tick>=s.start
  WHERE s.last IS NULL OR e.tick<=s.last
)"""
ORACLE["asof_rounds"] = f"WITH {SIGNUPS} SELECT event_id, user_id, tick, round FROM attached"
ORACLE["asof_rounds_blocked"] = ORACLE["asof_rounds"]
ORACLE["relative_times"] = (
    f"WITH {SIGNUPS} SELECT event_id, round, (tick-start)::DOUBLE AS t_round, {r6(t_sec='(tick-start)/1e6')} FROM attached"
)

DEMO = f"""
demo AS (
  SELECT 'demo' || (user_id % 5) || '.dem' AS demo_file, 'map_' || (user_id % 5) AS map_name,
         CAST(floor({MICROS}/86400000000) AS BIGINT) AS day, {MICROS} AS tick,
         event_id, user_id, event_type, value, props
  FROM events
),
demo_rounds AS (
  SELECT DISTINCT demo_file, day AS round, day*86400000000+3600000000 AS start,
         CASE WHEN day % 4 <> 0 THEN day*86400000000+23*3600000000 END AS last,
         CASE WHEN day % 5 <> 0 THEN day*86400000000+3*3600000000 END AS freeze_end
  FROM demo
),
placed AS (
  SELECT e.*, r.round, r.start, CASE WHEN e.demo_file='demo0.dem' THEN 128.0 ELSE 64.0 END AS rate
  FROM demo e ASOF LEFT JOIN demo_rounds r ON e.demo_file=r.demo_file AND e.tick>=r.start
  WHERE r.last IS NULL OR e.tick<=r.last
)"""
_SNAP_FIRST = "arg_min(struct_pack(v := {c}), tick).v"
ORACLE["snapshot_first_row"] = f"""
WITH {DEMO}, kept AS (
  SELECT d.*, row_number() OVER (PARTITION BY d.demo_file, d.day, user_id ORDER BY tick) AS rn
  FROM demo d JOIN demo_rounds r ON d.demo_file=r.demo_file AND d.day=r.round WHERE d.tick>=r.freeze_end
)
SELECT demo_file, day AS round_num, CASE user_id % 3 WHEN 0 THEN 'T' ELSE 'CT' END AS side, event_type AS name,
       CAST(user_id AS VARCHAR) AS steamid, round(CASE WHEN value>=5 THEN value END, 6)+0.0 AS health,
       CAST(floor(value) AS BIGINT) AS armor, CAST(value>20 AS BIGINT) AS has_helmet, event_type || '/' || props AS inventory
FROM kept WHERE rn=1 AND user_id % 3 IN (0,1)
"""
ORACLE["snapshot_first_value"] = f"""
WITH {DEMO}, kept AS (
  SELECT d.* FROM demo d JOIN demo_rounds r ON d.demo_file=r.demo_file AND d.day=r.round
  WHERE r.freeze_end IS NULL OR d.tick>=r.freeze_end
)
SELECT demo_file, map_name, day AS round, CAST(user_id AS VARCHAR) AS steamid, arg_min(event_type, tick) AS name,
       user_id % 3 + 2 AS team_num, CASE user_id % 3 WHEN 0 THEN 'T' ELSE 'CT' END AS team,
       round(arg_min(value, tick) FILTER (WHERE value>=5), 6)+0.0 AS health,
       CAST(floor(arg_min(value, tick)) AS BIGINT) AS armor, CAST(arg_min(value, tick)>20 AS BIGINT) AS has_helmet,
       '["' || arg_min(event_type, tick) || '", "' || replace(arg_min(props, tick), '"', '\\"') || '"]' AS inventory_json,
       substr(sha1(demo_file || '|' || day || '|' || user_id || '|'), 1, 16) AS row_id
FROM kept WHERE user_id % 3 IN (0,1) GROUP BY demo_file, map_name, day, user_id
"""
ORACLE["trajectories"] = f"""
WITH {DEMO}, points AS (
  SELECT *, event_type || 'Projectile' AS kind, CASE WHEN value>=5 THEN value END AS x,
         demo_file <> 'demo1.dem' AS by_id FROM demo WHERE event_type <> 'view'
)
SELECT demo_file, day AS round, CASE WHEN by_id THEN CAST(user_id AS VARCHAR) END AS "grenadeId",
       min(tick) AS start_tick, max(tick) AS end_tick,
       arg_min(kind, tick) AS "grenadeType", CAST(user_id AS VARCHAR) AS "throwerSteamID",
       {r6(start_x='arg_min(x, tick) FILTER (WHERE x IS NOT NULL)', end_x='arg_max(x, tick) FILTER (WHERE x IS NOT NULL)',
           start_y='2*(arg_min(x, tick) FILTER (WHERE x IS NOT NULL))', end_y='2*(arg_max(x, tick) FILTER (WHERE x IS NOT NULL))',
           start_z='arg_min(value, tick)', end_z='arg_max(value, tick)')}
FROM points GROUP BY demo_file, day, user_id, by_id, CASE WHEN by_id THEN '' ELSE kind END
"""
ORACLE["dedup_first"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn=1
"""
ORACLE["event_ids"] = """
SELECT substr(sha1('demo1.dem|' || l_orderkey || '|' || l_linenumber || '|' || CASE WHEN l_returnflag<>'N' THEN l_returnflag ELSE 'None' END || '||'), 1, 16) AS event_id,
       l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey FROM lineitem
"""
ORACLE["normalize_events"] = f"""
SELECT event_id, CASE event_type WHEN 'purchase' THEN 'planted' WHEN 'signup' THEN 'defused' ELSE 'explode' END AS event,
       CASE event_type WHEN 'purchase' THEN 'planted' WHEN 'signup' THEN 'defused' END AS event_no_explode,
       {r6(level="TRY_CAST(regexp_extract(props, ': *([0-9.]+)', 1) AS DOUBLE)")},
       CAST(NULL AS DOUBLE) AS not_a_number, CASE user_id % 4 WHEN 2 THEN 'T' WHEN 3 THEN 'CT' END AS team,
       CAST(value>20 AS BIGINT) AS big, CAST(0 AS BIGINT) AS has_ic,
       CAST(floor(value/nullif(nullif(user_id,7),0)) AS BIGINT) AS per_user
FROM events WHERE event_type IN ('purchase','signup','error')
"""

# --- varying sources -----------------------------------------------------------------------------------------

ORACLE["variant_union"] = """
SELECT CASE WHEN event_type IN ('click','view') THEN 'one' WHEN event_type='signup' THEN 'three' ELSE 'two' END AS match_id,
       'm' AS map_name, match_id || '.dem' AS demo_file, CAST(NULL AS BIGINT) AS round, event_type AS event,
       CASE WHEN event_type='signup' THEN props END AS site,
       CASE WHEN event_type IN ('click','view','signup') THEN CAST(user_id AS VARCHAR) END AS "playerSteamID",
       CAST(NULL AS VARCHAR) AS "playerName", CAST(NULL AS DOUBLE) AS t_round,
       CASE WHEN event_type IN ('error','purchase') THEN round(value, 6)+0.0 END AS t_sec, CAST(event_id AS VARCHAR) AS event_id
FROM events
"""
ORACLE["header_tickrate"] = """
SELECT c_name AS demo_file, c_mktsegment AS map_name,
       '{"' || CASE WHEN c_nationkey%2=0 THEN 'map_name' ELSE 'mapName' END || '":"' || c_mktsegment || '","' ||
       CASE c_nationkey%4 WHEN 0 THEN 'tickrate' WHEN 1 THEN 'tickRate' WHEN 2 THEN 'ticksPerSecond' ELSE 'other' END || '":"' ||
       CASE c_nationkey%3 WHEN 0 THEN '64' WHEN 1 THEN '0' ELSE 'fast' END || '"}' AS header_json,
       CASE WHEN c_nationkey%4 < 3 AND c_nationkey%3 = 0 THEN 64.0 ELSE 128.0 END::DOUBLE AS tickrate
FROM customer
"""
ORACLE["default_tickrate"] = roles(
    "SELECT coalesce(floor(tickrate), 64.0)::DOUBLE AS tickrate FROM header ORDER BY match_id LIMIT 1"
)

# --- feed ------------------------------------------------------------------------------------------------------

ORACLE["url_slugs"] = """
SELECT page_id, regexp_replace(url, '[^0-9A-Za-z._-]', '_', 'g') AS slug,
       trim(regexp_replace(url, '[^0-9A-Za-z._-]+', '_', 'g'), '_') AS tight_slug FROM pages
"""


def _triage(body: str) -> str:
    return f"""strlen({body}) AS length,
       CASE WHEN starts_with({body}, 'PK' || chr(3) || chr(4)) THEN 'zip' WHEN starts_with({body}, 'Rar!') THEN 'rar'
            WHEN starts_with({body}, 'BZh') THEN 'bzip2' ELSE 'raw' END AS kind,
       CAST(regexp_matches({body}, '(?i)^\\s*(<!doctype\\s+html|<html|<head|<body|<title|<!--)')
            OR NOT regexp_matches({body}, '[^\\t\\n\\f\\r\\x20-\\x7E]') AS BIGINT) AS is_text"""


ORACLE["page_triage"] = f"""
SELECT *, CAST(length>=1000 AND is_text=0 AS BIGINT) AS accepted FROM (SELECT page_id, {_triage('html')} FROM pages)
"""
ORACLE["document_triage"] = f"""
SELECT kind, is_text, CAST(length>=1000 AND is_text=0 AS BIGINT) AS accepted, count(*) AS n, CAST(sum(length) AS BIGINT) AS bytes
FROM (SELECT {_triage('text')} FROM documents) GROUP BY ALL
"""
ORACLE["match_slugs"] = """
SELECT url, regexp_replace(CASE WHEN count(DISTINCT top)=1 THEN min(top) ELSE url END, '[^0-9A-Za-z._-]', '_', 'g') AS slug
FROM (SELECT regexp_extract(url, '^(https?://[^/]+)', 1) AS url,
             nullif(regexp_extract(url, '^https?://[^/]+/([^/?#]+)/', 1), '') AS top FROM pages) GROUP BY url
"""

# --- warehouse -------------------------------------------------------------------------------------------------

_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]
_COUNTS = " UNION ALL ".join([f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in _TABLES] + ["SELECT 'absent', NULL"])
ORACLE["manifest"] = _COUNTS
ORACLE["catalog"] = (
    "SELECT \"table\", rows, 'rows of ' || \"table\" AS contains, \"table\" || ' key' AS keys, 'all columns' AS notables "
    f"FROM ({_COUNTS})"
)
ORACLE["entities"] = roles(
    "SELECT 'matches' AS entity, count(DISTINCT match_id) AS count FROM rounds JOIN header USING (match_id) "
    "UNION ALL SELECT 'demos', count(DISTINCT match_id) FROM header "
    "UNION ALL SELECT 'maps', count(DISTINCT map_name) FROM rounds JOIN header USING (match_id) "
    "UNION ALL SELECT 'rounds', count(*) FROM rounds JOIN header USING (match_id) "
    "UNION ALL SELECT 'players', count(DISTINCT \"killerSide\") FROM kills UNION ALL SELECT 'absent', 0"
)
LINES = """
lines AS (
  SELECT CASE WHEN l_quantity<>1 THEN substr(sha1(l_orderkey || '|' || l_linenumber || '|'), 1, 16) END AS event_id,
         l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag
  FROM lineitem
)"""
ORACLE["merge_append"] = f"""
WITH {LINES}, merged AS (
  SELECT l_returnflag, l_suppkey, l_partkey FROM lines WHERE l_returnflag='R'
  UNION ALL SELECT l_returnflag, NULL, l_partkey FROM lines)
SELECT l_returnflag, count(*) AS n, count(l_suppkey) AS with_supplier, CAST(sum(l_partkey) AS BIGINT) AS parts
FROM merged GROUP BY l_returnflag
"""
_ORDER = "l_suppkey, l_partkey, l_orderkey, l_linenumber, l_extendedprice, l_returnflag"
ORACLE["merge_ignore"] = f"""
WITH {LINES}, target AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {_ORDER}) AS rn FROM lines WHERE l_returnflag='R'
), source AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {_ORDER}) AS rn FROM lines
), merged AS (
  SELECT * FROM target WHERE rn=1 OR event_id IS NULL
  UNION ALL
  SELECT * FROM source s WHERE event_id IS NULL
     OR (rn=1 AND NOT EXISTS (SELECT 1 FROM target t WHERE t.event_id=s.event_id))
)
SELECT event_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice,6)+0.0 AS l_extendedprice, l_returnflag FROM merged
"""
ORACLE["merge_new_rows"] = f"""
WITH {LINES}, source AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber, event_id NULLS FIRST, l_partkey, l_extendedprice, l_returnflag) AS rn FROM lines
)
SELECT event_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice,6)+0.0 AS l_extendedprice, l_returnflag FROM source s
WHERE rn=1 AND NOT EXISTS (SELECT 1 FROM lines t WHERE t.l_returnflag='N' AND t.l_orderkey=s.l_orderkey AND t.l_suppkey=s.l_suppkey)
"""

# --- match ingest ----------------------------------------------------------------------------------------------

ORACLE["ingest_kills"] = f"""
WITH {DEMO}
SELECT demo_file, map_name, round, tick, CAST(user_id AS VARCHAR) AS "killerSteamID", CAST(event_id AS VARCHAR) AS "victimSteamID",
       CASE WHEN user_id%2=0 THEN 'ct' ELSE 't' END AS "killerSide", props AS weapon, CAST(value>20 AS BIGINT) AS headshot,
       {r6(x='value', y='value*2')}, CAST(NULL AS DOUBLE) AS z
FROM placed WHERE event_type='purchase'
"""
ORACLE["ingest_shots"] = f"""
WITH {DEMO}
SELECT demo_file, map_name, round, tick, (tick-start)::DOUBLE AS t_round, {r6(t_sec='(tick-start)/rate')},
       substr(sha1(demo_file || '|' || round || '|' || tick || '|' || user_id || '|' || props || '|'), 1, 16) AS event_id,
       CAST(user_id AS VARCHAR) AS "shooterSteamID", props AS weapon, {r6(x='value')}
FROM placed WHERE event_type='click' AND round IS NOT NULL
"""
ORACLE["ingest_bomb"] = f"""
WITH {DEMO}, named AS (
  SELECT *, CASE event_type WHEN 'purchase' THEN 'planted' WHEN 'signup' THEN 'defused' ELSE 'explode' END AS event
  FROM placed WHERE event_type IN ('purchase','signup','error'))
SELECT demo_file, map_name, round, tick, props AS site, CAST(user_id AS VARCHAR) AS "playerSteamID", event_type AS "playerName", event,
       (tick-start)::DOUBLE AS t_round, {r6(t_sec='(tick-start)/rate')},
       substr(sha1(demo_file || '|' || coalesce(CAST(round AS VARCHAR),'None') || '|' || tick || '|' || props || '|' || user_id || '|' || event_type || '|' || event || '|'), 1, 16) AS event_id
FROM named
"""
ORACLE["ingest_grenades"] = f"""
WITH {DEMO}, points AS (
  SELECT *, event_type || 'Projectile' AS kind, CASE WHEN demo_file<>'demo1.dem' THEN user_id END AS entity_id,
         CASE WHEN value>=5 THEN value END AS x FROM demo WHERE event_type<>'view'
), firsts AS (
  SELECT *, row_number() OVER (PARTITION BY demo_file, day, entity_id ORDER BY tick) AS rn FROM points)
SELECT demo_file, map_name, day AS round, tick, kind AS "grenadeType", CAST(user_id AS VARCHAR) AS "throwerSteamID",
       {r6(X='x', Y='x*2', Z='value')}, entity_id,
       substr(sha1(demo_file || '|' || coalesce(CAST(entity_id AS VARCHAR),'None') || '|' || day || '|' || tick || '|' || kind || '|' || user_id || '|'), 1, 16) AS event_id
FROM firsts WHERE rn=1
"""
_PER = "SELECT demo_file, map_name, {round} AS round, count(*) AS n, '{table}' AS \"table\" FROM {source} GROUP BY ALL"
_MAPPED = "(SELECT *, 'map_' || substr(demo_file, 5, 1) AS map_name FROM demo_rounds)"
ORACLE["slim_tables"] = f"""
WITH {DEMO},
loadouts AS (SELECT DISTINCT d.demo_file, d.map_name, d.day AS round, user_id FROM demo d JOIN demo_rounds r ON d.demo_file=r.demo_file AND d.day=r.round
             WHERE (r.freeze_end IS NULL OR d.tick>=r.freeze_end) AND user_id%3 IN (0,1)),
thrown AS (SELECT DISTINCT demo_file, map_name, day AS round,
                  CASE WHEN demo_file<>'demo1.dem' THEN CAST(user_id AS VARCHAR) ELSE user_id || '|' || event_type END AS id
           FROM demo WHERE event_type<>'view'),
thrown_events AS (SELECT DISTINCT demo_file, map_name, day AS round, CASE WHEN demo_file<>'demo1.dem' THEN user_id END AS id
                  FROM demo WHERE event_type<>'view'),
roster AS (SELECT DISTINCT demo_file, map_name, day AS round, user_id, event_type FROM demo),
twice AS (SELECT * FROM placed WHERE event_type='click' UNION ALL SELECT * FROM placed WHERE event_type='click')
{_PER.format(round='CAST(NULL AS BIGINT)', table='header', source="(SELECT DISTINCT demo_file, map_name FROM demo)")}
UNION ALL {_PER.format(round='round', table='rounds', source=_MAPPED)}
UNION ALL {_PER.format(round='round', table='round_loadouts', source='loadouts')}
UNION ALL {_PER.format(round='round', table='kills_slim', source="(SELECT * FROM placed WHERE event_type='purchase')")}
UNION ALL {_PER.format(round='round', table='damages_slim', source="(SELECT * FROM placed WHERE event_type='error')")}
UNION ALL {_PER.format(round='round', table='shots_slim', source='twice')}
UNION ALL {_PER.format(round='round', table='events_shots', source="(SELECT * FROM placed WHERE event_type='click' AND round IS NOT NULL)")}
UNION ALL {_PER.format(round='round', table='bomb', source="(SELECT * FROM placed WHERE event_type IN ('purchase','signup','error'))")}
UNION ALL {_PER.format(round='round', table='events_bomb', source="(SELECT * FROM placed WHERE event_type IN ('purchase','signup','error'))")}
UNION ALL {_PER.format(round='round', table='players_slim', source='roster')}
UNION ALL {_PER.format(round='round', table='grenades_summary', source='thrown')}
UNION ALL {_PER.format(round='round', table='events_grenades', source='thrown_events')}
UNION ALL {_PER.format(round='day', table='chat', source="(SELECT * FROM demo WHERE event_type='signup')")}
"""

ORACLE["warehouse_merge"] = """
WITH lines AS (SELECT l_returnflag AS flag, CAST(l_linenumber AS BIGINT) AS round,
                      CASE WHEN l_linenumber<7 THEN (l_orderkey%500) || '-' || l_linenumber END AS event_id FROM lineitem),
arrived AS (SELECT '007' AS match_id, event_id, round FROM lines WHERE flag='A' UNION ALL SELECT '1e3', event_id, round FROM lines WHERE flag='N'
            UNION ALL SELECT '1.10', event_id, round FROM lines WHERE flag='R' UNION ALL SELECT 'm1', event_id, round FROM lines WHERE round=1)
SELECT min(match_id) AS match_id, event_id, min(round) AS round FROM arrived WHERE event_id IS NOT NULL GROUP BY event_id
UNION ALL SELECT match_id, event_id, round FROM arrived WHERE event_id IS NULL
"""

ORACLE["ingest_stream_merge"] = """
SELECT DISTINCT ON (event_id) match_id, event, event_id, "playerSteamID", t_sec FROM (
  SELECT 'stream' AS match_id,
         CASE WHEN contains(event_type,'purchase') THEN 'planted' WHEN contains(event_type,'signup') THEN 'defused' WHEN contains(event_type,'error') THEN 'explode' END AS event,
         substr(sha1(coalesce(CAST(event_id AS VARCHAR),'None') || '|'), 1, 16) AS event_id, CAST(user_id AS VARCHAR) AS "playerSteamID", round(value, 6) AS t_sec
  FROM events) WHERE event IS NOT NULL
"""

ORACLE["url_manifest"] = """
SELECT url, regexp_replace(url, '[^0-9A-Za-z._-]', '_', 'g') AS slug FROM pages WHERE url IS NOT NULL AND url <> ''
"""


def _count_of(words: list[str], name: str) -> str:
    hit = " OR ".join(f"contains(x,'{w}')" for w in words)
    return f"CAST(len([x FOR x IN items IF {hit}]) AS BIGINT) AS {name}"


ORACLE["weapon_categories"] = f"""
SELECT p_partkey, {", ".join(_count_of(words, name) for name, words in CATEGORIES.items())}
FROM (SELECT p_partkey, [lower(w[p_partkey % len(w) + 1]), lower(w[p_size % len(w) + 1]), lower(p_brand)] AS items
      FROM (SELECT *, [{", ".join(f"'{w}'" for w in WEAPONS)}] AS w FROM part))
"""
