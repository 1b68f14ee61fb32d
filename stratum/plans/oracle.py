"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark plans: series are computed in long form
with ``lag``/``lead`` and ``row_number`` windows, group totals with window
sums, as a plain SQL user would.  Doubles are published at 6 decimals
(``round(x, 6) + 0.0``, so DuckDB's negative zero reads as zero).  Sums are
strict (one missing value makes the group missing) wherever the library's are.
"""

from __future__ import annotations

SEGS = "['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY']"
RG_ROWS = ("('AUTOMOBILE', 0, 0.10, 0.30), ('BUILDING', 1, 0.15, 0.25), ('FURNITURE', 2, 0.20, 0.20), "
           "('HOUSEHOLD', 3, 0.25, 0.15), ('MACHINERY', 4, 0.30, 0.10)")
REF_Y, BASE_Y, TGT_Y = 1995, 1996, 2000
HIER_YEARS = (1996, 1998, 1999, 2000)
TGT_YEARS = (1995, 1996, 1998, 1999, 2000)
ANNUAL = tuple(range(1995, 2001))
D = "::DOUBLE"


def ssum(x: str) -> str:
    """Strict sum (one NULL makes the group NULL), as the library's strict_sum."""
    return f"CASE WHEN count(*) = count({x}) THEN sum({x}) END"


def wsum(x: str, part: str) -> str:
    """Strict window sum over ``PARTITION BY part``."""
    return (f"CASE WHEN count(*) OVER (PARTITION BY {part}) = count({x}) OVER (PARTITION BY {part}) "
            f"THEN sum({x}) OVER (PARTITION BY {part}) END")


def nz(sql: str) -> str:
    """Wrap every ``round(…, 6)`` as ``(round(…, 6) + 0.0)``: no negative zero."""
    out, i = [], 0
    while True:
        j = s_find = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            ch = sql[k]
            depth += ch == "("
            depth -= ch == ")"
            if depth == 0:
                break
            k += 1
        inner = sql[j:k + 1]
        if inner.endswith(", 6)"):
            out.append(sql[i:j] + "(" + inner + " + 0.0)")
        else:
            out.append(sql[i:k + 1])
        i = k + 1
        del s_find


def r6(c: str, alias: str | None = None) -> str:
    return f"round({c}, 6) AS {alias or c}"


def ratio0(n: str, d: str) -> str:
    return (f"CASE WHEN {n} IS NULL OR {d} IS NULL OR isnan({n}) OR isnan({d}) THEN 0.0{D} "
            f"WHEN {d} = 0 THEN CASE WHEN {n} = 0 THEN 0.0{D} END ELSE {n} / {d} END")


def base_ctes(scenarios=("base",), schemes=("existing",), annex=False) -> list[str]:
    sc = ", ".join(f"('{s}')" for s in scenarios)
    yrs = (REF_Y, BASE_Y, TGT_Y)
    p = ",\n    ".join(f"sum(CASE WHEN year(o_orderdate) = {y} THEN o_totalprice / 100.0 END) AS p{y}" for y in yrs)
    n = ",\n    ".join(f"sum(CASE WHEN year(o_orderdate) = {y} THEN 10.0{D} END) AS n{y}" for y in yrs)
    xw = []
    if "existing" in schemes:
        xw.append("SELECT 'existing' AS scheme, city_id, segment AS rg_id FROM cb")
    if "proposed" in schemes:
        xw.append(f"SELECT 'proposed' AS scheme, city_id, {SEGS}[city_id % 5 + 1] AS rg_id FROM cb")
    flat = "flat" in scenarios
    ax = "annex" if annex else f"0.0{D}"
    ctes = [
        f"""cust_o AS (SELECT o_custkey AS cid,
    {p},
    {n}
  FROM orders WHERE year(o_orderdate) IN ({REF_Y}, {BASE_Y}, {TGT_Y}) GROUP BY o_custkey)""",
        f"""cb0 AS (SELECT c_custkey AS city_id, CAST(c_nationkey AS BIGINT) AS county, c_mktsegment AS segment,
    c_name AS juris,
    coalesce(p{REF_Y}, 0.0{D}) AS pop_ref, coalesce(p{BASE_Y}, 0.0{D}) AS pop_base,
    coalesce(p{TGT_Y}, 0.0{D}) AS pop_end, coalesce(n{REF_Y}, 0.0{D}) AS emp_ref,
    coalesce(n{BASE_Y}, 0.0{D}) AS emp_base, coalesce(n{TGT_Y}, 0.0{D}) AS emp_end,
    greatest(c_acctbal, 0.0{D}) AS target_pop, greatest(c_acctbal, 0.0{D}) / 2.0 AS target_emp,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 100.0{D} ELSE 0.0{D} END AS cr_add,
    CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 250.0{D} ELSE 0.0{D} END AS annex,
    CAST(c_custkey % 5 + 1 AS DOUBLE) / 100.0 AS gq_pct,
    CAST(c_custkey % 7 + 1 AS DOUBLE) / 100.0 AS gq_pct_target,
    2.0 + CAST(c_custkey % 9 AS DOUBLE) / 10.0 AS pph_target
  FROM customer LEFT JOIN cust_o ON c_custkey = cust_o.cid)""",
        """cb AS (SELECT *, pop_ref * (1 - gq_pct) AS hhpop_ref, pop_base * (1 - gq_pct) AS hhpop_base,
    pop_ref * (1 - gq_pct) / pph_target AS hh_ref, pop_base * (1 - gq_pct) / pph_target AS hh_base FROM cb0)""",
        f"""city_emp AS (SELECT city_id, county, emp_ref, emp_base, target_emp AS target, cr_add,
    {ax} AS annex FROM cb)""",
        f"""city_pop AS (SELECT city_id, county, pop_ref, pop_base, target_pop AS target, hhpop_ref, hhpop_base,
    hh_ref, hh_base, gq_pct, gq_pct_target, pph_target, {ax} AS annex, pph_target AS pph FROM cb)""",
        "xwalk AS (" + " UNION ALL ".join(xw) + ")",
        f"""ref1 AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, sum(o_totalprice / 100.0) AS pop,
    sum(o_totalprice / 100.0 * (1 - CAST(o_custkey % 5 + 1 AS DOUBLE) / 100.0)) AS hhpop,
    sum(o_totalprice / 100.0 * (1 - CAST(o_custkey % 5 + 1 AS DOUBLE) / 100.0)
        / (2.0 + CAST(o_custkey % 9 AS DOUBLE) / 10.0)) AS hh,
    sum(10.0{D}) AS emp FROM orders GROUP BY 1)""",
        f"""ref AS (SELECT s.scenario, year, pop, hhpop, hh, emp FROM ref1, (VALUES {sc}) s(scenario))""",
        f"""rgs_county AS (SELECT 'base' AS scenario, CAST(n_nationkey AS BIGINT) AS county,
    CAST(n_nationkey + 1 AS DOUBLE) / 325.0 AS rgs_pop, CAST(25 - n_nationkey AS DOUBLE) / 325.0 AS rgs_emp,
    CAST(n_nationkey % 5 + 1 AS DOUBLE) / 100.0 AS gq_pct_target,
    2.0 + CAST(n_nationkey % 7 AS DOUBLE) / 10.0 AS pph_target FROM nation"""
        + (f"""
  UNION ALL SELECT 'flat', CAST(n_nationkey AS BIGINT), 1.0{D} / 25.0, 1.0{D} / 25.0,
    CAST(n_nationkey % 5 + 1 AS DOUBLE) / 100.0, 2.0 + CAST(n_nationkey % 7 AS DOUBLE) / 10.0 FROM nation"""
           if flat else "") + ")",
        f"""rgs_rg AS (SELECT s.scenario, CAST(n_nationkey AS BIGINT) AS county, g.rg_id,
    CAST(g.rp AS DOUBLE) AS rgs_pop, CAST(g.re AS DOUBLE) AS rgs_emp,
    CAST(g.i + 2 AS DOUBLE) / 100.0 AS gq_pct_target, CAST(g.i + 22 AS DOUBLE) / 10.0 AS pph_target
  FROM nation, (VALUES {RG_ROWS}) g(rg_id, i, rp, re), (VALUES {sc}) s(scenario))""",
        """totals AS (SELECT scenario, 'hhpop' AS indicator, year, hhpop AS total FROM ref
  UNION ALL SELECT scenario, 'hh', year, hh FROM ref UNION ALL SELECT scenario, 'emp', year, emp FROM ref
  UNION ALL SELECT scenario, 'pop', year, pop FROM ref)""",
    ]
    return ctes


def alloc_ctes(annex=False, y1=BASE_Y, y2=TGT_Y) -> list[str]:
    wa = " + annex" if annex else ""
    return [
        f"""delta AS (SELECT scenario,
    sum(CASE WHEN year = {y2} THEN pop END) - sum(CASE WHEN year = {y1} THEN pop END) AS pop,
    sum(CASE WHEN year = {y2} THEN hhpop END) - sum(CASE WHEN year = {y1} THEN hhpop END) AS hhpop,
    sum(CASE WHEN year = {y2} THEN hh END) - sum(CASE WHEN year = {y1} THEN hh END) AS hh,
    sum(CASE WHEN year = {y2} THEN emp END) - sum(CASE WHEN year = {y1} THEN emp END) AS emp
  FROM ref WHERE year IN ({y1}, {y2}) GROUP BY scenario)""",
        """co_growth AS (SELECT r.scenario, r.county, d.pop * r.rgs_pop AS pop, d.emp * r.rgs_emp AS emp
  FROM rgs_county r JOIN delta d ON r.scenario = d.scenario)""",
        """rg_growth AS (SELECT g.scenario, g.county, r.rg_id, g.pop * r.rgs_pop AS pop_gro_rg,
    g.emp * r.rgs_emp AS emp_gro_rg
  FROM co_growth g LEFT JOIN rgs_rg r ON r.scenario = g.scenario AND r.county = g.county)""",
        f"""emp_x AS (SELECT x.scheme, e.city_id, e.county, x.rg_id, e.emp_ref, e.emp_base,
    e.target{wa} + e.cr_add AS w FROM city_emp e JOIN xwalk x ON e.city_id = x.city_id)""",
        f"""emp_s AS (SELECT *, CASE WHEN wsum <> 0 THEN w / wsum END AS share
  FROM (SELECT *, {wsum('w', 'scheme, county, rg_id')} AS wsum FROM emp_x))""",
        """emp_a AS (SELECT g.scenario, e.scheme, e.county, e.rg_id, e.city_id, e.emp_ref, e.emp_base,
    e.share * g.emp_gro_rg AS emp_gro, e.share * g.emp_gro_rg + e.emp_base AS emp_target,
    e.share * g.emp_gro_rg + e.emp_base - e.emp_ref AS emp_long
  FROM emp_s e JOIN rg_growth g ON e.county = g.county AND e.rg_id = g.rg_id)""",
        f"""pop_x AS (SELECT x.scheme, p.city_id, p.county, x.rg_id, p.pop_ref, p.pop_base, p.hhpop_ref,
    p.hhpop_base, p.hh_ref, p.hh_base, p.gq_pct, p.gq_pct_target, p.pph_target, p.pph, p.target{wa} AS w
  FROM city_pop p JOIN xwalk x ON p.city_id = x.city_id)""",
        f"""pop_s AS (SELECT *, CASE WHEN wsum <> 0 THEN w / wsum END AS share
  FROM (SELECT *, {wsum('w', 'scheme, county, rg_id')} AS wsum FROM pop_x))""",
        """pop_a AS (SELECT g.scenario, p.scheme, p.county, p.rg_id, p.city_id, p.pop_ref, p.pop_base, p.hhpop_ref,
    p.hhpop_base, p.hh_ref, p.hh_base, p.gq_pct_target, p.pph_target, p.pph,
    p.share * g.pop_gro_rg AS pop_gro, (p.share * g.pop_gro_rg) * (1 - p.gq_pct) AS hhpop_gro,
    p.share * g.pop_gro_rg + p.pop_base AS pop_target
  FROM pop_s p JOIN rg_growth g ON p.county = g.county AND p.rg_id = g.rg_id)""",
    ]


def rake_ctes() -> list[str]:
    return [
        "city_p AS (SELECT *, pop_target - pop_target * gq_pct_target AS hhpop_p FROM pop_a)",
        f"""rg1 AS (SELECT scenario, scheme, county, rg_id, {ssum('pop_target')} AS pop_target,
    {ssum('hhpop_p')} AS city_p_sum
  FROM city_p GROUP BY scenario, scheme, county, rg_id)""",
        """rg2 AS (SELECT a.*, r.gq_pct_target AS gq, r.pph_target AS pph,
    a.pop_target - a.pop_target * r.gq_pct_target AS hhpop_p
  FROM rg1 a LEFT JOIN rgs_rg r ON a.scenario = r.scenario AND a.county = r.county AND a.rg_id = r.rg_id
  WHERE (a.scenario, a.scheme, a.county, a.rg_id) IN (SELECT scenario, scheme, county, rg_id FROM emp_a))""",
        f"""co1 AS (SELECT scenario, scheme, county, {ssum('pop_target')} AS pop_target FROM rg1
  WHERE (scenario, scheme, county) IN (SELECT scenario, scheme, county FROM emp_a)
  GROUP BY scenario, scheme, county)""",
        """co2 AS (SELECT a.*, c.gq_pct_target AS gq, c.pph_target AS pph,
    a.pop_target - a.pop_target * c.gq_pct_target AS hhpop_p
  FROM co1 a LEFT JOIN rgs_county c ON a.scenario = c.scenario AND a.county = c.county)""",
        f"ctl AS (SELECT scenario, hhpop, hh FROM ref WHERE year = {TGT_Y})",
        f"""co3 AS (SELECT a.*, t.hhpop * (a.hhpop_p / NULLIF({wsum('a.hhpop_p', 'a.scenario, a.scheme')}, 0))
    AS hhpop_target FROM co2 a JOIN ctl t ON a.scenario = t.scenario)""",
        f"""rg3 AS (SELECT a.*, a.hhpop_p / NULLIF({wsum('a.hhpop_p', 'a.scenario, a.scheme, a.county')}, 0)
    * c.hhpop_target AS hhpop_target
  FROM rg2 a JOIN co3 c ON a.scenario = c.scenario AND a.scheme = c.scheme AND a.county = c.county)""",
        """city3 AS (SELECT a.*, a.hhpop_p / NULLIF(r.city_p_sum, 0) * r.hhpop_target AS hhpop_target
  FROM city_p a JOIN rg3 r ON a.scenario = r.scenario AND a.scheme = r.scheme AND a.county = r.county
    AND a.rg_id = r.rg_id)""",
        "co4 AS (SELECT *, CASE WHEN pph <> 0 THEN hhpop_target / pph END AS hh_p FROM co3)",
        f"""co5 AS (SELECT a.*, t.hh * (a.hh_p / NULLIF({wsum('a.hh_p', 'a.scenario, a.scheme')}, 0)) AS hh_target
  FROM co4 a JOIN ctl t ON a.scenario = t.scenario)""",
        "rg4 AS (SELECT *, CASE WHEN pph <> 0 THEN hhpop_target / pph END AS hh_p FROM rg3)",
        f"""rg5 AS (SELECT a.*, a.hh_p / NULLIF({wsum('a.hh_p', 'a.scenario, a.scheme, a.county')}, 0)
    * c.hh_target AS hh_target
  FROM rg4 a JOIN co5 c ON a.scenario = c.scenario AND a.scheme = c.scheme AND a.county = c.county)""",
        f"city4 AS (SELECT *, {ratio0('hhpop_target', 'pph_target')} AS hh_p FROM city3)",
        f"""city5 AS (SELECT a.*, a.hh_p / NULLIF({wsum('a.hh_p', 'a.scenario, a.scheme, a.county, a.rg_id')}, 0)
    * r.hh_target AS hh_target, a.hh_p / NULLIF({wsum('a.hh_p', 'a.scenario, a.scheme, a.county, a.rg_id')}, 0)
    * r.hh_target - a.hh_base AS hh_gro
  FROM city4 a JOIN rg5 r ON a.scenario = r.scenario AND a.scheme = r.scheme AND a.county = r.county
    AND a.rg_id = r.rg_id)""",
    ]


def factor_ctes() -> list[str]:
    return [
        """fp1 AS (SELECT *, hhpop_gro + hhpop_base AS hhpop_target0 FROM pop_a)""",
        """fsum AS (SELECT a.scenario, a.scheme,
    CASE WHEN coalesce(sum(CASE WHEN a.pop_gro - a.hhpop_gro <> 0 THEN a.hhpop_gro END), 0.0) <> 0
      THEN (max(d.hhpop) - coalesce(sum(CASE WHEN a.pop_gro - a.hhpop_gro = 0 THEN a.hhpop_gro END), 0.0))
         / coalesce(sum(CASE WHEN a.pop_gro - a.hhpop_gro <> 0 THEN a.hhpop_gro END), 0.0) END AS hhpop_factor
  FROM fp1 a JOIN delta d ON a.scenario = d.scenario GROUP BY a.scenario, a.scheme)""",
        """fp2 AS (SELECT a.*, f.hhpop_factor,
    a.hhpop_gro * CASE WHEN a.pop_gro - a.hhpop_gro > 0.02 THEN f.hhpop_factor ELSE 1.0 END AS hhpop_gro_c
  FROM fp1 a JOIN fsum f ON a.scenario = f.scenario AND a.scheme = f.scheme)""",
        """fp3 AS (SELECT scenario, scheme, county, rg_id, city_id, pop_ref, pop_base, pop_gro, pop_target,
    hhpop_ref, hhpop_base, hh_ref, hh_base, pph, hhpop_factor, hhpop_gro_c AS hhpop_gro,
    hhpop_gro_c + hhpop_base AS hhpop_target, hhpop_gro_c + hhpop_base - hhpop_ref AS hhpop_long FROM fp2)""",
        """hh_stock AS (SELECT *, CASE WHEN pph <> 0 THEN hhpop_target / pph END AS hh_target,
    CASE WHEN pph <> 0 THEN hhpop_target / pph END - hh_base AS hh_gro FROM fp3)""",
        """hh_growth AS (SELECT *, CASE WHEN pph <> 0 THEN hhpop_gro / pph END + hh_base AS hh_target,
    CASE WHEN pph <> 0 THEN hhpop_gro / pph END AS hh_gro FROM fp3)""",
    ]


def pos_ctl(src: str, name: str) -> str:
    return f"""{name}_f AS (SELECT a.scenario, a.scheme,
    CASE WHEN coalesce(sum(CASE WHEN a.hh_gro > 0 THEN a.hh_gro END), 0.0) <> 0
      THEN max(d.hh) / coalesce(sum(CASE WHEN a.hh_gro > 0 THEN a.hh_gro END), 0.0) END AS hh_factor
  FROM {src} a JOIN delta d ON a.scenario = d.scenario GROUP BY a.scenario, a.scheme),
{name} AS (SELECT a.scenario, a.scheme, a.city_id, f.hh_factor,
    a.hh_gro * CASE WHEN a.hh_gro > 0 THEN f.hh_factor ELSE 1.0 END AS hh_gro,
    a.hh_gro * CASE WHEN a.hh_gro > 0 THEN f.hh_factor ELSE 1.0 END + a.hh_base AS hh_target,
    a.hh_gro * CASE WHEN a.hh_gro > 0 THEN f.hh_factor ELSE 1.0 END + a.hh_base - a.hh_ref AS hh_long
  FROM {src} a JOIN {name}_f f ON a.scenario = f.scenario AND a.scheme = f.scheme)"""


def targets_ctes() -> list[str]:
    return [
        """tg AS (SELECT city_id, county, segment AS rg_id, juris, emp_ref AS emp_by, emp_base,
    emp_end - emp_base AS emp_gro, emp_end AS emp_target, pop_ref AS pop_by, pop_base,
    pop_end - pop_base AS pop_gro, pop_end AS pop_target, hhpop_ref AS hhpop_by, hhpop_base,
    hh_ref AS hh_by, hh_base, gq_pct * 100.0 AS gq_pct_target, pph_target FROM cb)""",
        "tg2 AS (SELECT *, pop_target - pop_target * gq_pct_target / 100 AS hhpop_target FROM tg)",
        f"tg3 AS (SELECT *, {ratio0('hhpop_target', 'pph_target')} AS hh_target FROM tg2)",
        "tg4 AS (SELECT *, hh_target - hh_base AS hh_gro, hhpop_target - hhpop_base AS hhpop_gro FROM tg3)",
    ]


def _vals(years) -> str:
    return ", ".join(f"({y})" for y in years)


def series_ctes(anc: str, years, totals: str | None, adjust: str | None, relabel: dict | None,
                rounding: bool, seed: int | None = None) -> list[str]:
    """Long-form series: anchors ``anc(scenario, scheme, indicator, geo_id, year, value)``.
    With ``seed`` the residuals are drawn, else handed out by largest remainders."""
    K = "scenario, scheme, indicator, geo_id"
    ctes = [
        f"""s_g AS (SELECT {K}, year, {ssum('value')} AS value FROM {anc} GROUP BY {K}, year)""",
        f"""s_n AS (SELECT {K}, count(value) AS n FROM s_g GROUP BY {K})""",
        f"""s_seg AS (SELECT *, lead(year) OVER w AS y1, lead(value) OVER w AS v1 FROM s_g WHERE value IS NOT NULL
  WINDOW w AS (PARTITION BY {K} ORDER BY year))""",
        f"""s_fit AS (SELECT n.scenario, n.scheme, n.indicator, n.geo_id, f.year,
    CASE WHEN n.n >= 2 THEN max(CASE WHEN s.year = f.year THEN s.value
      WHEN s.y1 IS NOT NULL AND s.year < f.year AND f.year < s.y1
        THEN s.value + (s.v1 - s.value) * ((CAST(f.year AS DOUBLE) - s.year) / (s.y1 - s.year)) END) END AS value
  FROM s_n n CROSS JOIN (VALUES {_vals(years)}) f(year)
  LEFT JOIN s_seg s ON s.scenario = n.scenario AND s.scheme = n.scheme AND s.indicator = n.indicator
    AND s.geo_id = n.geo_id
  GROUP BY n.scenario, n.scheme, n.indicator, n.geo_id, f.year, n.n)""",
    ]
    cur = "s_fit"
    if adjust and totals:
        ys = list(years)
        adj = ys[1:-1] if adjust == "interior" else ys[1:]
        ctes += [
            f"""s_dif AS (SELECT *, value - lag(value) OVER (PARTITION BY {K} ORDER BY year) AS dif FROM s_fit)""",
            f"""s_sum AS (SELECT scenario, scheme, indicator, year, {ssum('value')} AS s, {ssum('dif')} AS d
  FROM s_dif GROUP BY scenario, scheme, indicator, year)""",
            f"""s_adj AS (SELECT a.scenario, a.scheme, a.indicator, a.geo_id, a.year,
    CASE WHEN a.year IN ({", ".join(map(str, adj))}) AND t.total IS NOT NULL AND t.total - s.s <> 0 THEN
      CASE WHEN a.value + (CASE WHEN s.d <> 0 THEN a.dif / s.d END) * (t.total - s.s) IS NULL THEN NULL
        ELSE greatest(0.0{D}, a.value + (CASE WHEN s.d <> 0 THEN a.dif / s.d END) * (t.total - s.s)) END
    ELSE a.value END AS value
  FROM s_dif a JOIN s_sum s ON a.scenario = s.scenario AND a.scheme = s.scheme AND a.indicator = s.indicator
    AND a.year = s.year
  LEFT JOIN {totals} t ON t.scenario = a.scenario AND t.indicator = a.indicator AND t.year = a.year)""",
        ]
        cur = "s_adj"
    if relabel:
        case = " ".join(f"WHEN year = {a} THEN {b}" for a, b in relabel.items())
        ctes.append(f"s_rel AS (SELECT {K}, CAST(CASE {case} ELSE year END AS INTEGER) AS year, value FROM {cur})")
        cur = "s_rel"
    if rounding:
        ctes.append(f"s_r AS (SELECT {K}, year, round_even(value, 0) AS value FROM {cur})")
        cur = "s_r"
        if totals:
            ctes += [
                """s_w AS (SELECT *, CASE WHEN value > 0 THEN value ELSE 0.0 END AS wt FROM s_r)""",
                f"""s_gt AS (SELECT g.scenario, g.scheme, g.indicator, g.year, round_even(t.total, 0) - g.rsum AS d,
    g.wtot FROM (SELECT scenario, scheme, indicator, year, sum(value) AS rsum, sum(wt) AS wtot FROM s_w
      GROUP BY scenario, scheme, indicator, year) g
  JOIN {totals} t ON t.scenario = g.scenario AND t.indicator = g.indicator AND t.year = g.year)""",
                """s_q AS (SELECT w.*, g.d, (g.d IS NOT NULL AND g.d <> 0 AND g.wtot > 0) AS need,
    CASE WHEN g.d IS NOT NULL AND g.d <> 0 AND g.wtot > 0 THEN abs(g.d) * w.wt / g.wtot END AS quota
  FROM s_w w LEFT JOIN s_gt g ON w.scenario = g.scenario AND w.scheme = g.scheme AND w.indicator = g.indicator
    AND w.year = g.year)""",
                f"""s_rk AS (SELECT *, floor(quota) AS b,
    row_number() OVER (PARTITION BY scenario, scheme, indicator, year
      ORDER BY CAST(quota - floor(quota) AS DECIMAL(38, 10)) DESC NULLS LAST, geo_id) AS rnk,
    sum(floor(quota)) OVER (PARTITION BY scenario, scheme, indicator, year) AS bsum FROM s_q)""",
                f"""s_h4 AS (SELECT {K}, year, CASE WHEN need THEN value + sign(d) * (b + CASE WHEN rnk <= abs(d) - bsum
    THEN 1.0 ELSE 0.0 END) ELSE value END AS value FROM s_rk)""",
            ]
            cur = "s_h4"
        if totals and seed is not None:
            own = "scenario, scheme, indicator, year"
            on = " AND ".join(f"g.{k} = x.{k}" for k in own.split(", "))
            ctes += [
                f"""s_lo AS (SELECT {K}, year, sum(wt) OVER (PARTITION BY {own} ORDER BY geo_id) - wt AS lo FROM s_q WHERE need AND wt > 0)""",
                f"""s_dr AS (SELECT {own}, CAST(floor(CAST(('0x' || substr(md5(concat_ws('|', {seed}, {own}, n)), 1, 13)) AS BIGINT) / 4503599627370496.0{D} * wtot) AS DOUBLE) AS x
  FROM (SELECT *, unnest(range(1, CAST(abs(d) AS BIGINT) + 1)) AS n FROM s_gt WHERE d <> 0 AND wtot > 0))""",
                f"""s_hit AS (SELECT {", ".join(f"x.{k}" for k in own.split(", "))}, g.geo_id, count(*) AS hits
  FROM s_dr x ASOF JOIN s_lo g ON {on} AND x.x >= g.lo GROUP BY ALL)""",
                f"""s_h4b AS (SELECT g.scenario, g.scheme, g.indicator, g.geo_id, g.year,
    CASE WHEN g.need THEN g.value + sign(g.d) * coalesce(x.hits, 0) ELSE g.value END AS value
  FROM s_q g LEFT JOIN s_hit x ON {on} AND g.geo_id = x.geo_id)""",
            ]
            cur = "s_h4b"
    ctes.append(f"s_out AS (SELECT * FROM {cur})")
    return ctes


def assemble_sql(src: str, indicators, how: str, geo: str) -> str:
    cols = ", ".join(f"round(max(CASE WHEN indicator = '{i}' THEN value END), 6) AS total_{i}" for i in indicators)
    having = f" HAVING count(DISTINCT indicator) = {len(indicators)}" if how == "inner" else ""
    return (f"SELECT scenario, scheme, geo_id AS {geo}, year, {cols} FROM {src} "
            f"WHERE indicator IN ({', '.join(repr(i) for i in indicators)}) "
            f"GROUP BY scenario, scheme, geo_id, year{having}")


def with_(ctes, final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


def hier_anchor_cte() -> str:
    return f"""anc AS (
  SELECT scenario, scheme, 'hhpop' AS indicator, city_id AS geo_id, {BASE_Y} AS year, hhpop_base AS value FROM city5
  UNION ALL SELECT scenario, scheme, 'hhpop', city_id, {TGT_Y}, hhpop_target FROM city5
  UNION ALL SELECT scenario, scheme, 'hh', city_id, {BASE_Y}, hh_base FROM city5
  UNION ALL SELECT scenario, scheme, 'hh', city_id, {TGT_Y}, hh_target FROM city5
  UNION ALL SELECT scenario, scheme, 'emp', city_id, {BASE_Y}, emp_base FROM emp_a
  UNION ALL SELECT scenario, scheme, 'emp', city_id, {TGT_Y}, emp_target FROM emp_a)"""


def targets_anchor_cte() -> str:
    parts = []
    for ind in ("hhpop", "hh", "emp", "pop"):
        for y, c in ((REF_Y, f"{ind}_by"), (BASE_Y, f"{ind}_base"), (TGT_Y, f"{ind}_target")):
            parts.append(f"SELECT 'base' AS scenario, 'existing' AS scheme, '{ind}' AS indicator, city_id AS geo_id, "
                         f"{y} AS year, {c} AS value FROM tg4")
    return "anc AS (" + "\n  UNION ALL ".join(parts) + ")"


def tgt_totals_cte() -> str:
    return f"tt AS (SELECT * FROM totals WHERE year > {BASE_Y})"


SERIES_OUT = "SELECT scenario, scheme, indicator, geo_id AS city_id, year, round(value, 6) AS value FROM s_out"


def part_ctes() -> list[str]:
    meas = {"pop": "l_extendedprice / 100.0", "hhpop": "l_extendedprice * (1 - l_discount) / 100.0",
            "hh": "l_quantity", "emp": f"10.0{D}"}
    per = ",\n    ".join(f"sum(CASE WHEN yr = {y} THEN {e} END) AS {m}_{y}" for m, e in meas.items()
                         for y in (REF_Y, BASE_Y, TGT_Y))
    anc = "\n  UNION ALL ".join(
        f"SELECT 'base' AS scenario, 'part' AS scheme, '{m}' AS indicator, p_partkey AS geo_id, {y} AS year, "
        f"coalesce({m}_{y}, 0.0{D}) AS value FROM parts" for m in meas for y in (REF_Y, BASE_Y, TGT_Y))
    tot = "\n  UNION ALL ".join(f"SELECT 'base' AS scenario, '{m}' AS indicator, yr AS year, sum({e}) AS total "
                                f"FROM li WHERE yr > {BASE_Y} GROUP BY yr" for m, e in meas.items())
    return [
        """li AS (SELECT l_partkey, CAST(year(l_shipdate) AS INTEGER) AS yr, l_extendedprice, l_discount,
    l_quantity FROM lineitem)""",
        f"per AS (SELECT l_partkey,\n    {per}\n  FROM li WHERE yr IN ({REF_Y}, {BASE_Y}, {TGT_Y}) GROUP BY l_partkey)",
        "parts AS (SELECT p_partkey, per.* FROM part LEFT JOIN per ON p_partkey = per.l_partkey)",
        f"anc AS ({anc})",
        f"ptot AS ({tot})",
    ]


def oracle_sql() -> dict:
    q = {}
    b = base_ctes()
    b2 = base_ctes(schemes=("existing", "proposed"))
    bsc = base_ctes(scenarios=("base", "flat"))
    al = alloc_ctes()

    q["q01_share_within"] = with_(b2 + [
        """es AS (SELECT scheme, city_id, county, rg_id, CASE WHEN wsum <> 0 THEN w / wsum END AS emp_share
  FROM (SELECT x.scheme, e.city_id, e.county, x.rg_id, e.target + e.cr_add AS w,
    sum(e.target + e.cr_add) OVER (PARTITION BY x.scheme, e.county, x.rg_id) AS wsum
    FROM city_emp e JOIN xwalk x ON e.city_id = x.city_id))""",
        """ps AS (SELECT scheme, city_id, CASE WHEN wsum <> 0 THEN w / wsum END AS pop_share
  FROM (SELECT x.scheme, p.city_id, p.target AS w,
    sum(p.target) OVER (PARTITION BY x.scheme, p.county, x.rg_id) AS wsum
    FROM city_pop p JOIN xwalk x ON p.city_id = x.city_id))"""],
        f"SELECT es.scheme, es.city_id, es.county, es.rg_id, {r6('es.emp_share', 'emp_share')}, "
        f"{r6('ps.pop_share', 'pop_share')} FROM es JOIN ps ON es.scheme = ps.scheme AND es.city_id = ps.city_id")

    pairs = []
    for y1, y2 in ((BASE_Y, TGT_Y), (REF_Y, TGT_Y)):
        cols = ", ".join(f"round(sum(CASE WHEN year = {y2} THEN {m} END) - sum(CASE WHEN year = {y1} THEN {m} END), 6)"
                         f" AS {m}" for m in ("pop", "hhpop", "hh", "emp"))
        pairs.append(f"SELECT {y1} AS from_year, {y2} AS to_year, scenario, {cols} FROM ref "
                     f"WHERE year IN ({y1}, {y2}) GROUP BY scenario")
    q["q02_period_delta"] = with_(b, " UNION ALL ".join(pairs))

    q["q03_apportion"] = with_(bsc + alloc_ctes(),
                               "SELECT scenario, county, rg_id, round(pop_gro_rg, 6) AS pop_gro_rg, "
                               "round(emp_gro_rg, 6) AS emp_gro_rg FROM rg_growth")

    q["q04_attach_group"] = with_(b2, "SELECT x.scheme, p.city_id, p.county, x.rg_id, round(p.pop_base, 6) AS pop_base, "
                                      "round(p.target, 6) AS target FROM city_pop p JOIN xwalk x ON p.city_id = x.city_id")

    q["q05_allocate_project"] = with_(b + al,
        "SELECT e.scenario, e.scheme, e.county, e.rg_id, e.city_id, round(e.emp_gro, 6) AS emp_gro, "
        "round(e.emp_target, 6) AS emp_target, round(e.emp_long, 6) AS emp_long, round(p.pop_gro, 6) AS pop_gro, "
        "round(p.pop_target, 6) AS pop_target, round(p.pop_target - p.pop_ref, 6) AS pop_long, "
        "round(p.hhpop_gro, 6) AS hhpop_gro, round(p.pop_gro - p.hhpop_gro, 6) AS no_gq "
        "FROM emp_a e JOIN pop_a p ON e.scenario = p.scenario AND e.scheme = p.scheme AND e.county = p.county "
        "AND e.rg_id = p.rg_id AND e.city_id = p.city_id")

    lv = [
        f"""g_rg AS (SELECT e.scenario, e.scheme, e.county, e.rg_id, e.emp_base, e.emp_target, p.pop_base, p.pop_target
  FROM (SELECT scenario, scheme, county, rg_id, {ssum('emp_base')} AS emp_base, {ssum('emp_target')} AS emp_target
        FROM emp_a GROUP BY scenario, scheme, county, rg_id) e
  JOIN (SELECT scenario, scheme, county, rg_id, {ssum('pop_base')} AS pop_base, {ssum('pop_target')} AS pop_target
        FROM pop_a GROUP BY scenario, scheme, county, rg_id) p
  ON e.scenario = p.scenario AND e.scheme = p.scheme AND e.county = p.county AND e.rg_id = p.rg_id)""",
        f"""g_co AS (SELECT e.scenario, e.scheme, e.county, e.emp_base, e.emp_target, p.pop_base, p.pop_target
  FROM (SELECT scenario, scheme, county, {ssum('emp_base')} AS emp_base, {ssum('emp_target')} AS emp_target
        FROM emp_a GROUP BY scenario, scheme, county) e
  JOIN (SELECT scenario, scheme, county, {ssum('pop_base')} AS pop_base, {ssum('pop_target')} AS pop_target
        FROM pop_a GROUP BY scenario, scheme, county) p
  ON e.scenario = p.scenario AND e.scheme = p.scheme AND e.county = p.county)"""]
    m4 = ", ".join(r6(c) for c in ("emp_base", "emp_target", "pop_base", "pop_target"))
    q["q06_aggregate_levels"] = with_(b + al + lv,
        f"SELECT scenario, scheme, 'rg' AS level, county, rg_id, {m4} FROM g_rg UNION ALL "
        f"SELECT scenario, scheme, 'county', county, CAST(NULL AS VARCHAR), {m4} FROM g_co")

    q["q07_group_quarters"] = with_(b + al + lv,
        "SELECT scenario, scheme, 'city' AS level, county, rg_id, CAST(city_id AS VARCHAR) AS city_id, round(pop_target, 6) AS pop_target, "
        "round(pop_target - pop_target * gq_pct_target, 6) AS hhpop_p FROM pop_a UNION ALL "
        "SELECT g.scenario, g.scheme, 'rg', g.county, g.rg_id, CAST(NULL AS VARCHAR), round(g.pop_target, 6), "
        "round(g.pop_target - g.pop_target * r.gq_pct_target, 6) FROM g_rg g LEFT JOIN rgs_rg r "
        "ON g.scenario = r.scenario AND g.county = r.county AND g.rg_id = r.rg_id UNION ALL "
        "SELECT g.scenario, g.scheme, 'county', g.county, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), "
        "round(g.pop_target, 6), round(g.pop_target - g.pop_target * c.gq_pct_target, 6) FROM g_co g "
        "LEFT JOIN rgs_county c ON g.scenario = c.scenario AND g.county = c.county")

    rk = b + al + rake_ctes()
    q["q08_rake_top"] = with_(rk, "SELECT scenario, scheme, county, round(hhpop_p, 6) AS hhpop_p, "
                                  "round(hhpop_target, 6) AS hhpop_target FROM co3")
    q["q09_rake_children"] = with_(rk, "SELECT scenario, scheme, county, rg_id, round(hhpop_p, 6) AS hhpop_p, "
                                       "round(hhpop_target, 6) AS hhpop_target FROM rg3")
    q["q10_households"] = with_(rk,
        "SELECT scenario, scheme, 'city' AS level, county, rg_id, CAST(city_id AS VARCHAR) AS city_id, round(hh_p, 6) AS hh_p, "
        "round(hh_target, 6) AS hh_target FROM city5 UNION ALL "
        "SELECT scenario, scheme, 'rg', county, rg_id, CAST(NULL AS VARCHAR), round(hh_p, 6), round(hh_target, 6) "
        "FROM rg5 UNION ALL SELECT scenario, scheme, 'county', county, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), "
        "round(hh_p, 6), round(hh_target, 6) FROM co5")
    tg = b + targets_ctes()
    q["q11_targets_end_points"] = with_(tg,
        "SELECT city_id, county, rg_id, round(pop_target, 6) AS pop_target, round(hhpop_target, 6) AS hhpop_target, "
        "round(hh_target, 6) AS hh_target, round(hhpop_gro, 6) AS hhpop_gro, round(hh_gro, 6) AS hh_gro FROM tg4")
    q["q12_hierarchical_rake"] = with_(rk,
        "SELECT scenario, scheme, county, rg_id, city_id, round(pop_target, 6) AS pop_target, "
        "round(hhpop_gro, 6) AS hhpop_gro, round(hhpop_target, 6) AS hhpop_target, "
        "round(hh_target, 6) AS hh_target, round(hh_gro, 6) AS hh_gro FROM city5")

    bf = base_ctes(annex=True)
    fc = bf + alloc_ctes(annex=True) + factor_ctes()
    q["q13_tolerance_control"] = with_(fc,
        "SELECT scenario, scheme, city_id, round(hhpop_factor, 6) AS hhpop_factor, round(hhpop_gro, 6) AS hhpop_gro, "
        "round(hhpop_target, 6) AS hhpop_target, round(hhpop_long, 6) AS hhpop_long FROM fp3")
    q["q14_households_stock"] = with_(fc, "SELECT scenario, scheme, city_id, round(hh_gro, 6) AS hh_gro, "
                                          "round(hh_target, 6) AS hh_target FROM hh_stock")
    q["q15_households_growth"] = with_(fc, "SELECT scenario, scheme, city_id, round(hh_gro, 6) AS hh_gro, "
                                           "round(hh_target, 6) AS hh_target FROM hh_growth")
    cols16 = ("scenario, scheme, city_id, round(hh_factor, 6) AS hh_factor, round(hh_gro, 6) AS hh_gro, "
              "round(hh_target, 6) AS hh_target, round(hh_long, 6) AS hh_long")
    q["q16_positive_growth_control"] = with_(fc + [pos_ctl("hh_stock", "pc_stock"), pos_ctl("hh_growth", "pc_growth")],
        f"SELECT 'stock' AS variant, {cols16} FROM pc_stock UNION ALL SELECT 'growth', {cols16} FROM pc_growth")

    b_nt = b  # totals unused by the report queries
    names = "nm AS (SELECT city_id, juris FROM cb)"
    summ = f"""SELECT p.scenario, p.scheme, p.county, p.rg_id, {r6('p.pop_long', 'pop_long')}, {r6('p.pop_gro', 'pop_gro')},
    {r6('p.pop_end', 'pop_end')}, {r6('p.hh_long', 'hh_long')}, {r6('p.hh_gro', 'hh_gro')}, {r6('p.hh_end', 'hh_end')},
    {r6('e.emp_long', 'emp_long')}, {r6('e.emp_gro', 'emp_gro')}, {r6('e.emp_end', 'emp_end')}
  FROM (SELECT scenario, scheme, county, rg_id, {ssum('pop_target - pop_ref')} AS pop_long,
      {ssum('pop_target - pop_base')} AS pop_gro, {ssum('pop_target')} AS pop_end,
      {ssum('hh_target - hh_ref')} AS hh_long, {ssum('hh_target - hh_base')} AS hh_gro, {ssum('hh_target')} AS hh_end
      FROM city5 GROUP BY scenario, scheme, county, rg_id) p
  JOIN (SELECT scenario, scheme, county, rg_id, {ssum('emp_target - emp_ref')} AS emp_long,
      {ssum('emp_target - emp_base')} AS emp_gro, {ssum('emp_target')} AS emp_end FROM emp_a
      GROUP BY scenario, scheme, county, rg_id) e
  ON p.scenario = e.scenario AND p.scheme = e.scheme AND p.county = e.county AND p.rg_id = e.rg_id"""
    q["q17_group_summary"] = with_(b_nt + al + rake_ctes(), summ)
    lead = "c.scenario, c.scheme, c.rg_id, c.county, c.city_id, n.juris"
    q["q17a_city_people"] = with_(b_nt + al + rake_ctes() + [names],
        f"SELECT {lead}, " + ", ".join(r6(f"c.{x}", x) for x in (
            "pop_ref", "pop_base", "pop_gro", "pop_target", "hhpop_base", "hhpop_gro", "hhpop_target"))
        + " FROM city5 c LEFT JOIN nm n ON c.city_id = n.city_id")
    q["q17b_city_households"] = with_(b_nt + al + rake_ctes() + [names],
        f"SELECT {lead}, " + ", ".join(r6(f"c.{x}", x) for x in ("hh_ref", "hh_base", "hh_gro", "hh_target"))
        + " FROM city5 c LEFT JOIN nm n ON c.city_id = n.city_id")
    q["q17c_city_jobs"] = with_(b_nt + al + [names],
        f"SELECT {lead}, " + ", ".join(r6(f"c.{x}", x) for x in ("emp_ref", "emp_base", "emp_gro", "emp_target"))
        + " FROM emp_a c LEFT JOIN nm n ON c.city_id = n.city_id")

    ha = rk + [hier_anchor_cte()]
    ta = tg + [targets_anchor_cte(), tgt_totals_cte()]
    q["q18_interpolate_two_point"] = with_(ha + series_ctes("anc", HIER_YEARS, None, None, None, False), SERIES_OUT)
    q["q19_interpolate_anchors"] = with_(ta + series_ctes("anc", TGT_YEARS, None, None, None, False), SERIES_OUT)
    q["q20_adjust_interior"] = with_(ha + series_ctes("anc", HIER_YEARS, "totals", "interior", None, False),
                                     SERIES_OUT)
    q["q21_adjust_after_first"] = with_(ta + series_ctes("anc", TGT_YEARS, "tt", "after_first", None, False),
                                        SERIES_OUT)
    q["q22_round_to_total"] = with_(ha + series_ctes("anc", HIER_YEARS, "totals", "interior", None, True),
                                    SERIES_OUT)
    q["q23_seeded_draw"] = with_(ha + series_ctes("anc", HIER_YEARS, "totals", "interior", {BASE_Y: BASE_Y + 1}, True, seed=42),
                                 SERIES_OUT)
    q["q24_unroll"] = with_(ha + series_ctes("anc", HIER_YEARS, "totals", "interior", {BASE_Y: BASE_Y + 1}, True),
                            SERIES_OUT)
    q["q25_assemble_inner"] = with_(ha + series_ctes("anc", HIER_YEARS, "totals", "interior",
                                                     {BASE_Y: BASE_Y + 1}, True),
                                    assemble_sql("s_out", ("hhpop", "hh", "emp"), "inner", "city_id"))
    q["q26_assemble_outer"] = with_(ta + series_ctes("anc", TGT_YEARS, "tt", "after_first", None, True),
                                    assemble_sql("s_out", ("hhpop", "hh", "emp", "pop"), "outer", "subreg_id"))
    pa = b + part_ctes() + series_ctes("anc", ANNUAL, "ptot", "after_first", None, True)
    q["q27_annual_series"] = with_(pa, assemble_sql("s_out", ("hhpop", "hh", "emp", "pop"), "outer", "subreg_id"))
    q["q28_regional_rollup"] = with_(pa + ["asm AS (" + assemble_sql("s_out", ("hhpop", "hh", "emp", "pop"), "outer",
                                                                     "subreg_id") + ")"],
        "SELECT scenario, scheme, year, " + ", ".join(
            f"round({ssum(f'total_{i}')}, 6) AS total_{i}" for i in ("hhpop", "hh", "emp", "pop"))
        + " FROM asm GROUP BY scenario, scheme, year")
    q["q29_forecast_normalise"] = with_(b, "SELECT year, round(pop, 6) AS pop, round(hhpop, 6) AS hhpop, "
                                           "round(hh, 6) AS hh, round(emp, 6) AS emp FROM ref "
                                           "WHERE scenario = 'base' AND year IN (1998, 1999, 2000)")
    q["q17d_targets_summary"] = with_(tg, "SELECT 'base' AS scenario, 'existing' AS scheme, county, rg_id, " + ", ".join(
        f"round({ssum(e)}, 6) AS {a}" for e, a in (
            ("pop_target - pop_base", "pop_delta"), ("pop_target", "pop_end"), ("hh_target - hh_base", "hh_delta"),
            ("hh_target", "hh_end"), ("emp_target - emp_base", "emp_delta"), ("emp_target", "emp_end")))
        + " FROM tg4 GROUP BY county, rg_id")
    fanc = f"""anc AS (
  SELECT scenario, scheme, 'hhpop' AS indicator, city_id AS geo_id, {BASE_Y} AS year, hhpop_base AS value FROM fp3
  UNION ALL SELECT scenario, scheme, 'hhpop', city_id, {TGT_Y}, hhpop_target FROM fp3
  UNION ALL SELECT scenario, scheme, 'hh', city_id, {BASE_Y}, hh_base FROM hh_stock
  UNION ALL SELECT scenario, scheme, 'hh', city_id, {TGT_Y}, hh_target FROM pc_stock
  UNION ALL SELECT scenario, scheme, 'emp', city_id, {BASE_Y}, emp_base FROM emp_a
  UNION ALL SELECT scenario, scheme, 'emp', city_id, {TGT_Y}, emp_target FROM emp_a)"""
    q["q32_factor_unrolled"] = with_(fc + [pos_ctl("hh_stock", "pc_stock"), fanc]
                                     + series_ctes("anc", HIER_YEARS, "totals", "interior", {BASE_Y: BASE_Y + 1}, True),
                                     assemble_sql("s_out", ("hhpop", "hh", "emp"), "inner", "city_id"))
    many = base_ctes(scenarios=("base", "flat")) + targets_ctes() + [targets_anchor_cte(), tgt_totals_cte(),
        """anc4 AS (SELECT s.scenario, m.scheme, a.* EXCLUDE (scenario, scheme) FROM anc a,
  (VALUES ('base'), ('flat')) s(scenario), (VALUES ('existing'), ('proposed')) m(scheme))"""]
    q["q33_targets_scenarios"] = with_(many + series_ctes("anc4", TGT_YEARS, "tt", "after_first", None, True),
                                       assemble_sql("s_out", ("hhpop", "hh", "emp", "pop"), "outer", "subreg_id"))
    grown = ", ".join(f"round({ssum(f'{t}.{m}_target - {'p' if m == 'hh' else t}.{m}_{r}')}, 6) AS {m}_{k}" for t, m in (("p", "pop"), ("h", "hh"), ("e", "emp"))
                      for r, k in (("ref", "long"), ("base", "gro")))
    ends = ", ".join(f"round({ssum(f'{t}.{m}_target')}, 6) AS {m}_end" for t, m in (("p", "pop"), ("h", "hh"), ("e", "emp")))
    on = lambda t: f"ON p.scenario = {t}.scenario AND p.scheme = {t}.scheme AND p.city_id = {t}.city_id"
    q["q34_factor_growth_summary"] = with_(fc + [pos_ctl("hh_growth", "pc_growth")],
        f"SELECT p.scenario, p.scheme, p.county, p.rg_id, {grown}, {ends} FROM fp3 p JOIN emp_a e {on('e')} "
        f"JOIN pc_growth h {on('h')} GROUP BY p.scenario, p.scheme, p.county, p.rg_id")
    lead = "'base' AS scenario, 'existing' AS scheme, rg_id, county, city_id, juris"
    for name, ms in (("q35_targets_people", ("pop", "hhpop")), ("q36_targets_households", ("hh",)), ("q37_targets_jobs", ("emp",))):
        q[name] = with_(tg, f"SELECT {lead}, " + ", ".join(f"round({m}_{r}, 6) AS {m}_{r}" for m in ms for r in ("by", "base", "gro", "target")) + " FROM tg4")
    q["q38_targets_schemes"] = with_(b2 + targets_ctes(), "SELECT 'base' AS scenario, x.scheme, t.county, x.rg_id, " + ", ".join(
        f"round({ssum(e)}, 6) AS {k}" for e, k in (
            ("pop_target - pop_base", "pop_delta"), ("pop_target", "pop_end"), ("hh_target - hh_base", "hh_delta"),
            ("hh_target", "hh_end"), ("emp_target - emp_base", "emp_delta"), ("emp_target", "emp_end")))
        + " FROM tg4 t JOIN xwalk x ON t.city_id = x.city_id GROUP BY x.scheme, t.county, x.rg_id")
    ANCHORS = {"base": (1995, 1996, 2000), "late": (1994, 1997, 1998)}
    q["q39_anchor_rows"] = " UNION ALL ".join("SELECT * FROM (" + with_([f"""anc AS (
  SELECT '{s}' AS scenario, 'existing' AS scheme, 'pop' AS indicator, o_custkey AS geo_id, CAST(year(o_orderdate) AS INTEGER) AS year,
    sum(o_totalprice) / 100.0 AS value FROM orders WHERE year(o_orderdate) IN ({', '.join(map(str, ys))}) GROUP BY ALL)"""]
        + series_ctes("anc", tuple(range(min(ys) - 1, max(ys) + 1)), None, None, None, False), SERIES_OUT) + ")" for s, ys in ANCHORS.items())
    q["q40_series_without_totals"] = with_(ha + series_ctes("anc", HIER_YEARS, None, None, {BASE_Y: BASE_Y + 1}, True),
                                           assemble_sql("s_out", ("hhpop", "hh", "emp"), "inner", "city_id"))
    q["q41_factor_people"] = with_(fc + [names], "SELECT c.scenario, c.scheme, c.rg_id, c.county, c.city_id, n.juris, " + ", ".join(
        r6(f"c.{x}", x) for x in ("pop_ref", "pop_base", "pop_gro", "pop_target", "hhpop_ref", "hhpop_base", "hhpop_gro", "hhpop_target"))
        + " FROM fp3 c JOIN nm n ON c.city_id = n.city_id")
    one = lambda m, src: (f"(SELECT scenario, scheme, county, rg_id, {ssum(f'{m}_target - {m}_ref')} AS {m}_long, {ssum(f'{m}_target - {m}_base')} AS {m}_gro, "  # noqa: E731
                          f"{ssum(f'{m}_target')} AS {m}_end FROM {src} GROUP BY scenario, scheme, county, rg_id)")
    stock = "(SELECT h.scenario, h.scheme, p.county, p.rg_id, h.hh_target, p.hh_ref, p.hh_base FROM pc_stock h JOIN fp3 p ON h.scenario = p.scenario AND h.scheme = p.scheme AND h.city_id = p.city_id)"
    q["q42_factor_stock_summary"] = with_(fc + [pos_ctl("hh_stock", "pc_stock")], "SELECT scenario, scheme, county, rg_id, " + ", ".join(
        r6(f"{m}_{k}") for m in ("pop", "hh", "emp") for k in ("long", "gro", "end"))
        + f" FROM {one('pop', 'fp3')} JOIN {one('hh', stock)} USING (scenario, scheme, county, rg_id) JOIN {one('emp', 'emp_a')} USING (scenario, scheme, county, rg_id)")
    ganc = fanc.replace("hh_stock", "hh_growth").replace("pc_stock", "pc_growth")
    q["q43_factor_growth_unrolled"] = with_(fc + [pos_ctl("hh_growth", "pc_growth"), ganc]
                                            + series_ctes("anc", HIER_YEARS, "totals", "interior", {BASE_Y: BASE_Y + 1}, True),
                                            assemble_sql("s_out", ("hhpop", "hh", "emp"), "inner", "city_id"))
    b22 = base_ctes(scenarios=("base", "flat"), schemes=("existing", "proposed"))
    q["q30_scenarios"] = with_(b22 + al + rake_ctes() + [hier_anchor_cte()]
                               + series_ctes("anc", HIER_YEARS, "totals", "interior", {BASE_Y: BASE_Y + 1}, True),
                               assemble_sql("s_out", ("hhpop", "hh", "emp"), "inner", "city_id"))
    gf = [
        f"""obs AS (SELECT x.scheme, p.county, x.rg_id, {ssum('p.pop_base - p.pop_ref')} AS observed
  FROM city_pop p JOIN xwalk x ON p.city_id = x.city_id GROUP BY x.scheme, p.county, x.rg_id)""",
        """j AS (SELECT g.scenario, o.scheme, g.county, g.rg_id, g.pop_gro_rg AS plan, o.observed,
    g.pop_gro_rg - o.observed AS rem FROM rg_growth g JOIN obs o ON g.county = o.county AND g.rg_id = o.rg_id)""",
        f"""c AS (SELECT scenario, scheme, county, {ssum('plan')} AS plan_sum, sum(CASE WHEN rem < 0 THEN rem END) AS deficit,
    max(CASE WHEN rem < 0 THEN 1 END) AS anyshort FROM j GROUP BY scenario, scheme, county)""",
        """s AS (SELECT j.*, c.deficit, c.anyshort, CASE WHEN j.rem < 0 THEN 0.0 ELSE
    CASE WHEN c.plan_sum <> 0 THEN j.plan / c.plan_sum END END AS share
  FROM j JOIN c ON j.scenario = c.scenario AND j.scheme = c.scheme AND j.county = c.county)""",
        f"s2 AS (SELECT *, {wsum('share', 'scenario, scheme, county')} AS share_sum FROM s)",
    ]
    q["q31_growth_floor"] = with_(base_ctes() + alloc_ctes(y1=REF_Y) + gf, """SELECT scenario, scheme, county, rg_id,
  round(plan, 6) AS plan, round(observed, 6) AS observed,
  round((plan - CASE WHEN anyshort IS NULL THEN 0.0 WHEN rem < 0 THEN rem
    ELSE -deficit * (CASE WHEN share_sum <> 0 THEN share / share_sum END) END) - observed, 6) AS pop_gro_rg
FROM s2""")
    return {k: nz(v) for k, v in q.items()}
