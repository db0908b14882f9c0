"""Reusable SQL fragments of the oracle queries (brute-force formulations)."""

from __future__ import annotations

import math

K3S = "code_module, code_presentation, id_student"
TRAIN_IN = "('2013B', '2013J', '2014B')"


def regularity_ctes(src: str, start: int, end: int, p: str = "r") -> str:
    """CTEs ``{p}_all`` (K3 + pwd, ws1, ws2, ws3, fwd) from a click CTE ``src`` (K3, date, sum_click).

    Week similarities are computed over explicit pairs of active weeks (a self-join), the
    brute-force form of the same definitions.
    """
    n_days = end - start + 1
    return f"""
{p}_daily AS (SELECT {K3S}, date, sum(sum_click) AS w FROM {src} GROUP BY {K3S}, date),
{p}_stu AS (SELECT DISTINCT {K3S} FROM {p}_daily),
{p}_win AS (SELECT {K3S}, date - {start} AS t, CAST(w AS DOUBLE) AS w FROM {p}_daily
  WHERE date BETWEEN {start} AND {end}),
{p}_tot AS (SELECT {K3S}, count(*) AS n FROM {p}_win GROUP BY {K3S}),
{p}_wd AS (SELECT {K3S}, t % 7 AS d, count(*) AS c FROM {p}_win GROUP BY {K3S}, t % 7),
{p}_pwd AS (SELECT wd.code_module, wd.code_presentation, wd.id_student,
  (ln(7) + sum((CAST(c AS DOUBLE) / n) * ln(CAST(c AS DOUBLE) / n))) * max(c) AS pwd
  FROM {p}_wd wd JOIN {p}_tot tt USING ({K3S}) GROUP BY wd.code_module, wd.code_presentation, wd.id_student),
{p}_fwd AS (SELECT {K3S}, (pow(sum(cos(2 * pi() * t / 7)), 2) + pow(sum(sin(2 * pi() * t / 7)), 2))
  / CAST({n_days} AS DOUBLE) AS fwd FROM {p}_win GROUP BY {K3S}),
{p}_wv AS (SELECT {K3S}, t // 7 AS wk, t % 7 AS d, w FROM {p}_win),
{p}_wk AS (SELECT {K3S}, wk, count(*) AS n_act, sum(w) AS tot FROM {p}_wv GROUP BY {K3S}, wk),
{p}_pairs AS (SELECT a.code_module, a.code_presentation, a.id_student, a.wk AS w1, b.wk AS w2,
  a.n_act AS n1, b.n_act AS n2, a.tot AS t1, b.tot AS t2
  FROM {p}_wk a JOIN {p}_wk b ON a.code_module = b.code_module AND a.code_presentation = b.code_presentation
  AND a.id_student = b.id_student AND a.wk < b.wk),
{p}_grid AS (SELECT pr.*, dd.d,
  COALESCE(x.w, 0) AS v1, COALESCE(y.w, 0) AS v2
  FROM {p}_pairs pr CROSS JOIN (SELECT range AS d FROM range(7)) dd
  LEFT JOIN {p}_wv x ON x.code_module = pr.code_module AND x.code_presentation = pr.code_presentation
   AND x.id_student = pr.id_student AND x.wk = pr.w1 AND x.d = dd.d
  LEFT JOIN {p}_wv y ON y.code_module = pr.code_module AND y.code_presentation = pr.code_presentation
   AND y.id_student = pr.id_student AND y.wk = pr.w2 AND y.d = dd.d),
{p}_pairterm AS (SELECT {K3S}, w1, w2,
  CAST(sum(CASE WHEN v1 > 0 AND v2 > 0 THEN 1 ELSE 0 END) AS DOUBLE) / greatest(max(n1), max(n2)) AS s1,
  1 - sum(CASE WHEN v1 > 0 THEN 0.5 * (v1 / t1) * ln(2 * (v1 / t1) / (v1 / t1 + v2 / t2)) ELSE 0 END
        + CASE WHEN v2 > 0 THEN 0.5 * (v2 / t2) * ln(2 * (v2 / t2) / (v1 / t1 + v2 / t2)) ELSE 0 END)
      / ln(2) AS s2,
  1 - sum(CASE WHEN v1 + v2 > 0 THEN pow((v1 - v2) / (v1 + v2), 2) ELSE 0 END)
      / sum(CASE WHEN v1 + v2 > 0 THEN 1 ELSE 0 END) AS s3
  FROM {p}_grid GROUP BY {K3S}, w1, w2),
{p}_ws AS (SELECT {K3S}, avg(s1) AS ws1, avg(s2) AS ws2, avg(s3) AS ws3 FROM {p}_pairterm GROUP BY {K3S}),
{p}_all AS (SELECT s.code_module, s.code_presentation, s.id_student, pw.pwd, ws.ws1, ws.ws2, ws.ws3, fw.fwd,
  CAST(COALESCE(tw.effort, 0) AS BIGINT) AS effort
  FROM {p}_stu s
  LEFT JOIN {p}_pwd pw USING ({K3S}) LEFT JOIN {p}_ws ws USING ({K3S}) LEFT JOIN {p}_fwd fw USING ({K3S})
  LEFT JOIN (SELECT {K3S}, sum(w) AS effort FROM {p}_win GROUP BY {K3S}) tw USING ({K3S}))"""


def top_values_cte(name: str, src: str, col: str, n: int = 10) -> str:
    return (f"{name} AS (SELECT {col} AS v FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} LIMIT {n})")


def order_values(values: list[str]) -> str:
    """``(VALUES ('a', 0), ('b', 1), ...) o(v, idx)`` for an ordinal order."""
    rows = ", ".join(f"('{v}', {i})" for i, v in enumerate(values))
    return f"(VALUES {rows}) AS o(v, idx)"


def ordinal_mode_cte(name: str, src: str, col: str, values: list[str]) -> str:
    return (f"{name} AS (SELECT o.idx FROM {src} s JOIN {order_values(values)} ON s.{col} = o.v "
            f"GROUP BY o.idx, o.v ORDER BY count(*) DESC, o.v LIMIT 1)")


LN2 = math.log(2.0)
