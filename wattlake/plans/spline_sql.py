"""DuckDB text of the not-a-knot cubic fill: the tridiagonal system by recursive CTEs."""

from __future__ import annotations

from collections.abc import Sequence


def cubic_ctes(cols: Sequence[str], src: str = "reindexed_fx", out: str = "cubic") -> list[str]:
    """CTEs ending in ``out``: the rows of ``src`` (site_id, timestamp, ...) with gaps of ``cols`` inside the known range
    filled.  Knots are numbered from 1; the system is for knots 2 .. n - 1, the end conditions being used to eliminate
    the slopes of knots 1 and n.  Fewer than four knots: linear."""
    long = " union all ".join(f"select site_id, timestamp, pos, '{c}' as var, {c} as v from cub_p" for c in cols)
    others = "select * exclude (" + ", ".join(cols) + f") from {src}"
    pivot = ", ".join(f"max(case when e.var = '{c}' then e.v end) as {c}" for c in cols)
    return [
        f"cub_p as (select *, row_number() over (partition by site_id order by timestamp) as pos from {src})",
        f"cub_l as materialized ({long})",
        """cub_k as materialized (select site_id, var, cast(pos as double) as x, v as y,
  row_number() over w as i, count(*) over (partition by site_id, var) as n,
  cast(lag(pos) over w as double) as xp, lag(v) over w as yp, cast(lead(pos) over w as double) as xn, lead(v) over w as yn
  from cub_l where v is not null window w as (partition by site_id, var order by pos))""",
        """cub_h as (select *, x - xp as h0, xn - x as h1, (y - yp) / (x - xp) as s0, (yn - y) / (xn - x) as s1, xn - xp as d
  from cub_k where n >= 4 and i between 2 and n - 1)""",
        """cub_r as (select *, ((h0 + 2 * d) * h1 * s0 + h0 * h0 * s1) / d as r0, (h1 * h1 * s0 + (2 * d + h1) * h0 * s1) / d as rn
  from cub_h)""",
        """cub_c as materialized (select site_id, var, count(*) as m,
  list(case when i = 2 then 0 else h1 end order by i) as a,
  list(2 * d - case when i = 2 then d else 0 end - case when i = n - 1 then d else 0 end order by i) as b,
  list(case when i = n - 1 then 0 else h0 end order by i) as c,
  list(3 * (h1 * s0 + h0 * s1) - case when i = 2 then r0 else 0 end - case when i = n - 1 then rn else 0 end order by i) as r,
  max(case when i = 2 then r0 / h1 end) as a0, max(case when i = 2 then -d / h1 end) as b0,
  max(case when i = n - 1 then rn / h0 end) as an, max(case when i = n - 1 then -d / h0 end) as bn
  from cub_r group by site_id, var)""",
        """cub_f as (select site_id, var, cast(1 as bigint) as k, c[1] / b[1] as cp, r[1] / b[1] as rp from cub_c
  union all select f.site_id, f.var, f.k + 1, t.c[f.k + 1] / (t.b[f.k + 1] - t.a[f.k + 1] * f.cp),
    (t.r[f.k + 1] - t.a[f.k + 1] * f.rp) / (t.b[f.k + 1] - t.a[f.k + 1] * f.cp)
  from cub_f f join cub_c t on f.site_id = t.site_id and f.var = t.var where f.k < t.m)""",
        """cub_g as materialized (select site_id, var, max(k) as m, list(cp order by k) as cp, list(rp order by k) as rp
  from cub_f group by site_id, var)""",
        """cub_b as (select site_id, var, m as k, rp[m] as s from cub_g
  union all select b.site_id, b.var, b.k - 1, g.rp[b.k - 1] - g.cp[b.k - 1] * b.s
  from cub_b b join cub_g g on b.site_id = g.site_id and b.var = g.var where b.k > 1)""",
        """cub_s as materialized (select site_id, var, k + 1 as i, s from cub_b
  union all select b.site_id, b.var, 1, c.a0 + c.b0 * b.s from cub_b b join cub_c c on b.site_id = c.site_id and b.var = c.var where b.k = 1
  union all select b.site_id, b.var, c.m + 2, c.an + c.bn * b.s from cub_b b join cub_c c on b.site_id = c.site_id and b.var = c.var
    where b.k = c.m)""",
        """cub_i as (select site_id, var, k.i, n, x, xn, xn - x as h, y, (yn - y) / (xn - x) as sl, s.s as s, t.s as t
  from cub_k k left join cub_s s using (site_id, var, i)
  left join (select site_id, var, i - 1 as i, s from cub_s) t using (site_id, var, i) where xn is not null)""",
        """cub_e as (select l.site_id, l.timestamp, l.var, case when l.v is not null then l.v
    when i.n < 4 then i.y + i.sl * (l.pos - i.x)
    else i.y + (l.pos - i.x) * (i.s + (l.pos - i.x) * ((3 * i.sl - 2 * i.s - i.t) / i.h
      + (l.pos - i.x) * (i.s + i.t - 2 * i.sl) / (i.h * i.h))) end as v
  from cub_l l left join cub_i i on l.site_id = i.site_id and l.var = i.var and l.pos > i.x and l.pos < i.xn)""",
        f"cub_w as (select e.site_id, e.timestamp, {pivot} from cub_e e group by e.site_id, e.timestamp)",
        f"{out} as (select o.*, {', '.join('w.' + c for c in cols)} from ({others}) o "
        "left join cub_w w on o.site_id = w.site_id and o.timestamp = w.timestamp)",
    ]
