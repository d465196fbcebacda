"""DuckDB text of the model frame, its fold-wise encoders and the Lasso by coordinate descent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from wattlake.plans.pipelines import CAT_FEATURES, NUM_FEATURES

FEATURES = [*CAT_FEATURES, *NUM_FEATURES]
_HASH = "cast('0x' || substr(md5(cast(m.row_id as varchar)), 1, 8) as bigint)"
SWEEPS = 90

#: Building cleaning, features and log target of all positive readings; outliers removed; ``part`` is the 80/10/10 split, ``fold`` one of 8.
FRAME = [
    """bc1 as (select building_id, site_id, primary_use, square_feet,
       coalesce(year_built, median(year_built) over (partition by site_id)) as year_built from building_fx)""",
    """bc2 as (select building_id, site_id, primary_use, square_feet,
       coalesce(year_built, median(year_built) over (partition by primary_use)) as year_built from bc1)""",
    """bc3 as (select building_id, site_id, primary_use, square_feet,
       cast(trunc(coalesce(year_built, median(year_built) over (partition by site_id))) as int) as year_built from bc2)""",
    """rd as (select m.*, b.site_id, case when b.site_id = 0 and m.meter = 0 then m.meter_reading * 0.2931
       when b.site_id = 0 and m.meter = 1 then m.meter_reading * 0.0833 else m.meter_reading end as reading
from meter_fx m left join building_fx b on m.building_id = b.building_id)""",
    """cap as (select quantile_cont(reading, 0.75) + 50 * (quantile_cont(reading, 0.75) - quantile_cont(reading, 0.25)) as most from rd)""",
    f"""mf0 as (select m.row_id, m.meter, m.building_id, b.primary_use, b.square_feet, b.year_built, c.country,
  dayofyear(m.timestamp) as dayofyear, hour(m.timestamp) as hour, cast(isodow(m.timestamp) >= 6 as int) as is_weekend,
  cast(exists (select 1 from calendar k where k.country = c.country
               and k.holiday_date = cast(m.timestamp as date)) as int) as is_holiday,
  6.11 * pow(10.0, 7.5 * w.dew_temperature / (237.3 + w.dew_temperature)) * 100
    / (6.11 * pow(10.0, 7.5 * w.air_temperature / (237.3 + w.air_temperature))) as rel_humidity,
  w.dew_temperature, w.sea_level_pressure, w.wind_speed, sin(radians(w.wind_direction)) as wind_direction_y,
  m.reading,
  case when {_HASH} % 100 < 80 then 'train' when {_HASH} % 100 < 90 then 'val' else 'test' end as part, cast({_HASH} % 1000003 % 8 as int) as fold
from rd m left join bc3 b on m.building_id = b.building_id
left join wp w on b.site_id = w.site_id and m.timestamp = w.timestamp
left join countries_fx c on b.site_id = c.site_id where m.meter_reading > 0 and m.reading <= (select most from cap))""",
    "mf as materialized (select *, ln(1 + reading * avg(square_feet) over (partition by meter) / square_feet) as y from mf0)",
]


def encoder_ctes(folds: int) -> list[str]:
    """``tr`` training rows by held fold (-1: none), labels, category means ``me1`` / ``me2`` and scales ``sc``."""
    complete = " and ".join(f"{c} is not null" for c in [*NUM_FEATURES, "y", "meter"])
    scales = ", ".join(f"avg(x{i}) as m{i}, case when min(x{i}) = max(x{i}) then 1 else stddev_pop(x{i}) end as s{i}"
                       for i in range(len(FEATURES)))
    return [
        f"full_rows as (select * from mf where part = 'train' and {complete})",
        f"tr as materialized (select h.h, r.* from full_rows r, (select unnest(range(-1, {folds})) as h) h where r.fold <> h.h)",
        """rc as (select meter, h, 'primary_use' as var, primary_use as cat, count(*) as n from tr where primary_use is not null group by all
  union all select meter, h, 'country', country, count(*) from tr where country is not null group by all)""",
        """rk as (select c.meter, c.h, c.var, c.cat from rc c
  join (select meter, h, var, sum(n) as total, count(*) as cats from rc group by all) t
    on c.meter = t.meter and c.h = t.h and c.var = t.var where t.cats <= 10 or c.n / t.total >= 0.05)""",
        _labelled("tl", "tr"),
        "me1 as (select meter, h, l1, avg(y) as e from tl group by all)",
        "me2 as (select meter, h, l2, avg(y) as e from tl group by all)",
        _encoded("te", "tl"),
        f"sc as materialized (select meter, h, avg(y) as ym, {scales} from te group by meter, h)",
    ]


def _labelled(name: str, rows: str) -> str:
    return f"""{name} as (select r.*, coalesce(a.cat, 'Rare') as l1, coalesce(b.cat, 'Rare') as l2 from {rows} r
  left join rk a on a.meter = r.meter and a.h = r.h and a.var = 'primary_use' and a.cat = r.primary_use
  left join rk b on b.meter = r.meter and b.h = r.h and b.var = 'country' and b.cat = r.country)"""


def _encoded(name: str, rows: str) -> str:
    x = ", ".join(f"cast(r.{c} as double) as x{i + 2}" for i, c in enumerate(NUM_FEATURES))
    return f"""{name} as (select r.h, r.row_id, r.meter, r.y, r.part, p.e as x0, q.e as x1, {x} from {rows} r
  left join me1 p on p.meter = r.meter and p.h = r.h and p.l1 = r.l1
  left join me2 q on q.meter = r.meter and q.h = r.h and q.l2 = r.l2)"""


def scaled_ctes(name: str, rows: str) -> list[str]:
    """``name``: the rows (with h) encoded and scaled, z0 .. z13."""
    z = ", ".join(f"(e.x{i} - s.m{i}) / s.s{i} as z{i}" for i in range(len(FEATURES)))
    return [_labelled(f"{name}_l", rows), _encoded(f"{name}_e", f"{name}_l"),
            f"{name} as (select e.h, e.row_id, e.meter, e.y, e.part, s.ym, {z} from {name}_e e left join sc s on s.meter = e.meter and s.h = e.h)"]


def lasso_ctes(alphas: Sequence[float], subsets: Mapping[str, Sequence[str]], held: str = "true") -> list[str]:
    """``sol``: weights ``w`` by (meter, h, fs, alpha), for the held folds with ``held``."""
    p = len(FEATURES)
    z = ", ".join(f"(e.x{i} - s.m{i}) / s.s{i} as z{i}" for i in range(p))
    gram = ", ".join("[" + ", ".join(f"sum(z{min(i, j)} * z{max(i, j)}) / count(*)" for j in range(p)) + "]" for i in range(p))
    xy = ", ".join(f"sum(z{i} * (y - ym)) / count(*)" for i in range(p))
    sets = ", ".join(f"('{k}', [" + ", ".join("1" if f in set(v) else "0" for f in FEATURES) + "])" for k, v in subsets.items())
    values = ", ".join(f"({a!r})" for a in alphas)
    rho = "(s.c[j] - list_dot_product(s.g[j], d.w) + s.g[j][j] * d.w[j])"
    return [
        f"tz as (select e.h, e.meter, e.y, s.ym, {z} from te e join sc s on s.meter = e.meter and s.h = e.h where {held.replace('h', 'e.h') if held != 'true' else held})",
        f"eq as materialized (select meter, h, [{gram}] as g, [{xy}] as c from tz group by meter, h)",
        f"sets as (select * from (values {sets}) t(fs, mask))",
        f"alphas as (select cast(a as double) as alpha from (values {values}) t(a))",
        f"""cd as (select meter, h, fs, mask, alpha, 0 as t, list_resize(cast([] as double[]), {p}, cast(0 as double)) as w
  from eq, sets, alphas
  union all select d.meter, d.h, d.fs, d.mask, d.alpha, d.t + 1, list_concat(list_concat(d.w[1:j - 1],
    [case when d.mask[j] = 0 or s.g[j][j] <= 1e-12 then 0 else sign({rho}) * greatest(abs({rho}) - d.alpha, 0) / s.g[j][j] end]),
    d.w[j + 1:])
  from (select *, t % {p} + 1 as j from cd where t < {p * SWEEPS}) d join eq s on s.meter = d.meter and s.h = d.h)""",
        f"sol as (select meter, h, fs, alpha, w from cd where t = {p * SWEEPS})",
    ]


def prediction(rows: str = "r", weights: str = "s.w") -> str:
    return f"{rows}.ym + " + " + ".join(f"{weights}[{i + 1}] * {rows}.z{i}" for i in range(len(FEATURES)))


def fold_scores() -> list[str]:
    """``fs_scores``: mean squared error of every held fold."""
    return ["own as (select fold as h, r.* from full_rows r)", *scaled_ctes("oz", "own"),
            f"""fs_scores as (select s.meter, s.h, s.fs, s.alpha, avg(pow(r.y - ({prediction()}), 2)) as msle
  from sol s join oz r on r.meter = s.meter and r.h = s.h where s.h >= 0 and r.z0 is not null and r.z1 is not null
  group by all)"""]


POWER_STEPS = 1000


def component_ctes() -> list[str]:
    """``pc0`` and ``pc1``: the two largest eigenpairs (e, v) of every meter's ``eq.g``, by power iteration and deflation."""
    p = len(FEATURES)
    start = "[" + ", ".join(f"cast({1 - 0.05 * i!r} as double)" for i in range(p)) + "]"
    out = []
    for c, src in enumerate(("(select meter, g from eq where h = -1)", "rest")):
        step = "[" + ", ".join(f"list_dot_product(g.g[{i + 1}], d.v)" for i in range(p)) + "]"
        unit = "[" + ", ".join(f"u[{i + 1}] / sqrt(list_dot_product(u, u))" for i in range(p)) + "]"
        out += [f"""it{c} as (select meter, 0 as t, cast(0 as double) as e, {start} as v from {src} s
  union all select meter, t + 1, sqrt(list_dot_product(u, u)), {unit}
  from (select d.meter, d.t, {step} as u from it{c} d join {src} g on g.meter = d.meter where d.t < {POWER_STEPS}) n)""",
                f"pc{c} as materialized (select meter, e, v from it{c} where t = {POWER_STEPS})"]
        if c == 0:
            less = ", ".join("[" + ", ".join(f"s.g[{i + 1}][{j + 1}] - o.e * o.v[{i + 1}] * o.v[{j + 1}]" for j in range(p)) + "]" for i in range(p))
            out.append(f"rest as materialized (select s.meter, [{less}] as g from {src} s join pc0 o on o.meter = s.meter)")
    return out


def loadings() -> str:
    """Loadings of both components; the largest of a component is positive."""
    p = len(FEATURES)
    trace = " + ".join(f"q.g[{i + 1}][{i + 1}]" for i in range(p))
    big = "(select max(abs(x)) from (select unnest(o.v) as x) a)"
    parts = []
    for c in (0, 1):
        for i, f in enumerate(FEATURES):
            parts.append(f"select o.meter, {c} as component, round(o.e / ({trace}), 4) as explained_variance, '{f}' as feature, "
                         f"round(o.v[{i + 1}] * case when list_contains(o.v, {big}) then 1 else -1 end, 4) as loading "
                         f"from pc{c} o join eq q on q.meter = o.meter and q.h = -1")
    return " union all ".join(parts)
