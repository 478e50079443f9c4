"""Queries over the volume model and event integrity."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import actions as A
from ..operators import ranges as R
from ..operators import seasonal as S
from ..sources.events import NOW_MS, SQL, source, target
from .registry import query

HOUR, DAY = 3_600_000, 86_400_000
JAN1 = NOW_MS - 30 * DAY
_SAMPLES = f"samples as (select timestamp_ms // {HOUR} * {HOUR} as t, count(*)::bigint as v from source group by 1)"


def _samples(spark, sf_dir):
    """The model's table: hourly counts of all events, kept to 1000 (an hour table of 42 days keeps all)."""
    return S.keep_diverse(S.hourly_samples(source(spark, sf_dir)).withColumn("series", F.lit("all"))).drop("series")


def _phases(t: str) -> dict[str, str]:
    s = f"({t} // 1000)::double"
    return {"hour": f"({s} % 86400.0) / 86400.0", "day": f"(({s} / 86400.0) % 7.0) / 7.0", "week": f"(({s} / 86400.0) % 28.0) / 28.0", "month": f"(({s} / 86400.0) % 365.25) / 365.25"}


_FEATURES = ", ".join(f"round({f}(2 * pi() * {x}), 6) + 0.0 as {n}_{f}" for n, x in _phases("t").items() for f in ("sin", "cos"))


@query(f"with {SQL}, {_SAMPLES} select t::bigint as timestamp_ms, v as value, {_FEATURES} from samples")
def fourier_features(spark, sf_dir):
    return _samples(spark, sf_dir).select("timestamp_ms", "value", *[(F.round(c, 6) + 0.0).alias(n) for n, c in S.features("timestamp_ms").items()])


def _d2(a: str, b: str) -> str:
    x, y = _phases(a), _phases(b)
    return " + ".join(f"power({f}(2 * pi() * {x[n]}) - {f}(2 * pi() * {y[n]}), 2) / {w * w}" for n, w in S.BANDWIDTHS.items() for f in ("sin", "cos"))


#: The middles of the last day's quarters, as the model is asked for a range.
_Q = [NOW_MS - DAY + i * 6 * HOUR + 3 * HOUR for i in range(4)]
_QSQL = "q as (select unnest([" + ", ".join(map(str, _Q)) + "]) as q_ms)"
_WEIGHT = f"exp(-({_d2('q_ms', 't')}) / 2) * exp(-greatest(0.0, (greatest(newest, q_ms) - t) / 86400000.0) * ln(2) / 30)"
#: For the times q (q_ms) and samples (t, v): mean, sd, regime and recent, or null where the model knows nothing.
_EXPECTED = f"""stats as (select max(t) as newest, count(*) as n, (select case when count(*) >= 3 then avg(v) end from (select v from samples order by t desc limit 10)) as recent from samples),
  weights as (select q_ms, v, n, recent, {_WEIGHT} as w from q, samples, stats),
  known as (select q_ms, sum(w * v) / sum(w) as m, sqrt(greatest(0, sum(w * v * v) / sum(w) - power(sum(w * v) / sum(w), 2))) as sd, any_value(recent) as recent from weights where w > 1e-10 and n >= 5 group by q_ms having sum(w) >= 1e-10),
  factored as (select *, case when recent is null or m < 1 then 1 when recent / m < 0.5 or recent / m > 2 then sqrt(recent / m) else 1 end as regime from known),
  expected as (select q_ms, m * regime as mean, sd, regime, recent from factored)"""


def _queries(spark):
    return spark.createDataFrame([(q,) for q in _Q], "q_ms long")


@query(f"with {SQL}, {_SAMPLES}, {_QSQL}, {_EXPECTED} select q_ms::bigint as q_ms, round(mean, 4) as mean, round(sd, 4) as sd from expected")
def expected_range(spark, sf_dir):
    out = S.expected(_queries(spark), _samples(spark, sf_dir))
    return out.select("q_ms", F.round("mean", 4).alias("mean"), F.round("sd", 4).alias("sd"))


@query(f"""with {SQL}, {_SAMPLES}, {_QSQL}, {_EXPECTED}, n as (select q_ms, (select count(*) from source where timestamp_ms >= q_ms - {3 * HOUR} and timestamp_ms < q_ms + {3 * HOUR}) as n from q)
  select q_ms::bigint as q_ms, n::bigint as n, level, case when abs(n - mean * 6) <= greatest(sigma * sd * sqrt(6), 0.3 * mean * 6, 100) then 'feasible' else 'suspicious' end as result
  from expected join n using (q_ms), (values ('normal', 6.0), ('elevated', 4.0), ('critical', 2.5)) l(level, sigma)""")
def feasibility(spark, sf_dir):
    ranges = _queries(spark).select("q_ms", (F.col("q_ms") - 3 * HOUR).alias("s"), (F.col("q_ms") + 3 * HOUR).alias("e"))
    n = R.in_windows(source(spark, sf_dir, NOW_MS - DAY, NOW_MS), ranges).groupBy("q_ms").agg(F.count("*").alias("n"))
    levels = spark.createDataFrame([("normal",), ("elevated",), ("critical",)], "level string")
    rows = S.expected(_queries(spark), _samples(spark, sf_dir)).join(n, "q_ms", "left").na.fill(0, ["n"]).crossJoin(levels)
    return rows.select("q_ms", "n", "level", S.feasibility(F.col("n"), F.col("mean"), F.col("sd"), F.lit(6.0), F.col("level")).alias("result"))


_COVER = "least(1.0, (1 - sqrt(power(avg(sin(2 * pi() * {x})), 2) + power(avg(cos(2 * pi() * {x})), 2))) * least(1.0, count(*) / 24.0))"
_CONF = "least(1.0, (1 - exp(-count(*) / 100.0)) * least(1.0, 0.6 * " + _COVER.format(x=_phases("t")["hour"]) + " + 0.4 * " + _COVER.format(x=_phases("t")["day"]) + "))"


@query(f"with {SQL}, {_SAMPLES} select round({_CONF}, 6) as confidence from samples")
def confidence(spark, sf_dir):
    return S.confidence(_samples(spark, sf_dir)).select(F.round("confidence", 6).alias("confidence"))


@query(f"""with {SQL}, {_SAMPLES}, c as (select {_CONF} as c from samples) select round(c, 6) as model_weight, round(1 - c, 6) as target_weight, c >= 0.85 as self_reliant from c""")
def confidence_weights(spark, sf_dir):
    c = F.col("confidence")
    return S.confidence(_samples(spark, sf_dir)).select(F.round(c, 6).alias("model_weight"), F.round(1 - c, 6).alias("target_weight"), S.self_reliant(c).alias("self_reliant"))


#: Every hour of the table is asked for, against a model of its first ten days, a little thinned: some regimes differ.
_HOURS = f"q as (select distinct timestamp_ms // {HOUR} * {HOUR} as q_ms from source)"
_YOUNG = f"samples as (select timestamp_ms // {HOUR} * {HOUR} as t, (count(*) * (1 + 3 * ((timestamp_ms // {HOUR}) % 5 // 4)))::bigint as v from source where timestamp_ms < {JAN1 + 10 * DAY} group by 1, timestamp_ms // {HOUR})"


def _young(spark, sf_dir):
    s = S.hourly_samples(source(spark, sf_dir, None, JAN1 + 10 * DAY))
    return s.withColumn("value", (F.col("value") * (1 + 3 * F.expr(f"((timestamp_ms div {HOUR}) % 5) div 4"))).cast("long"))


def _hours(spark, sf_dir):
    return S.hourly_samples(source(spark, sf_dir)).select(F.col("timestamp_ms").alias("q_ms"))


@query(f"with {SQL}, {_YOUNG}, {_HOURS}, {_EXPECTED} select q_ms::bigint as q_ms, round(regime, 6) as regime from expected")
def regime_factor(spark, sf_dir):
    return S.expected(_hours(spark, sf_dir), _young(spark, sf_dir)).where("mean is not null").select("q_ms", F.round("regime", 6).alias("regime"))


@query(f"""with {SQL}, {_YOUNG}, {_HOURS}, {_EXPECTED} select q_ms::bigint as q_ms, round(case when mean >= 1 and (recent / mean < 0.5 or recent / mean > 2) then recent / mean end, 6) as ratio from expected""")
def regime_change(spark, sf_dir):
    out = S.expected(_hours(spark, sf_dir), _young(spark, sf_dir)).where("mean is not null")
    return out.select("q_ms", F.round(S.regime_change(F.col("recent"), F.col("mean")), 6).alias("ratio"))


@query(f"""with {SQL}, {_SAMPLES}, {_QSQL}, {_EXPECTED}, c as (select {_CONF} as c from samples), n as (select q_ms, (select count(*) from target where timestamp_ms >= q_ms and timestamp_ms < q_ms + {HOUR}) as n from q)
  select q_ms::bigint as q_ms, round(mean * c + n * (1 - c), 4) as mean, round(case when c < 0.5 then greatest(sd, abs(n - (mean * c + n * (1 - c))) * (1 - c), 10) else sd end, 4) as sd from expected join n using (q_ms), c""")
def blend_with_target(spark, sf_dir):
    samples, q = _samples(spark, sf_dir), _queries(spark)
    windows = q.select("q_ms", F.col("q_ms").alias("s"), (F.col("q_ms") + HOUR).alias("e"))
    n = R.in_windows(target(spark, sf_dir, NOW_MS - DAY, NOW_MS), windows).groupBy("q_ms").agg(F.count("*").alias("n"))
    rows = S.expected(q, samples).join(n, "q_ms", "left").na.fill(0, ["n"]).crossJoin(S.confidence(samples))
    mean, sd = S.blend(F.col("mean"), F.col("sd"), F.col("confidence"), F.col("n"))
    return rows.select("q_ms", F.round(mean, 4).alias("mean"), F.round(sd, 4).alias("sd"))


_DIVERSITY = f"""near as (select a.t, a.v, min({_d2('a.t', 'b.t')}) as d2 from samples a, samples b where a.t <> b.t group by all),
  diverse as (select t, v, sqrt(d2) * (0.5 + 0.5 * exp(-greatest(0.0, ({NOW_MS} - t) / 86400000.0) * ln(2) / 90)) as d from near)"""


@query(f"with {SQL}, {_SAMPLES}, {_DIVERSITY} select t::bigint as timestamp_ms, v as value from diverse order by round(d, 9) desc, t limit 100")
def diversity_topk(spark, sf_dir):
    return S.most_diverse(_samples(spark, sf_dir), NOW_MS, 100).select("timestamp_ms", "value")


@query(f"with {SQL}, {_SAMPLES}, {_DIVERSITY} select round(avg(d), 6) as mean, round(min(d), 6) as least from diverse")
def diversity_stats(spark, sf_dir):
    return S.diversity_stats(_samples(spark, sf_dir), NOW_MS).select(F.round("mean", 6).alias("mean"), F.round("least", 6).alias("least"))


@query(f"with {SQL} select log_group as series, timestamp_ms // {HOUR} * {HOUR} as timestamp_ms, count(*)::bigint as value from source group by all")
def kept_samples(spark, sf_dir):
    """Below 1000 samples a series none goes; beyond, the order of eviction is beyond SQL and tested by brute force."""
    hour = F.expr(f"timestamp_ms div {HOUR} * {HOUR}")
    return S.keep_diverse(source(spark, sf_dir).groupBy(F.col("log_group").alias("series"), hour.alias("timestamp_ms")).agg(F.count("*").alias("value")))


@query(f"""with {SQL}, {_YOUNG}, {_HOURS} select q_ms::bigint as q_ms, exists (select 1 from samples where abs(t - (q_ms + {HOUR // 2})) < {HOUR // 2 + 1}) as near from q""")
def sampled_near(spark, sf_dir):
    out = S.near_sample(_hours(spark, sf_dir).select((F.col("q_ms") + HOUR // 2).alias("q_ms")), _young(spark, sf_dir), HOUR // 2 + 1)
    return out.select((F.col("q_ms") - HOUR // 2).alias("q_ms"), "near")


def _integrity_sql(w: int) -> str:
    spread = 0.8 if w >= DAY else w / HOUR / 30
    return f"""rows as (select timestamp_ms as t, timestamp_ms // {w} * {w} as s, (timestamp_ms // 1000 % 86400) / 86400.0::double as p from source),
 w as (select *, count(*) over x as n, row_number() over (partition by s order by t) as rn, t - lag(t) over (partition by s order by t) as g,
   coalesce(lag(p) over (partition by s order by p, t), max(p) over x - 1) as l, coalesce(lead(p) over (partition by s order by p, t), min(p) over x + 1) as r from rows window x as (partition by s)),
 a as (select s, max(n) as n, min(t) as f, max(t) as z, avg(case when (rn - 1) % (n // least(n, 50)) = 0 then 2 * abs(sin(pi() * least(p - l, r - p))) end) as c,
   sqrt(power(avg(sin(2 * pi() * p)), 2) + power(avg(cos(2 * pi() * p)), 2)) as m, avg(g) as g, coalesce(stddev_pop(g), 0) as gs, max(g) as gm from w group by s),
 parts as (select s, n, case when n < 2 then 0.5 else least(1.0, (z - f) / {w}.0::double * (1 - (least(1.0, abs(f - s) / {w}.0::double) + least(1.0, abs(s + {w} - z) / {w}.0::double)) / 4)) end as temporal,
   case when n < 3 then 0.5 else least(1.0, c / 2 * 4) end as diversity, case when n < 4 then 0.5 else least(1.0, (1 - m) / 2 / {spread}) end as uniformity,
   case when n < 3 then 0.5 else 0.3 * (1 - least(1.0, abs(g - {w}.0::double / n) / ({w}.0::double / n))) + 0.4 * exp(-(case when g > 0 then gs / g else 1 end) / 2) + 0.3 * (case when gm / {w}.0::double > 0.5 then 0.3 else 1 - gm / {w}.0::double end) end as gap from a),
 scored as (select *, case when n < 3 then 0.1 else 0.25 * temporal + 0.30 * diversity + 0.25 * uniformity + 0.20 * gap end as score from parts),
 sound as (select *, case when n < 3 then 'Partial' when score > 0.7 then 'Valid' when score > 0.3 then 'Partial' else 'Invalid' end as status from scored)"""


_PARTS = ("temporal", "diversity", "uniformity", "gap", "score")
_SOUND = "select s::bigint as start_ms, n::bigint as n, " + ", ".join(f"round({c}, 5) as {c}" for c in _PARTS) + ", status from sound"


@query(f"with {SQL}, {_integrity_sql(DAY)} {_SOUND}")
def integrity_by_day(spark, sf_dir):
    out = S.integrity(source(spark, sf_dir), DAY)
    return out.select("start_ms", "n", *[F.round(c, 5).alias(c) for c in _PARTS], "status")


@query(f"with {SQL}, {_integrity_sql(HOUR)} {_SOUND}")
def integrity_by_hour(spark, sf_dir):
    out = S.integrity(source(spark, sf_dir), HOUR)
    return out.select("start_ms", "n", *[F.round(c, 5).alias(c) for c in _PARTS], "status")


# What a reconcile does with each window --------------------------------------------------------------------------------

_QUARTER = 6 * HOUR


def _quarters(spark):
    return spark.range(120).select((F.lit(JAN1) + F.col("id") * _QUARTER).alias("s"), (F.lit(JAN1) + (F.col("id") + 1) * _QUARTER).alias("e"))


def _decided_sql(samples: str, level: str) -> str:
    """The decisions for all quarters of days, under a model of ``samples``."""
    feasible, blend = {"normal": (6.0, 4.0), "elevated": (4.0, 2.5), "critical": (2.5, 1.5)}[level]
    stressed = "true" if level != "normal" else "false"
    pct = "abs(x.a - x.b) * 100 // greatest(x.a, x.b)"
    wide = "case when mean is null then greatest(sqrt(b / 6.0), 10) when c < 0.5 then greatest(sd, abs(b / 6.0 - (mean * c + b / 6.0 * (1 - c))) * (1 - c), 10) else sd end"
    return f"""{samples}, r0 as (select {JAN1} + i * {_QUARTER} as s, {JAN1} + (i + 1) * {_QUARTER} as e from range(120) t(i)), q as (select s + {_QUARTER // 2} as q_ms from r0), {_EXPECTED}, c as (select case when count(*) < 5 then 0 else {_CONF} end as c from samples),
  x0 as (select s, e, (select count(*) from source where timestamp_ms >= s and timestamp_ms < e) as a, (select count(*) from target where timestamp_ms >= s and timestamp_ms < e) as b from r0),
  x as (select x0.*, c, mean, sd, coalesce(mean * c + b / 6.0 * (1 - c), b / 6.0) * 6 as bm, ({wide}) * sqrt(6) as bs from x0 left join expected on q_ms = s + {_QUARTER // 2}, c),
  judged as (select *, case when c < 0.85 then 'blend' when mean is null then 'no_history' when abs(a - mean * 6) <= greatest({feasible} * sd * sqrt(6), 0.3 * mean * 6, 100) then 'feasible' else 'suspicious' end as feasibility from x),
  decided as (select s, e, a, b, feasibility, case feasibility when 'feasible' then 'full_replace' when 'suspicious' then 'check_integrity'
    when 'blend' then case when abs(a - bm) <= greatest({blend} * bs, 0.1 * bm, 10) then 'full_replace' when {pct} <= 25 or (b > a and {stressed}) or {pct} <= 50 then 'live_learn' else 'check_integrity' end
    else case when greatest(a, b) = 0 or {pct} <= 25 or (b > a and {stressed}) then 'live_learn' else 'full_replace' end end as action from judged x),
  actions as (select *, case when action = 'live_learn' then b when action = 'full_replace' and not (feasibility = 'no_history' and a = 0 and {stressed}) then a end as verified from decided)"""


_ACTIONS = "select s::bigint as s, e::bigint as e, a::bigint as source_n, b::bigint as target_n, feasibility, action, round(verified / 6.0, 6) as verified from actions"
_FEW = f"samples as (select timestamp_ms // {HOUR} * {HOUR} as t, count(*)::bigint as v from source where timestamp_ms < {JAN1 + 3 * DAY} group by 1)"


def _few(spark, sf_dir):
    return S.hourly_samples(source(spark, sf_dir, None, JAN1 + 3 * DAY))


def _decide(spark, sf_dir, samples, level):
    return A.decide(A.range_counts(source(spark, sf_dir), target(spark, sf_dir), _quarters(spark)), samples, level)


@query(f"with {SQL}, {_decided_sql(_SAMPLES, 'critical')} {_ACTIONS}")
def safe_replace_actions(spark, sf_dir):
    return _decide(spark, sf_dir, _samples(spark, sf_dir), "critical").withColumn("verified", F.round("verified", 6)).drop("hours")


@query(f"with {SQL}, {_decided_sql(_FEW, 'elevated')} {_ACTIONS}")
def safe_replace_young(spark, sf_dir):
    """A model of three days is not self-reliant, so its expectation is blended with the target's counts."""
    return _decide(spark, sf_dir, _few(spark, sf_dir), "elevated").withColumn("verified", F.round("verified", 6)).drop("hours")


#: The target after inserts from the ranges r (s, e, purge), deletes only where purge.
_APPLIED = """af as materialized (select x.*, r.s, r.purge from source x join r on x.timestamp_ms >= r.s and x.timestamp_ms < r.e), bf as materialized (select x.id, r.s from target x join r on x.timestamp_ms >= r.s and x.timestamp_ms < r.e where r.purge),
  gone as materialized (select distinct id from bf where s in (select s from af where trim(message) <> '') and not exists (select 1 from af where af.s = bf.s and af.id = bf.id)),
  new as materialized (select id, timestamp_ms, message, log_group from af where trim(message) <> '' and id not in (select id from target))
  select * from target where id not in (select id from gone) union all select * from new"""


@query(f"with {SQL}, {_decided_sql(_FEW, 'elevated')}, {_integrity_sql(_QUARTER)}, r as materialized (select d.s, d.e, action = 'full_replace' as purge from decided d left join sound using (s) where action = 'full_replace' or coalesce(status, 'Invalid') <> 'Invalid'), {_APPLIED}")
def safe_replace_result(spark, sf_dir):
    return A.safe_replace(source(spark, sf_dir), target(spark, sf_dir), _quarters(spark), _few(spark, sf_dir), "elevated")[0]


@query(f"""with {SQL}, {_decided_sql(_FEW, 'elevated')}, recorded as (select s as t, verified / 6.0 as v from actions where verified is not null union all select s, b / 6.0 from actions where feasibility = 'blend' and not exists (select 1 from samples where abs(t - s) < {HOUR}))
  select t::bigint as timestamp_ms, round(v, 6) as value from recorded""")
def record_samples(spark, sf_dir):
    out = A.safe_replace(source(spark, sf_dir), target(spark, sf_dir), _quarters(spark), _few(spark, sf_dir), "elevated")[1]
    return out.select("timestamp_ms", F.round("value", 6).alias("value"))


def _hour_windows(spark):
    return spark.range(720).select((F.lit(JAN1) + F.col("id") * HOUR).alias("s"), (F.lit(JAN1) + (F.col("id") + 1) * HOUR).alias("e"))


@query(f"with {SQL}, {_integrity_sql(HOUR)}, r as materialized (select s, s + {HOUR} as e, false as purge from sound where status <> 'Invalid'), {_APPLIED}")
def integrity_ingest_result(spark, sf_dir):
    return A.insert_usable(source(spark, sf_dir), target(spark, sf_dir), _hour_windows(spark))


@query(f"with {SQL}, {_integrity_sql(_QUARTER)}, r as materialized (select s, s + {_QUARTER} as e, false as purge from sound where status <> 'Invalid'), {_APPLIED}")
def live_learn_result(spark, sf_dir):
    learned = _quarters(spark).withColumn("action", F.lit("live_learn"))
    return A.apply(source(spark, sf_dir), target(spark, sf_dir), learned)
