"""Features, regression, scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from energylake.operators import features as f
from energylake.operators import ridge, scoring
from energylake.operators.metrics import mean_by
from energylake.operators.rows import fold_by_key, portable_bucket
from energylake.operators.scoring import RidgeModel, Term
from energylake.plans.jobs import TrainingSpec, train
from energylake.queries.registry import query, table
from energylake.session import scratch_path

ALPHAS = [0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]


@query("""select p_partkey, case p_type when 'LARGE' then 1.0 else 0.0 end::double as p_type_LARGE,
                 case p_type when 'MEDIUM' then 1.0 else 0.0 end::double as p_type_MEDIUM,
                 case p_type when 'PROMO' then 1.0 else 0.0 end::double as p_type_PROMO,
                 case p_type when 'SMALL' then 1.0 else 0.0 end::double as p_type_SMALL,
                 case p_type when 'STANDARD' then 1.0 else 0.0 end::double as p_type_STANDARD
          from part""")
def one_hot(spark, sf):
    return f.one_hot(table(spark, sf, "part").select("p_partkey", "p_type"), ["p_type"])


@query("""select l_orderkey, l_linenumber,
                 round((l_quantity - (select avg(l_quantity) from lineitem))
                       / (select stddev_pop(l_quantity) from lineitem), 8) as l_quantity
          from lineitem""")
def standardize(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return (f.apply_scaler(rows, f.fit_scaler(rows, ["l_quantity"]))
            .withColumn("l_quantity", F.round("l_quantity", 8)))


@query("""with z as (select l_extendedprice / l_quantity as y, l_quantity as a,
                            case l_returnflag when 'R' then 1 else 0 end as b from lineitem),
          s as (select count(*) as n, avg(y) as my, avg(a) as ma, avg(b) as mb,
                       var_pop(a) * count(*) + 10 as aa, var_pop(b) * count(*) + 10 as bb,
                       covar_pop(a, b) * count(*) as ab, covar_pop(a, y) * count(*) as ay,
                       covar_pop(b, y) * count(*) as bey from z),
          w as (select (ay * bb - bey * ab) / (aa * bb - ab * ab) as wa,
                       (bey * aa - ay * ab) / (aa * bb - ab * ab) as wb, my, ma, mb from s)
          select 'l_quantity' as feature, round(wa, 6) as coef from w
          union all select 'returned', round(wb, 6) from w
          union all select '(intercept)', round(my - wa * ma - wb * mb, 6) from w""")
def ridge_fit(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_quantity", (F.col("l_returnflag") == "R").cast("double").alias("returned"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("y"))
    return (ridge.fit_ridge(rows, ["l_quantity", "returned"], "y", 10.0)
            .withColumn("coef", F.round("coef", 6)))


@query("""with z as (select l_extendedprice * (1 - l_discount) / 1000 as y, l_quantity as a, l_discount * 100 as b
                     from lineitem),
          s as (select avg(y) as my, avg(a) as ma, avg(b) as mb, var_pop(a) as aa, var_pop(b) as bb,
                       covar_pop(a, b) as ab, covar_pop(a, y) as ay, covar_pop(b, y) as bey from z),
          w as (select (ay * bb - bey * ab) / (aa * bb - ab * ab) as wa,
                       (bey * aa - ay * ab) / (aa * bb - ab * ab) as wb, my, ma, mb from s)
          select 'l_quantity' as feature, round(wa, 6) as coef from w
          union all select 'l_discount', round(wb, 6) from w
          union all select '(intercept)', round(my - wa * ma - wb * mb, 6) from w""")
def ridge_collinear(spark, sf):
    """A fit on the quantity and on the same with a millionth of the discount added, by each alone."""
    tilt = 1e-6
    rows = table(spark, sf, "lineitem").select(
        "l_quantity", (F.col("l_quantity") + tilt * 100 * F.col("l_discount")).alias("tilted"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) / 1000).alias("y"))
    found = {r["feature"]: r["coef"] for r in ridge.fit_ridge(
        rows, ["l_quantity", "tilted"], "y", 0.0, ridge.Factors).collect()}
    both = found["l_quantity"] + found["tilted"]
    return spark.createDataFrame(
        [("l_quantity", both), ("l_discount", found["tilted"] * tilt), ("(intercept)", found["(intercept)"])],
        "feature string, coef double").withColumn("coef", F.round("coef", 6))


CV_SQL = """
sums as (
    select fold, count(*)::double as n, avg(x) as mx, avg(y) as my, var_pop(x) * count(*) as xx,
           covar_pop(x, y) * count(*) as xy, var_pop(y) * count(*) as yy
    from z where fold >= 0 group by fold),
rest as (
    select k.fold, count(*)::double as n, avg(x) as mx, avg(y) as my, var_pop(x) * count(*) as xx,
           covar_pop(x, y) * count(*) as xy
    from sums k join z on z.fold >= 0 and z.fold <> k.fold group by k.fold),
alphas as (select unnest([0.01, 0.1, 1, 10, 100, 1000])::double as alpha),
fits as (
    select alpha, fold, xy / (xx + alpha) as w, my - xy / (xx + alpha) * mx as b
    from rest, alphas),
scores as (
    select alpha, 1 - (yy - 2 * w * xy + w * w * xx + n * (my - b - w * mx) * (my - b - w * mx)) / yy
                  as r2
    from fits join sums using (fold)),
cv as (select alpha, avg(r2) as r2_mean, stddev_pop(r2) as r2_std from scores group by alpha),
best as (select alpha from cv order by r2_mean desc, alpha limit 1)
"""


@query("""with z as (
            select (l_quantity - avg(l_quantity) over ()) / stddev_pop(l_quantity) over () as x,
                   l_extendedprice / l_quantity as y,
                   ('0x' || substr(md5('43|' || l_orderkey), 1, 8))::bigint % 5 as fold
            from lineitem), """ + CV_SQL + """
          select alpha, round(r2_mean, 8) as r2_mean, round(r2_std, 8) as r2_std,
                 alpha = (select alpha from best) as chosen from cv""")
def cv_alpha(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_quantity", (F.col("l_extendedprice") / F.col("l_quantity")).alias("y"))
    rows = f.apply_scaler(rows, f.fit_scaler(rows, ["l_quantity"]))
    rows = fold_by_key(rows, ["l_orderkey"], bucket=portable_bucket)
    return (ridge.select_alpha(rows, ["l_quantity"], "y", ALPHAS, "fold")
            .withColumns({"r2_mean": F.round("r2_mean", 8), "r2_std": F.round("r2_std", 8)}))


LINE_TRAINING = TrainingSpec(
    categories=(), numbers=("l_quantity",), conso="l_extendedprice", surface="l_quantity",
    target_range=(10, 20000), key=("l_orderkey",), bucket=portable_bucket)


@query("""with used as (
            select l_quantity as q, l_extendedprice / l_quantity as y,
                   ('0x' || substr(md5('42|' || l_orderkey), 1, 8))::bigint % 10000 < 2000 as held_out,
                   ('0x' || substr(md5('43|' || l_orderkey), 1, 8))::bigint % 5 as part
            from lineitem
            where l_extendedprice / l_quantity > 10 and l_extendedprice / l_quantity < 20000),
          z as (select (q - avg(q) over ()) / stddev_pop(q) over () as x, y, held_out,
                       case when held_out then -1 else part end as fold from used), """ + CV_SQL + """,
          final as (
            select best.alpha, covar_pop(x, y) * count(*) / (var_pop(x) * count(*) + best.alpha) as w,
                   avg(x) as mx, avg(y) as my
            from z, best where not held_out group by best.alpha),
          errors as (
            select held_out, y, y - (my - w * mx) - w * x as e from z, final),
          splits as (
            select held_out, avg(abs(e)) as mae, sqrt(avg(e * e)) as rmse,
                   1 - sum(e * e) / (var_pop(y) * count(*)) as r2 from errors group by 1),
          row as (
            select final.alpha, t.mae, t.rmse, s.r2 as r2_train, t.r2 as r2_test,
                   s.r2 - t.r2 as gap
            from final, splits s, splits t where not s.held_out and t.held_out)
          select alpha, round(mae, 4) as mae, round(rmse, 4) as rmse,
                 round(r2_train, 6) as r2_train, round(r2_test, 6) as r2_test,
                 round(gap, 6) as gap,
                 case when r2_test > 0.95 then 'too_high' when gap > 0.15 then 'overfit'
                      when r2_test < 0.5 then 'moderate' else 'healthy' end as diagnosis from row""")
def train_evaluate(spark, sf):
    _, found, _ = train(table(spark, sf, "lineitem"), LINE_TRAINING)
    return found.select(
        "alpha", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"),
        F.round("r2_train", 6).alias("r2_train"), F.round("r2_test", 6).alias("r2_test"),
        F.round("gap", 6).alias("gap"), "diagnosis")


@query("""with used as (
            select l_quantity as q, l_extendedprice / l_quantity as y,
                   ('0x' || substr(md5('42|' || l_orderkey), 1, 8))::bigint % 10000 < 2000 as held_out,
                   ('0x' || substr(md5('43|' || l_orderkey), 1, 8))::bigint % 5 as part
            from lineitem
            where l_extendedprice / l_quantity > 10 and l_extendedprice / l_quantity < 20000),
          scale as (select avg(q) as m, stddev_pop(q) as s from used),
          z as (select (q - m) / s as x, y, held_out,
                       case when held_out then -1 else part end as fold from used, scale), """ + CV_SQL + """,
          final as (
            select covar_pop(x, y) * count(*) / (var_pop(x) * count(*) + best.alpha) as w,
                   avg(x) as mx, avg(y) as my
            from z, best where not held_out group by best.alpha)
          select l_orderkey, l_linenumber,
                 round(greatest(my + w * ((l_quantity - m) / s - mx), 0), 4) as conso_predite_m2,
                 round(greatest(my + w * ((l_quantity - m) / s - mx), 0) * l_quantity, 3)
                   as conso_totale_kwh_an
          from lineitem, final, scale""")
def train_and_score(spark, sf):
    """A model fitted, saved, loaded and used on the whole table."""
    lines, path = table(spark, sf, "lineitem"), scratch_path(spark, "model")
    scoring.save_model(train(lines, LINE_TRAINING)[0], spark, path)
    out = scoring.score_homes(lines, scoring.load_model(spark, path), "l_quantity")
    return out.select("l_orderkey", "l_linenumber",
                      F.round("conso_predite_m2", 4).alias("conso_predite_m2"),
                      F.round("conso_totale_kwh_an", 3).alias("conso_totale_kwh_an"))


@query("""with coefs as (
            select p_brand as feature,
                   avg(p_retailprice) - (select avg(p_retailprice) from part) as coef
            from part group by 1),
          ranked as (
            select feature, coef, case when coef > 0 then 'up' else 'down' end as direction,
                   row_number() over (partition by coef > 0 order by abs(coef) desc, feature) as rank,
                   floor(abs(coef) * 20 / (select max(abs(coef)) from coefs))::int as bar
            from coefs where coef <> 0)
          select feature, round(coef, 6) as coef, direction, rank, bar from ranked where rank <= 5""")
def rank_coefficients(spark, sf):
    part = table(spark, sf, "part")
    mean = part.agg(F.avg("p_retailprice")).scalar()
    coefs = mean_by(part, "p_brand", "p_retailprice").select(
        F.col("p_brand").alias("feature"), (F.col("mean") - mean).alias("coef"))
    return scoring.rank_coefficients(coefs).withColumn("coef", F.round("coef", 6))


@query("""with m as (
            select l_linenumber, avg(l_quantity) / 26 as r2_train,
                   avg(l_quantity) * l_linenumber / 150 as r2_test
            from lineitem group by 1)
          select l_linenumber, round(r2_train, 6) as r2_train, round(r2_test, 6) as r2_test,
                 round(r2_train - r2_test, 6) as gap,
                 case when r2_test > 0.95 then 'too_high'
                      when r2_train - r2_test > 0.15 then 'overfit'
                      when r2_test < 0.5 then 'moderate' else 'healthy' end as diagnosis from m""")
def diagnose(spark, sf):
    quantity = F.avg("l_quantity")
    found = scoring.diagnose(table(spark, sf, "lineitem").groupBy("l_linenumber").agg(
        (quantity / 26).alias("r2_train"),
        (quantity * F.col("l_linenumber") / 150).alias("r2_test")))
    return found.withColumns({c: F.round(c, 6) for c in ("r2_train", "r2_test", "gap")})


EVENT_MODEL = RidgeModel((
    Term("value", "value", None, 50.0, 40.0, 80.0),
    Term("event_type_error", "event_type", "error", 0.2, 0.4, 20.0),
    Term("event_type_view", "event_type", "view", 0.2, 0.4, -60.0)), 120.0)

SCORE_SQL = """with raw as (
    select event_id, event_type, user_id + 10 as surface,
           120 + 80 * (value - 50) / 40
           + 20 * (case event_type when 'error' then 1 else 0 end - 0.2::double) / 0.4::double
           - 60 * (case event_type when 'view' then 1 else 0 end - 0.2::double) / 0.4::double as p
    from events),
scored as (
    select event_id, event_type, surface, case when p < 0 then 0 else p end as conso from raw)
"""
SCORE_CLASS_SQL = """case when conso < 70 then 'A' when conso < 110 then 'B' when conso < 180 then 'C'
    when conso < 250 then 'D' when conso < 330 then 'E' when conso < 420 then 'F' else 'G' end"""


def _events(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "event_type", "value", (F.col("user_id") + 10).alias("surface"))


@query(SCORE_SQL + f"""select event_id, round(conso, 6) as conso_predite_m2,
    round(conso * surface, 4) as conso_totale_kwh_an,
    round(conso * surface * 0.2516::double, 4) as cout_annuel_eur, {SCORE_CLASS_SQL} as classe_predite,
    round(least(conso, 500), 6) as position_echelle,
    case {SCORE_CLASS_SQL} when 'A' then '#009900' when 'B' then '#33CC00' when 'C' then '#99CC00'
         when 'D' then '#FFCC00' when 'E' then '#FF9900' when 'F' then '#FF3300'
         else '#CC0000' end as couleur from scored""")
def score_homes(spark, sf):
    out = scoring.score_homes(_events(spark, sf), EVENT_MODEL, "surface")
    return out.select(
        "event_id", F.round("conso_predite_m2", 6).alias("conso_predite_m2"),
        F.round("conso_totale_kwh_an", 4).alias("conso_totale_kwh_an"),
        F.round("cout_annuel_eur", 4).alias("cout_annuel_eur"), "classe_predite",
        F.round("position_echelle", 6).alias("position_echelle"), "couleur")


@query(SCORE_SQL + """, means as (select event_type, avg(conso) as mean from scored group by 1)
    select event_id, event_type, round(conso, 6) as conso, round(mean, 6) as moyenne_classe,
           round(conso - mean, 6) as ecart_moyenne
    from scored join means using (event_type)""")
def compare_to_class(spark, sf):
    scored = scoring.score(_events(spark, sf), EVENT_MODEL, out="conso")
    out = scoring.compare_to_class(scored, "event_type", "conso",
                                   mean_by(scored, "event_type", "conso"))
    return out.select("event_id", "event_type", F.round("conso", 6).alias("conso"),
                      F.round("moyenne_classe", 6).alias("moyenne_classe"),
                      F.round("ecart_moyenne", 6).alias("ecart_moyenne"))
