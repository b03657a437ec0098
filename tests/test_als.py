"""Implicit ALS: same seed gives the same factors; observed pairs score
higher than random pairs."""

from pyspark.sql import functions as F

from feedrec.operators import als as A
from feedrec.params import DEFAULT
from feedrec.plans.queries import Ctx


def test_als_deterministic_and_sane(spark, sf):
    p = DEFAULT.with_(als_rank=4, als_iters=5, als_blocks=2)
    r = Ctx(spark, sf, p).ratings.cache()
    m1, m2 = A.als_fit(r, p), A.als_fit(r, p)
    f1 = sorted((x.id, [round(v, 5) for v in x.features]) for x in m1.userFactors.collect())
    f2 = sorted((x.id, [round(v, 5) for v in x.features]) for x in m2.userFactors.collect())
    assert f1 == f2
    observed = A.als_predict(m1, r.where(F.col("rating") > 0)).agg(F.avg("prediction")).first()[0]
    n_items = r.agg(F.max("item")).first()[0] + 1
    # ten hash-drawn items per user, minus the observed ones
    rnd = (r.select("user").distinct()
           .select("user", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k"))
           .select("user", F.pmod(F.hash("user", "k"), F.lit(n_items)).cast("int").alias("item"))
           .distinct().join(r.select("user", "item"), ["user", "item"], "left_anti")
           .withColumn("rating", F.lit(0.0)))
    unobserved = A.als_predict(m1, rnd).agg(F.avg("prediction")).first()[0]
    assert observed > unobserved
    assert A.als_mse(A.als_predict(m1, r)).first()["n"] == r.count()


def test_factors_move_once_as_floats(spark, sf):
    """Sums per user are one row a user, and events are read from a table."""
    p = DEFAULT.with_(als_rank=4, als_iters=3, als_blocks=2)
    c = Ctx(spark, sf, p)
    assert "orders" not in c.ratings_t._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in c.als_events._jdf.queryExecution().optimizedPlan().toString()
    found = A.normal_equations(c.als_model, c.ratings_t, p)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate posexplode" not in plan
    assert found.count() == c.ratings_t.select("user").distinct().count() and found.agg(F.max("residual")).first()[0] < 1e-3
    # a wrong factor leaves a residual
    assert A.normal_equations(c.als_model, c.ratings_t.withColumn("rating", F.col("rating") * 2), p).agg(F.max("residual")).first()[0] > 1e-3
