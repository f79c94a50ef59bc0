"""Statistical models over events, embeddings and facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtable.models import growth, irt, kmeans, mixed, sem
from loomtable.operators.windows import order_statistics
from loomtable.plans.base import Plans
from loomtable.sources.tables import table

query = Plans()
QUERIES, SQL = query.queries, query.sql

_ITEMS = ["click", "error", "purchase", "signup", "view"]


def answers(spark, folder):
    """(user_id, one 0/1 column per kind of event): whether a user's mean is above that of all; users lacking a kind are left out."""
    e = table(spark, folder, "events")
    wide = e.groupBy("user_id").pivot("event_type", _ITEMS).agg(F.avg("value")).na.drop()
    cut = order_statistics(wide, _ITEMS, [0.5])  # one row
    return wide.crossJoin(F.broadcast(cut)).select("user_id", *((F.col(c) > F.col(f"{c}_0")).cast("int").alias(c) for c in _ITEMS))


_WIDE = "wide AS (SELECT user_id, " + ", ".join(f"avg(value) FILTER (WHERE event_type = '{c}') AS \"{c}\"" for c in _ITEMS) + " FROM events GROUP BY 1), full_ AS (SELECT * FROM wide WHERE " + " AND ".join(f'"{c}" IS NOT NULL' for c in _ITEMS) + ")"
_ANSWERS = f"{_WIDE}, cut AS (SELECT " + ", ".join(f'median("{c}") AS "m_{c}"' for c in _ITEMS) + " FROM full_), ans AS (SELECT user_id, " + ", ".join(f'("{c}" > "m_{c}")::INT AS "{c}"' for c in _ITEMS) + " FROM full_, cut)"


@query("binarised_items", f"WITH {_ANSWERS} SELECT * FROM ans")
def binarised_items(spark, folder):
    return answers(spark, folder)


@query("item_shares", f"WITH {_ANSWERS} SELECT " + ", ".join(f'round(avg("{c}"), 6) AS "{c}"' for c in _ITEMS) + " FROM ans")
def item_shares(spark, folder):
    return answers(spark, folder).agg(*(F.round(F.avg(c), 6).alias(c) for c in _ITEMS))


_LONG = " UNION ALL ".join(f"SELECT user_id, '{c}' AS item, \"{c}\" AS u, " + " + ".join(f'"{d}"' for d in _ITEMS if d != c) + f" AS rest FROM ans" for c in _ITEMS)
_CELLS = "sum(f * u) AS a, sum(f * (1 - u)) AS b, sum((1 - f) * u) AS c, sum((1 - f) * (1 - u)) AS d"


@query(
    "mantel_haenszel",
    f"WITH {_ANSWERS}, lng AS ({_LONG}), cells AS (SELECT item, rest, {_CELLS} FROM (SELECT *, (user_id % 2 = 0)::INT AS f FROM lng) GROUP BY 1, 2), big AS (SELECT *, (a + b + c + d)::DOUBLE AS t FROM cells WHERE a + b + c + d >= 2), "
    "sums AS (SELECT item, sum(a * d / t) AS num, sum(b * c / t) AS den, sum(a)::DOUBLE AS seen, sum((a + b) * (a + c) / t) AS expected, sum((a + b) * (c + d) * (a + c) * (b + d) / (t * t * (t - 1))) AS var FROM big GROUP BY 1), "
    "r AS (SELECT *, CASE WHEN num > 0 AND den > 0 THEN num / den END AS o, greatest(abs(seen - expected) - 0.5, 0) AS gap FROM sums), "
    "x AS (SELECT item, round(o, 6) AS odds_ratio, round(CASE WHEN var > 0 THEN gap * gap / var END, 6) AS chi2, round(-2.35 * ln(o), 6) AS delta FROM r) "
    "SELECT *, CASE WHEN delta IS NULL THEN 'NA' WHEN abs(delta) < 1.0 THEN 'A' WHEN abs(delta) < 1.5 THEN 'B' ELSE 'C' END AS class FROM x",
)
def mantel_haenszel(spark, folder):
    """Even against odd users, in strata of the other items' sum."""
    a = answers(spark, folder)
    total = sum((F.col(c) for c in _ITEMS[1:]), F.col(_ITEMS[0]))
    items = F.explode(F.array(*(F.struct(F.lit(c).alias("item"), F.col(c).alias("u"), (total - F.col(c)).alias("rest")) for c in _ITEMS)))
    long = a.select((F.col("user_id") % 2 == 0).alias("focal"), items.alias("x")).select("focal", "x.item", "x.u", "x.rest")
    return irt.mantel_haenszel(long, "item", "u", "focal", "rest")


@query("kmeans_assign")
def kmeans_assign(spark, folder):
    e = table(spark, folder, "embeddings")
    centers, _ = kmeans.fit(e, "embedding", kmeans.initial_centers(e, "vec_id", "embedding", 8))
    return kmeans.assign(e, "vec_id", "embedding", centers)


@query("kmeans_profile")
def kmeans_profile(spark, folder):
    """Size, share, most frequent label and first members of each cluster."""
    e = table(spark, folder, "embeddings")
    c = kmeans_assign(spark, folder).join(e.select("vec_id", "label"), "vec_id")
    n = c.groupBy("cluster", "label").agg(F.count("*").alias("k"))
    top = n.groupBy("cluster").agg(F.sum("k").alias("n"), F.max_by("label", F.struct("k", -F.col("label"))).alias("top_label"))
    total = top.agg(F.sum("n").alias("t"))
    return top.crossJoin(F.broadcast(total)).select("cluster", "n", F.round(F.col("n") / F.col("t"), 6).alias("share"), "top_label")


@query("kmeans_selection")
def kmeans_selection(spark, folder):
    rows = kmeans.select_k(table(spark, folder, "embeddings"), "vec_id", "embedding", range(3, 9))
    return spark.createDataFrame([(k, round(w, 6), round(c, 6)) for k, w, c in rows], "k int, wss double, criterion double")


@query("mixed_model")
def mixed_model(spark, folder):
    """Order prices by customer, with the customer's balance: null model and model, with ICC and pseudo R2."""
    o, c = table(spark, folder, "orders"), table(spark, folder, "customer")
    rows = o.join(c, o.o_custkey == c.c_custkey).select("o_custkey", (F.col("o_totalprice") / 1000).alias("y"), (F.col("c_acctbal") / 1000).alias("balance"), F.month("o_orderdate").cast("double").alias("month"))
    null, full = mixed.fit(rows, "o_custkey", "y", []), mixed.fit(rows, "o_custkey", "y", ["balance", "month"])
    out = [(m, t["term"], *(round(t[k], 6) for k in ("estimate", "error", "z", "p")), round(f["icc"], 6), round(mixed.pseudo_r2(null, f), 6), f["groups"], f["rows"]) for m, f in (("null", null), ("full", full)) for t in f["terms"]]
    return spark.createDataFrame(out, "model string, term string, estimate double, error double, z double, p double, icc double, pseudo_r2 double, n_groups long, n_rows long")


@query("item_response")
def item_response(spark, folder):
    """Two-parameter items and the likelihood ratio against the one-parameter model."""
    u, n = irt.patterns(answers(spark, folder), _ITEMS)
    two, one = irt.fit(u, n), irt.fit(u, n, two_parameters=False)
    lr = max(0.0, 2 * (two["log_likelihood"] - one["log_likelihood"]))
    out = [(c, round(float(two["a"][k]), 6), round(float(two["b"][k]), 6), round(lr, 6), round(irt.chi2_tail(lr, len(_ITEMS)), 6)) for k, c in enumerate(_ITEMS)]
    return spark.createDataFrame(out, "item string, discrimination double, difficulty double, lr double, p double")


@query("factor_model")
def factor_model(spark, folder):
    """Three factors of two indicators each over order lines."""
    l = table(spark, folder, "lineitem").select("l_quantity", (F.col("l_extendedprice") / 1000).alias("price"), "l_discount", "l_tax", F.dayofyear("l_shipdate").alias("day"), F.month("l_shipdate").alias("month"))  # noqa: E741
    columns = ["l_quantity", "price", "l_discount", "l_tax", "day", "month"]
    moments = l.agg(*(F.avg(c).alias(f"m_{c}") for c in columns), *(F.stddev_pop(c).alias(f"s_{c}") for c in columns))  # one row
    z = l.crossJoin(F.broadcast(moments)).select(*(((F.col(c) - F.col(f"m_{c}")) / F.nullif(f"s_{c}", F.lit(0.0))).alias(c) for c in columns))
    s, n = sem.covariances(z, columns)
    f = sem.fit(s, n, [[0, 1], [2, 3], [4, 5]], [(1, 0), (2, 0)])
    return spark.createDataFrame([(k, round(float(f[k]), 4)) for k in ("chi2", "df", "p", "cfi", "tli", "rmsea", "srmr")], "measure string, value double")


@query("growth_models")
def growth_models(spark, folder):
    """Four growth models over a simulated panel with known slopes."""
    fits = growth.fit_all(growth.panel(spark))
    return spark.createDataFrame([(m, t["term"], round(t["estimate"], 6), round(t["error"], 6), round(f["icc"], 6)) for m, f in fits.items() for t in f["terms"]], "model string, term string, estimate double, error double, icc double")
