"""Sketches by part, schema history, date projection, curve points, hashed categories, one read of each raw table."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import sketches as sk
from tidewater.operators import stats as st
from tidewater.operators import uplift as up
from tidewater.session import Params
from tidewater.sources import catalog
from tidewater.sources.io import read_dates, write_by_date, write_full


def temp(name):
    return tempfile.mkdtemp(prefix=f"tw-{name}-")


# ---------------------------------------------------------------- sketches

def numbers(spark, n=60_000):
    """Values of three groups over ten parts; the first group holds two thirds of the rows."""
    g = F.when(F.col("id") % 3 < 2, "a").when(F.col("id") % 30 == 2, F.lit(None)).otherwise("c")
    return spark.range(n).select(g.alias("g"), (F.col("id") % 10).alias("day"), F.pmod(F.hash("id"), F.lit(5000)).cast("double").alias("x"),
                                 F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 11 == 0, F.lit(float("nan"))).otherwise(
                                     F.exp(F.pmod(F.hash("id", F.lit(1)), F.lit(1000)) / 100)).alias("y"))


def test_merged_quantile_sketches_keep_their_rank_error(spark):
    df, path = numbers(spark), temp("kll") + "/s"
    sk.store(sk.quantile_sketches(df.where("day < 6"), ["g"], F.col("day"), ["x", "y"]), path)
    sk.store(sk.quantile_sketches(df.where("day >= 5"), ["g"], F.col("day"), ["x", "y"]), path)  # day 5 comes again
    e = sk.quantiles(spark.read.parquet(path), ["g"], [0.01, 0.25, 0.5, 0.9])
    want = {(r.g, c): r[c] for r in df.groupBy("g").agg(F.count("x").alias("x"), F.count(F.when(~F.isnan("y"), F.col("y"))).alias("y")).collect()
            for c in ("x", "y")}
    assert {(r.g, r.columna): r.n for r in e.collect()} == want and len(want) == 6
    gaps = sk.rank_gaps(df.select("g", "x", "y"), ["g"], e).collect()
    assert len(gaps) == 24 and max(r.distancia for r in gaps) <= 2 * sk.quantile_rank_error()
    assert max(r.distancia for r in gaps) > 0  # sketches, not all values
    # the sketches of a part do not grow with its rows
    size = lambda d: d.select(F.length("boceto").alias("n")).agg(F.max("n")).first()[0]
    small, large = (sk.quantile_sketches(numbers(spark, n), ["g"], F.lit("p"), ["x"]) for n in (60_000, 600_000))
    assert size(large) < 1.5 * size(small)


def test_small_parts_give_exact_quantiles(spark):
    df = spark.createDataFrame([(d, float(v)) for d in range(4) for v in range(d * 10, d * 10 + 10)], "d int, x double")
    e = sk.quantiles(sk.quantile_sketches(df, [], F.col("d"), ["x"]), [], [0.5, 1.0]).collect()
    assert {r.p: (r.n, r.valor) for r in e} == {0.5: (40, 19.0), 1.0: (40, 39.0)}
    assert sk.quantiles(sk.quantile_sketches(df.limit(0), [], F.col("d"), ["x"]), [], [0.5]).count() == 0


def test_merged_distinct_sketches(spark):
    df = spark.range(200_000).select((F.col("id") % 50_000).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id") % 100).alias("b"),
                                     (F.col("id") % 12).cast("string").alias("month"))
    path = temp("hll") + "/s"
    sk.store(sk.distinct_sketches(df, F.col("month"), ["a", "b"]), path)
    sk.store(sk.distinct_sketches(df.where("month = '3'"), F.col("month"), ["a", "b"]), path)
    got = {r.columna: r.n_estimado for r in sk.distinct_counts(spark.read.parquet(path)).collect()}
    assert abs(got["a"] - 50_000) <= 4 * sk.distinct_error() * 50_000 and abs(got["b"] - 50) <= 2
    assert spark.read.parquet(path).count() == 18  # odd months hold no value of b


# ---------------------------------------------------------------- schema history

def test_schema_changes_are_followed_and_logged(spark):
    base, zone = temp("catalog"), f"zona_{os.getpid()}_{np.random.default_rng().integers(1 << 30)}"
    where, t = {"t": f"{base}/t"}, f"{zone}.t"
    register = lambda: [tuple(r)[2:] for r in catalog.register(spark, zone, where, f"{base}/h").collect()]
    write_full(spark.sql("SELECT 1 AS a, 'x' AS b"), where["t"])
    assert register() == [(1, "a", "agregada", None, "int"), (1, "b", "agregada", None, "string")]
    assert register() == []
    write_full(spark.sql("SELECT 2L AS a, 1.5D AS c"), where["t"])
    assert register() == [(2, "a", "cambio_de_tipo", "int", "bigint"), (2, "b", "eliminada", "string", None),
                          (2, "c", "agregada", None, "double")]
    assert [tuple(r) for r in spark.table(t).select("a", "b", "c").collect()] == [(2, None, 1.5)]
    assert register() == []  # a column that is gone is reported once
    write_full(spark.sql("SELECT 3L AS a, 'y' AS b, 2.5D AS c, TRUE AS d"), where["t"])
    assert register() == [(3, "b", "restaurada", "string", "string"), (3, "d", "agregada", None, "boolean")]
    spark.sql(f"DROP TABLE {t}")  # a new session's catalog: the table comes back as it was declared
    assert register() == [] and spark.table(t).columns == ["a", "b", "c", "d"]
    assert [tuple(r) for r in spark.table(t).collect()] == [(3, "y", 2.5, True)]
    log = catalog.read_log(spark, zone, "t", f"{base}/h")
    assert log.count() == 7 and {r.columna for r in log.where("cambio = 'eliminada'").collect()} == {"b"}


def test_a_registration_that_dies_is_made_up_for(spark, monkeypatch):
    base, zone = temp("catalog"), f"zona_{np.random.default_rng().integers(1 << 60)}"
    where = {"t": f"{base}/t"}
    write_full(spark.sql("SELECT 1 AS a"), where["t"])
    catalog.register(spark, zone, where, f"{base}/h")
    write_full(spark.sql("SELECT 1 AS a, 2 AS b"), where["t"])

    def dies(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(catalog, "write_small", dies)
    with pytest.raises(RuntimeError):
        catalog.register(spark, zone, where, f"{base}/h")
    monkeypatch.undo()
    assert [r.columna for r in catalog.register(spark, zone, where, f"{base}/h").collect()] == ["b"]
    assert catalog.read_log(spark, zone, "t", f"{base}/h").count() == 2 and spark.table(f"{zone}.t").columns == ["a", "b"]


# ---------------------------------------------------------------- date projection

def test_a_date_range_opens_its_own_folders(spark):
    path = temp("dates") + "/scores"
    days = ["2001-01-01", "2001-01-03", "2001-02-01"]
    df = spark.createDataFrame([(f"c{i}", d) for d in days for i in range(3)], "cliente_id string, dt string")
    write_by_date(df, path)
    os.makedirs(f"{path}/dt=1999-01-01/broken.parquet")  # a folder that a listing of all dates would stumble over
    one = read_dates(spark, path, df.schema, "2001-01-03", "2001-01-03")
    assert one.schema == df.schema and len(one.inputFiles()) > 0 and all("dt=2001-01-03" in f for f in one.inputFiles())
    index = one._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation().location()
    assert index.rootPaths().size() == 1
    some = read_dates(spark, path, df.schema, "2001-01-01", "2001-01-31")
    assert sorted((r.dt, r.cliente_id) for r in some.collect()) == [(d, f"c{i}") for d in days[:2] for i in range(3)]
    assert read_dates(spark, path, df.schema, "2001-01-01", "2001-02-01", step_days=31).count() == 6
    empty = read_dates(spark, path, T.StructType([df.schema["cliente_id"]]), "2010-01-01", "2010-01-09")
    assert empty.count() == 0 and empty.columns == ["cliente_id", "dt"]


# ---------------------------------------------------------------- curve points

def area(rows):
    x, y = [0.0, *[r.fraccion for r in rows]], [0.0, *[r.qini - r.aleatorio for r in rows]]
    return sum((b - a) * (u + v) / 2 for a, b, u, v in zip(x, x[1:], y, y[1:]))


def test_thinned_curve(spark):
    rng = np.random.default_rng(4)
    w, s = rng.integers(0, 2, 20_000), rng.random(20_000)
    y = (rng.random(20_000) < 0.2 + 0.3 * w * s).astype(int)
    df = spark.createDataFrame(list(zip(s.tolist(), w.tolist(), y.tolist())), "s double, w int, y int")
    whole, thin = (sorted(d.collect(), key=lambda r: r.fraccion) for d in (st.qini_curve(df, "s", "y", "w"), st.qini_points(df, "s", "y", "w", 50)))
    assert len(whole) == 20_000 and len(thin) == 51 and set(thin) <= set(whole) and thin[-1] == whole[-1]
    assert max(b.fraccion - a.fraccion for a, b in zip(thin, thin[1:])) <= 1 / 50 + 1e-9
    assert abs(area(thin) - area(whole)) < 0.01 and area(whole) > 0.02
    tied = spark.createDataFrame([(1.0, k % 2, 1) for k in range(100)], "s double, w int, y int")
    assert [r.fraccion for r in st.qini_points(tied, "s", "y", "w").collect()] == [1.0]


# ---------------------------------------------------------------- hashed categories

def test_a_million_labels_leave_nothing_in_the_model(spark):
    sizes = []
    for n in (1000, 1_000_000):
        df = spark.range(n).select(F.concat(F.lit("label "), "id").alias("c"), F.rand(1).alias("x"))
        fitted = up.preprocessor(["x"], ["c"], 256).fit(df)
        path = temp("hash")
        fitted.write().overwrite().save(path)
        sizes.append(sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs))
    assert abs(sizes[1] - sizes[0]) < 2000
    rows = fitted.transform(spark.createDataFrame([(None, 1.0), ("new", 0.5), (None, 0.1)], "c string, x double")).collect()
    assert all(r.features.size == 257 and sum(r._hash.toArray()) == 1 for r in rows) and rows[0]._hash == rows[2]._hash
    assert abs(up.collision_share(1000, 256) - 0.98) < 0.01 and up.collision_share(2, 1 << 20) < 1e-5


def test_learner_with_hashed_categories(spark):
    """The effect hangs on a free-text category: the hashed learner finds it as the one of code lists does."""
    rng = np.random.default_rng(7)
    n = 3000
    city, w, num = rng.integers(0, 8, n), rng.integers(0, 2, n), rng.random(n)
    y = (rng.random(n) < 0.2 + 0.6 * w * (city % 2)).astype(int)
    rows = [(f"City {c}", float(x), int(t), int(v)) for c, x, t, v in zip(city, num, w, y)]
    df = spark.createDataFrame(rows, "feat_ciudad string, x double, tratado int, aumento_uso int")
    p = Params(n_trees=40, max_depth=10, numeric_features=("x",), categorical_features=("feat_ciudad",))
    scores = []
    for buckets in (None, 64):
        m = up.fit_tlearner(df, Params(**{**p.__dict__, "category_buckets": buckets}))
        by = {r.feat_ciudad: r.s for r in m.transform(df, True).groupBy("feat_ciudad").agg(F.avg("score_uplift").alias("s")).collect()}
        scores.append([by[f"City {c}"] for c in range(8)])
    for found, gap in zip(scores, (0.3, 0.05)):  # a split sees few of many hashed columns: smaller effects, the same cities
        assert min(found[1::2]) > max(found[::2]) + gap


# ---------------------------------------------------------------- the standardise job

def test_the_job_reads_each_raw_table_once(spark):
    from tidewater.plans import jobs
    from tidewater.plans.clean import report_all, customer_keys
    from tidewater.sources.bronze import bronze_tables
    read = []

    class Counted(dict):
        def __getitem__(self, name):
            read.append(name)
            return super().__getitem__(name)

    b = bronze_tables(spark, "/root/testdata/sf0.001")
    names = ["clientes", "tarjetas", "transacciones", "interacciones_marketing", "catalogo_comercios"]
    base, plain = temp("job"), {n: b[n] for n in names}
    report = jobs.standardize(spark, Counted(plain), f"{base}/silver", f"{base}/quarantine")
    assert sorted(read) == sorted(names)
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, report_all(plain, customer_keys(plain["clientes"])).collect()))
    from tidewater.plans.clean import clean_customers
    a, c = spark.read.parquet(f"{base}/silver/clientes"), clean_customers(plain["clientes"])
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0
