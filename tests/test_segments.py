from pyspark.sql import functions as F

from tidewater.functions import segments as fs


def test_segment_follows_the_two_sides_of_the_threshold(spark):
    names = {(True, False): "persuadible", (True, True): "sure_thing", (False, False): "lost_cause", (False, True): "sleeping_dog"}
    grid = [i / 8 for i in range(9)]
    df = spark.createDataFrame([(t, c) for t in grid for c in grid], "t double, c double")
    for r in df.select("t", "c", fs.segment("t", "c").alias("s")).collect():
        assert r.s == names[r.t >= fs.THRESHOLD, r.c >= fs.THRESHOLD]


def test_each_sentence_tells_the_probabilities_it_names(spark):
    rows = [(s, 0.06 + 0.11 * k, 0.93 - 0.17 * k) for k in range(5) for s in fs.SEGMENTS]
    df = spark.createDataFrame(rows, "s string, t double, c double")
    for r in df.select("s", "t", "c", fs.reason_text("s", "t", "c").alias("text")).collect():
        gap = f"{r.t - r.c:+.0%}"
        assert r.text == fs.REASONS[r.s].replace("{t}", f"{r.t:.0%}").replace("{c}", f"{r.c:.0%}").replace("{g}", gap)


def test_percent_rounds_half_even_like_python(spark):
    df = spark.createDataFrame([(k / 400,) for k in range(401)], "p double")
    got = [r[0] for r in df.select(fs.pct_text("p")).collect()]
    assert got == [f"{k / 400:.0%}" for k in range(401)]


def test_every_segment_has_its_description_and_others_none(spark):
    df = spark.createDataFrame([(x,) for x in [*fs.SEGMENTS, "", "unheard of", None]], "s string")
    got = [r[0] for r in df.select(fs.describe_segment("s")).collect()]
    assert got == [fs.DESCRIPTIONS[x] for x in fs.SEGMENTS] + [""] * 3


def test_calibration_undoes_balanced_weights(spark):
    # balanced weights at base rate pi map true p to p_w = p(1-pi) / (p(1-pi) + (1-p)pi)
    pi, p = 0.2, 0.3
    pw = p * (1 - pi) / (p * (1 - pi) + (1 - p) * pi)
    df = spark.createDataFrame([(pw,)], "p double")
    assert abs(df.select(fs.calibrate(F.col("p"), pi)).first()[0] - p) < 1e-12
