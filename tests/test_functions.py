"""Edges of the column rules, worked out by hand."""

from pyspark.sql import functions as F

from tallyforge.functions import bands, numbers, scores, text, udfs
from tallyforge.plans import orders, social


def one(spark, schema, rows, expression):
    frame = spark.createDataFrame(rows, schema)
    return [r[0] for r in frame.select(expression.alias("x")).collect()]


def test_age_band_edges(spark):
    ages = [16, 18, 25, 26, 35, 36, 50, 51, 65, 66, None]
    got = one(spark, "a int", [(a,) for a in ages], bands.age_band(F.col("a")))
    assert got == ["65+", "18-25", "18-25", "26-35", "26-35", "36-50", "36-50", "51-65", "51-65", "65+", "65+"]


def test_tenure_edges(spark):
    rows = [(t,) for t in (0, 12, 13, 24, 48, 49, 73)]
    assert one(spark, "t int", rows, bands.tenure_bin(F.col("t"))) == [
        None, "New (0-12)", "Growing (12-24)", "Growing (12-24)", "Mature (24-48)", "Loyal (48-72)", None
    ]
    assert one(spark, "t int", rows, bands.tenure_step(F.col("t"))) == [
        "New", "New", "Developing", "Developing", "Established", "Loyal", "Loyal"
    ]


def test_number_text(spark):
    rows = [(v,) for v in ("29.85", " 7 ", " ", "", "abc", "1d", "1e3", "-.5", None)]
    assert one(spark, "v string", rows, numbers.number_or_null(F.col("v"))) == [
        29.85, 7.0, None, None, None, None, 1000.0, -0.5, None
    ]
    assert one(spark, "v string", rows[:3], numbers.number_or_null(F.col("v"), 0)) == [30.0, 7.0, None]
    assert one(spark, "v string", rows[2:3], numbers.number_or_zero(F.col("v"))) == [0.0]


def test_percent_of_nothing_is_null(spark):
    assert one(spark, "a int, b int", [(1, 0), (1, 3)], numbers.percent(F.col("a"), F.col("b"))) == [None, 33.33]


def test_tidy_settles_float_noise(spark):
    assert one(spark, "v double", [(12.344999999999999,), (12.345,), (-12.345,)], numbers.tidy(F.col("v"))) == [
        12.35, 12.35, -12.35
    ]


def test_sentiment_words(spark):
    texts = {
        "Love this! ": "positive", "Amazing content!": "positive", "Best post today!": "positive",
        "Fantastic work!": "positive", "This is terrible": "negative", "Worst content ever": "negative",
        "Horrible quality": "negative", "This is awful": "negative", "This is incredible!": "neutral",
        "You are the best!": "neutral", "best of the worst": "neutral", "good good bad": "neutral",
        "good bad bad great": "positive", "": "neutral",
    }
    frame = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    udfs.register(spark)
    got = frame.select(
        "t", text.sentiment(F.col("t")), udfs.classify_sentiment_udf("t"), F.expr("classify_sentiment(t)")).collect()
    for row in got:
        assert row[1] == row[2] == row[3] == texts.get(row[0], "neutral"), row


def test_risk_class_and_udf_agree_also_on_nulls(spark):
    rows = [(10000.01, 800, 0), (10000.0, 800, 0), (1.0, 499, 0), (1.0, 500, 0), (1.0, 649, 3), (1.0, 650, 3),
            (1.0, 700, 4), (None, 700, 0), (None, None, None), (20000.0, None, None)]
    frame = spark.createDataFrame(rows, "amount double, credit_score int, failed_attempts int")
    args = ["amount", "credit_score", "failed_attempts"]
    udfs.register(spark)
    got = frame.select(
        scores.risk_class(*map(F.col, args)), F.expr("classify_risk(amount, credit_score, failed_attempts)")).collect()
    expected = ["high", "medium", "high", "medium", "medium", "low", "high", "low", "low", "high"]
    assert [r[0] for r in got] == expected
    assert [r[1] for r in got] == expected


def test_risk_records(spark):
    # (amount, credit score, failed attempts) of fifteen records, ids from 1
    facts = [(15000, 720, 1), (3200, 680, 0), (8500, 610, 2), (500, 470, 1), (22000, 750, 0), (1200, 700, 5),
             (6700, 630, 1), (300, 800, 0), (11000, 490, 2), (4500, 640, 0), (950, 710, 0), (7800, 580, 3),
             (200, 750, 0), (18000, 660, 0), (2100, 455, 1)]
    rows = [(i, f"C{i:03}", float(a), c, f, "US") for i, (a, c, f) in enumerate(facts, 1)]
    frame = spark.createDataFrame(rows, "id long, customer_id string, amount double, credit_score int, "
                                        "failed_attempts int, country string")
    found = {}
    for row in orders.risk_classify(frame).collect():
        found.setdefault(row.risk_level, set()).add(row.id)
    assert found == {"high": {1, 4, 5, 6, 9, 14, 15}, "medium": {3, 7, 10, 12}, "low": {2, 8, 11, 13}}


EVENT = ("event_id string, event_type string, user_id string, post_id string, target_user_id string, "
         "hashtags array<string>, comment_text string, content_type string, video_duration_sec double, "
         "watch_time_sec double, ts timestamp_ntz")


def event(**known):
    names = [part.split()[0] for part in EVENT.split(", ")]
    return tuple(known.get(n) for n in names)


def test_validation_messages(spark):
    frame = spark.createDataFrame([
        event(event_id="e", event_type="LIKE", user_id="u"),
        event(),
        event(event_id="e", event_type="FOLLOW", user_id="u"),
        event(event_id="", event_type="WAVE", user_id="", post_id="p"),
        event(event_id="e", event_type="COMMENT", user_id="u", post_id=""),
    ], EVENT)
    got = [(r.is_valid, r.validation_errors) for r in social.validate_events(frame).collect()]
    assert got == [
        (False, "missing post_id for event type that requires it"),
        (False, "missing event_id; invalid event_type: None; missing user_id"),
        (True, None),
        (False, "missing event_id; invalid event_type: WAVE; missing user_id"),
        (False, "missing post_id for event type that requires it"),
    ]


def test_landing_and_enrichment_rules(spark):
    events = spark.createDataFrame([
        event(event_id="1", event_type="LIKE", user_id="u1", post_id="p1", watch_time_sec=float("nan")),
        event(event_id="2", event_type="LIKE", user_id="u9", post_id="p2", content_type="video", hashtags=[]),
        event(event_id="3", event_type="LIKE", user_id="u1", post_id="p3", content_type="video"),
        event(event_id="4", event_type="LIKE", user_id=None, post_id="", hashtags=["#x", "#y"]),
    ], EVENT)
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    landed = {r.event_id: r for r in social.raw_events(events, now).collect()}
    assert landed["1"].watch_time_sec is None and landed["1"].hashtags == "[]"
    assert landed["4"].post_id is None and landed["4"].user_id == "" and landed["4"].hashtags == '["#x","#y"]'
    assert str(landed["4"].event_timestamp) == "2024-02-01 00:00:00"

    users = spark.createDataFrame([("u1", "ann", "influencer")], "user_id string, username string, user_type string")
    posts = spark.createDataFrame(
        [("p1", "image", '["#a"]'), ("p2", "reel", '["#b"]'), ("p3", None, "not json"), ("", "never", '["#z"]')],
        "post_id string, content_type string, hashtags string")
    rows = social.enrich_events(events, users, posts, now).collect()
    got = {r.event_id: (r.username, r.user_type, r.content_type, r.hashtags) for r in rows}
    assert got["1"] == ("ann", "influencer", "image", '["#a"]')
    assert got["2"] == ("unknown", "regular", "reel", "[]")
    assert got["3"] == ("ann", "influencer", "video", "[]")
    assert got["4"][0:2] == ("unknown", "regular") and got["4"][3] == '["#x","#y"]'


def test_city_top_customers(spark):
    spends = {"C001": [250, 3200], "C002": [1800, 900], "C003": [450, 320], "C004": [12000, 8000],
              "C005": [5500, 1100], "C006": [7800, 3300], "C007": [150, 4400], "C008": [2200, 1750],
              "C009": [650, 5200], "C010": [9900, 2800]}
    cities = dict(zip(sorted(spends), "London Paris London Berlin Paris Berlin London Paris Berlin London".split()))
    orders_frame = spark.createDataFrame(
        [(i, c, float(a)) for i, (c, a) in enumerate((c, a) for c, many in spends.items() for a in many)],
        "order_id long, customer_id string, amount double")
    customers = spark.createDataFrame([(c, c.lower(), city) for c, city in cities.items()],
                                      "customer_id string, name string, city string")
    got = sorted((r.city, r.rank, r.customer_id, r.total_spend)
                 for r in orders.city_top_customers(orders_frame, customers).collect())
    assert got == [
        ("Berlin", 1, "C004", 20000.0), ("Berlin", 2, "C006", 11100.0), ("Berlin", 3, "C009", 5850.0),
        ("London", 1, "C010", 12700.0), ("London", 2, "C007", 4550.0), ("London", 3, "C001", 3450.0),
        ("London", 4, "C003", 770.0),
        ("Paris", 1, "C005", 6600.0), ("Paris", 2, "C008", 3950.0), ("Paris", 3, "C002", 2700.0),
    ]
