from pyspark.sql import functions as F

from palimpsest import functions as fn


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first()[0]


def test_parses_plain_timestamp_as_utc(spark):
    assert one(spark, "2026-05-31 23:59:55", fn.instant) == 1780271995


def test_normalizes_supported_spellings(spark):
    for raw in ("2026-05-31 23:59:55", "2026-05-31T23:59:55Z", "2026-05-31T23:59:55.123Z", "2026-06-01T01:59:55+02:00", "2026-05-31T20:29:55-03:30"):
        assert one(spark, raw, fn.normalize_timestamp) == "2026-05-31T23:59:55Z"


def test_no_instant(spark):
    for raw in (None, "", "n/a", "~2026-05-31", "2026-02-30T00:00:00Z", "2026-05-31T24:00:00Z", "2026-05-31T23:59:60Z", "2026-05-31", "2026-05-31T23:59:55", "2026-05-31 23:59:55Z", "2026-13-01 00:00:00", "2026-05-31T10:00:00+24:00", " 2026-05-31 23:59:55"):
        assert one(spark, raw, fn.instant) is None, raw
        assert one(spark, raw, fn.normalize_timestamp) is None


def test_session_zone_does_not_matter(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, "2026-05-31 23:59:55", fn.normalize_timestamp) == "2026-05-31T23:59:55Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_body_lines(spark):
    cases = {"a\r\nb\n\nc": " a\n b\n \n c\n", "a\n": " a\n", "": "", "a\n\n": " a\n \n", "a\r": " a\r\n", "\n": " \n", "a\rb": " a\rb\n", None: ""}
    for raw, want in cases.items():
        assert one(spark, raw, fn.body) == want, raw


def test_ids(spark):
    for raw, want in (("12", 12), ("+7", 7), ("-1", 0), ("x", 0), (None, 0), ("", 0), ("99999999999999999999", 0)):
        assert one(spark, raw, fn.parse_id) == want
    for raw, want in (("-2", -2), ("118", 118), ("x", 0), (None, 0)):
        assert one(spark, raw, fn.parse_ns) == want


def test_names_and_escapes(spark):
    for raw, want in (("a.xml.bz2", "a.xml.mwrev.zst"), ("a.xml", "a.mwrev.zst"), ("a.7z", "a.mwrev.zst"), ("a", "a.mwrev.zst")):
        assert one(spark, raw, fn.output_name) == want
    assert one(spark, "a\tb\\n\n\r\0c", fn.copy_escape) == "a\\tb\\\\n\\n\\rc"
    assert one(spark, "HTTPS://EN.Example.org/x", fn.url_host) == "en.example.org"
    assert one(spark, "not a url", fn.url_host) is None
    assert one(spark, "2024-01-02T03:04:05Z", fn.daily_path) == "recentchanges/2024-01-02.mwrev.zst"
    assert one(spark, "2024", fn.date_prefix) is None
