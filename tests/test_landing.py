from urllib.parse import urlencode

from pyspark.sql import functions as F

from satlink.sources import landing as L


def test_request_urls_and_keys(spark):
    ts = F.lit("2025-01-01 12:34:56").cast("timestamp")
    aq = spark.createDataFrame([(3917, "measurements", None, "2025-01-01", None)],
                               "sensor_id long, resource string, limit string, date_from string, date_to string")
    r = L.plan_requests(aq, "openaq", ts).first()
    assert r.url == "https://api.openaq.org/v3/sensors/3917/measurements?" + urlencode(
        {"limit": "1000", "date_from": "2025-01-01"})
    assert r.landing_key == "openaq/sensors/3917/measurements/2025-01-01_na/20250101T123456Z.json.gz"
    om = spark.createDataFrame([(-26.2, 28.0)], "lat double, lon double")
    r = L.plan_requests(om, "openmeteo", ts).first()
    assert r.url == "https://api.open-meteo.com/v1/forecast?" + urlencode(
        {"latitude": "-26.2", "longitude": "28.0", "timezone": "auto", "hourly": "temperature_2m,relativehumidity_2m"})
    wk = spark.createDataFrame([("en.wikipedia", "Nelson Mandela/x", "all-access", "user", "daily", "20250101", "20250102")],
                               "project string, article string, access string, agent string, granularity string, "
                               "start string, end string")
    r = L.plan_requests(wk, "wikimedia", ts).first()
    assert r.url.endswith("/en.wikipedia/all-access/user/Nelson%20Mandela%2Fx/daily/20250101/20250102")
    assert r.landing_key == "wikimedia/en.wikipedia/Nelson%20Mandela%2Fx/20250101_20250102/20250101T123456Z.json.gz"
    gh = spark.createDataFrame([("o", "r", ""), ("o", "r", "main")], "owner string, repo string, sha string")
    assert [x.url for x in L.plan_requests(gh, "github", ts).collect()] == [
        "https://api.github.com/repos/o/r/commits", "https://api.github.com/repos/o/r/commits?sha=main"]
