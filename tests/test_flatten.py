from satlink.operators import flatten as FL
from satlink.sources.json_scan import valid_json


def payloads(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_worldbank_edges(spark):
    p = payloads(spark, [
        '[{"page":1},[{"indicator":{"id":"SP.POP.TOTL","value":"Population"},"country":{"id":"ZA","value":"South Africa"},'
        '"countryiso3code":"ZAF","date":"2020","value":58801927,"unit":"","obs_status":"","decimal":0},'
        '{"indicator":{"id":"SP.POP.TOTL"},"countryiso3code":"ZAF","date":"2024M01","value":"abc"},'
        '{"indicator":{"id":"SP.POP.TOTL"},"countryiso3code":null,"date":"2021","value":null}]]',
        '[{"page":1},[]]',
        '[{"page":1}]',
        'not json [',
    ])
    out = FL.stg_worldbank(p).collect()
    assert len(out) == 3
    assert out[0].value == 58801927.0 and out[0].year == "2020" and out[0].decimal_places == "0"
    assert out[1].value is None and out[1].year == "2024M01"
    assert out[2].country_iso3 is None


def test_wikimedia_quoted_and_bare_numbers(spark):
    p = payloads(spark, ['{"items":[{"project":"en","article":"A_B","timestamp":"2025010100","views":12},'
                         '{"project":"en","article":"A_B","timestamp":"2025010101","views":"7"}]}',
                         '{"items":[]}', '{"other":1}'])
    assert sorted(r.views for r in FL.stg_wikimedia(p).collect()) == [7, 12]


def test_openmeteo_ragged_arrays_pad_with_null(spark):
    p = payloads(spark, ['{"latitude":-26.2,"longitude":28.0,"hourly":{"time":["t0","t1"],'
                         '"temperature_2m":[1.5,null],"relativehumidity_2m":[60]}}'])
    out = sorted(FL.stg_openmeteo(p).collect(), key=lambda r: r.ts)
    assert [(r.ts, r.temperature_2m, r.relativehumidity_2m) for r in out] == [("t0", 1.5, 60.0), ("t1", None, None)]
    assert out[0].lat == -26.2 and out[0].lon == 28.0


def test_github_verified_nested_and_default(spark):
    p = payloads(spark, ['[{"sha":"abc","commit":{"author":{"name":"N","date":"d"},"committer":{"name":"M"},'
                         '"message":"m","verification":{"verified":true}}},'
                         '{"sha":"def","commit":{"message":"x"}},'
                         '{"sha":"ghi","verification":{"verified":"TRUE"}}]', "{bad"])
    out = {r.commit_sha: r.verified for r in FL.stg_github(p).collect()}
    assert out == {"abc": True, "def": False, "ghi": True}


def test_openaq_paths(spark):
    p = payloads(spark, ['{"results":[{"locationId":1,"sensorId":3917,"parameter":"pm25","unit":"ug",'
                         '"date":{"utc":"2025-01-01T00:00:00Z"},"value":4.5,"coordinates":{"latitude":1.0,"longitude":2.0}},'
                         '{"sensorId":"x","parameter":null}]}'])
    out = FL.stg_openaq(p).collect()
    assert (out[0].sensor_id, out[0].value, out[0].lat, out[0].lon, out[0].date_utc) == (3917, 4.5, 1.0, 2.0, "2025-01-01T00:00:00Z")
    assert out[1].sensor_id is None and out[1].parameter is None


def test_usgs_coordinates_and_epoch(spark):
    p = payloads(spark, ['{"features":[{"id":"a","properties":{"title":"M 1.2","mag":1.2,"time":1735689600123,"place":"P"},'
                         '"geometry":{"coordinates":[1.0,2.0,3.0]}},'
                         '{"id":"b","properties":{"mag":"2.5","time":-5},"geometry":{"coordinates":[4.0,5.0]}}]}'])
    out = {r.feature_id: r for r in FL.stg_usgs(p).collect()}
    assert (out["a"].lon, out["a"].lat, out["a"].depth_km, out["a"].epoch_ms) == (1.0, 2.0, 3.0, 1735689600123)
    assert out["b"].depth_km is None and out["b"].epoch_ms is None and out["b"].magnitude == 2.5


def test_valid_json_filter(spark):
    p = payloads(spark, ['{"k":1}', '{"k":', "", "[1,2]", "null"])
    assert sorted(r.value for r in valid_json(p).collect()) == ['[1,2]', 'null', '{"k":1}']


def test_explode_path_drops_empty_and_null(spark):
    df = spark.createDataFrame([(1, "[1,2]"), (2, "[]"), (3, None)], "id int, js string")
    assert sorted(tuple(r) for r in FL.explode_path(df, "js", "int", keep=["id"]).collect()) == [(1, 1), (1, 2)]
