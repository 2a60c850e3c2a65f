import json

from ridemart.__main__ import main
from ridemart.sources import testbed
from ridemart.sources.catalog import Sources
from ridemart.sources.catalog import testbed_sources as driver_sources
from tests.conftest import SF_SMALL


def test_named_sources_and_views(spark):
    src = driver_sources(SF_SMALL)
    assert src.names() == ["green_tripdata_ext", "taxi_zone_lookup", "yellow_tripdata_ext"]
    src.register_views(spark)
    n = spark.sql("SELECT count(*) AS n FROM taxi_zone_lookup").first().n
    assert n == testbed.zone_seed(spark, SF_SMALL).count()
    try:
        Sources().get(spark, "missing")
    except KeyError as e:
        assert "missing" in str(e)


def test_cli_land_and_backfill(spark, scratch, capsys):
    src, raw, target = scratch("src"), scratch("raw"), scratch("target")
    testbed.yellow(spark, SF_SMALL).write.parquet(src)
    main(["land", "--service", "yellow", "--src", src, "--src-fmt", "parquet", "--raw-root", raw])
    main(["backfill", "--service", "yellow", "--start", "1996-01", "--end", "1996-02",
          "--raw-root", raw, "--target", target])
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(first) == {"1996-01", "1996-02"} and all(v > 0 for v in first.values())
    main(["backfill", "--service", "yellow", "--start", "1996-01", "--end", "1996-02",
          "--raw-root", raw, "--target", target])
    again = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert again == {"1996-01": 0, "1996-02": 0}


def test_time_zone_named_at_submit_is_kept(spark):
    from ridemart.session import pin_time_zone
    assert pin_time_zone(spark, default="America/New_York") == "UTC"  # the test session names UTC
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
