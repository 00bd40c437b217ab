"""The command-line jobs, end to end on files."""

import pytest

from conftest import SF_DIR, rows
from flowlantern.__main__ import main
from flowlantern.plans import medallion, queries
from flowlantern.sources import derived, writers


def test_refine_and_audit(spark, tmp_path, capsys):
    bronze = f"{tmp_path}/bronze"
    writers.write_table(queries._bronze(spark, SF_DIR), bronze, ["vlan"])
    main(["refine", "--bronze", bronze, "--silver", f"{tmp_path}/silver", "--gold", f"{tmp_path}/gold"])
    assert rows(spark.read.parquet(f"{tmp_path}/gold")) == rows(queries.gold_behaviour(spark, SF_DIR))
    main(["audit", "--bronze", bronze])
    assert "volume_by_vlan" in capsys.readouterr().out


def test_events_to_dashboard(spark, tmp_path):
    logs = f"{tmp_path}/logs"
    derived.eve_lines(derived.table(spark, SF_DIR, "events")).write.text(logs)
    for run in ("a", "b"):
        main(["ingest-events", "--logs", logs, "--table", f"{tmp_path}/trafego", "--checkpoint", f"{tmp_path}/{run}"])
    writers.write_table(queries._classificados(spark, SF_DIR), f"{tmp_path}/classificados")
    main(["dashboard", "--trafego", f"{tmp_path}/trafego", "--classificados", f"{tmp_path}/classificados", "--out", f"{tmp_path}/dash"])
    wanted = rows(queries.traffic_dashboard(spark, SF_DIR))
    assert rows(spark.read.parquet(f"{tmp_path}/dash")) == wanted
    medallion.register_views(spark.read.parquet(f"{tmp_path}/trafego"), spark.read.parquet(f"{tmp_path}/classificados"))
    assert rows(spark.sql("SELECT * FROM v_trafego_dash")) == wanted
    spark.catalog.dropTempView("v_trafego_dash")


def test_ingest_of_a_log_in_use(spark, tmp_path, capsys):
    lines = derived.eve_lines(derived.table(spark, SF_DIR, "events"))
    where = ["--logs", f"{tmp_path}/logs", "--table", f"{tmp_path}/trafego", "--checkpoint", f"{tmp_path}/check"]
    for half in ("crc32(value) % 2 = 0", "crc32(value) % 2 = 1"):
        derived.append_lines(lines.filter(half), f"{tmp_path}/logs")
        main(["ingest-log", *where])
    assert '"is_active": false' in capsys.readouterr().out
    assert rows(spark.read.parquet(f"{tmp_path}/trafego"), "hash_id") == rows(queries._trafego(spark, SF_DIR), "hash_id")


def test_errors_are_raised(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        main(["audit", "--bronze", f"{tmp_path}/none"])
    with pytest.raises(SystemExit):
        main(["refine"])
