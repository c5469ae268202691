import json
import os

from tidewater.plans.config import specs_from_dict

SF = "/root/testdata/sf0.001"


def doc(tmp, tables=("customer",), mode="historical"):
    return {"mode": mode, "created_by": "me", "source_system": "SRC", "batch_id": "1",
            "tables": [{"name": t, "source": {"kind": "path", "name": f"{SF}/{t}.parquet"},
                        "hash_column": f"STG_{t.upper()}_KEY", "lake_path": f"{tmp}/lake/{t}",
                        "target": {"kind": "path", "name": f"{tmp}/wh/{t}"}} for t in tables]}


def test_specs_from_dict_reads_env(monkeypatch, tmp_dir):
    monkeypatch.setenv("TW_PASSWORD", "secret")
    d = doc(tmp_dir)
    d["tables"][0]["source"] = {"kind": "jdbc", "name": "dbo.t",
                                "options": {"url": "jdbc:x", "password": "env:TW_PASSWORD"},
                                "partitioning": {"column": "id", "lower_bound": "0",
                                                 "upper_bound": "9", "num_partitions": 4}}
    specs, cfg = specs_from_dict(d)
    assert cfg.mode == "historical" and cfg.batch_id == "1"
    src = specs[0].source
    assert src.options["password"] == "secret" and src.partitioning.num_partitions == 4
    assert specs[0].target.partition_by == ("ETL_BATCH_ID",)


def test_cli_exit_codes(spark, tmp_dir):
    from tidewater.__main__ import main
    good = os.path.join(tmp_dir, "good.json")
    with open(good, "w") as fh:
        json.dump(doc(tmp_dir), fh)
    assert main([good, "--report", f"{tmp_dir}/report"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/report").first()["status"] == "success"
    bad_doc = doc(tmp_dir, tables=("nope",))
    bad = os.path.join(tmp_dir, "bad.json")
    with open(bad, "w") as fh:
        json.dump(bad_doc, fh)
    assert main([bad, "--mode", "incremental"]) == 1
