"""The command line runs a registered query and writes its result."""

import os

import pytest

from tillsight.__main__ import main

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="generated data missing")


def test_cli_run_writes_result(spark, tmp_path, capsys):
    assert main(["list"]) == 0
    assert "q13_product_affinity" in capsys.readouterr().out
    out = str(tmp_path / "q05")
    assert main(["run", "q05_new_vs_returning", "--data", SF_DIR, "--out", out]) == 0
    assert spark.read.parquet(out).count() == 12
