import json

import pytest

from quayside import __main__ as command
from quayside.config import Tables


def test_arguments():
    args = command.parser().parse_args(["days", "--root", "r", "--landing", "l", "--pages", "p", "--routes-by", "positions", "--on-missing", "zero", "--finder", "math:hypot"])
    assert (args.routes_by, args.on_missing) == ("positions", "zero")
    import math

    assert command.finder_named(args.finder) is math.hypot and command.finder_named(None) is None
    with pytest.raises(SystemExit):
        command.parser().parse_args(["days", "--root", "r"])


def test_run_log(spark, tmp_path):
    results = [{"unique_id": f"model.x.{i}", "status": "success", "execution_time": 1.0} for i in range(3)]
    (tmp_path / "run.json").write_text(json.dumps({"metadata": {"run_id": "a", "generated_at": "2025-01-01T10:00:00Z"}, "results": results}))
    root = str(tmp_path / "root")
    command.main(["run-log", "--root", root, "--documents", str(tmp_path / "run.json")])
    assert spark.read.parquet(Tables(root).run_results).count() == 3
