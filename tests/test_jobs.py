import json
import os

import pytest

from skytide import jobs
from skytide.naming import Naming
from skytide.session import scratch_path
from test_streaming import SCHEMA, TOPIC, add_messages, announce, candids


def test_transfer_topics_and_backlog(spark, path, capsys):
    log, archive = path, scratch_path(spark, "cli")
    add_messages(spark, log, 0, 12)
    announce(spark, log)
    shared = ["--log-path", log, "--namespace", "night"]
    move = ["transfer", *shared, "--topic", TOPIC, "--archive", archive, "--checkpoints", archive + "-cp"]
    jobs.main([*move, "--limit", "5", "--dump-schemas", archive + "-schemas"])
    assert "5 messages moved" in capsys.readouterr().out
    assert json.loads(spark.read.parquet(archive + "-schemas").first().schema_json) == SCHEMA
    jobs.main(["backlog", *shared, "--topics", TOPIC, "--runs", archive + "-cp/runs"])
    assert f"{TOPIC} | - | 5 | 7" in capsys.readouterr().out  # every row, as plain lines
    jobs.main([*move, "--limit", "100"])
    assert candids(spark, archive) == list(range(12))
    jobs.main(["topics", *shared, "--service", "datatransfer"])
    assert TOPIC in capsys.readouterr().out
    with pytest.raises(SystemExit):
        jobs.main([*move, "--out-format", "csv"])


def test_stream_until_drained(spark, path, capsys):
    schemas = scratch_path(spark, "schemas")
    os.makedirs(schemas)
    with open(f"{schemas}/{Naming('night').schema_file('2.7')}", "w") as out:
        json.dump(SCHEMA, out)
    add_messages(spark, path, 0, 6, "one", "2.7")
    archive = scratch_path(spark, "stream")
    jobs.main([
        "stream", "--log-path", path, "--namespace", "night", "--topics", "one", "--schemas", schemas,
        "--checkpoint", archive + "-cp", "--archive", archive, "--until-drained", "--display",
    ])
    assert spark.read.parquet(archive).count() == 6
