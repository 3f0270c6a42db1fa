from types import SimpleNamespace

import pytest

from barsieve.scratch import scratch_path, scratch_root


def _session(**conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key.replace(".", "_"), default)))


def test_the_folder_of_the_session_is_used(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{root}/barsieve/x-")
    assert scratch_root(_session(spark_checkpoint_dir="s3a://bucket/shared/")) == "s3a://bucket/shared"


def test_only_local_mode_makes_its_own():
    assert scratch_root(_session(spark_master="local[4]")) == scratch_root(_session(spark_master="local[4]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(_session(spark_master="yarn"))
