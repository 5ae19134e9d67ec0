from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import local_session

    s = local_session(cores=8, shuffle_partitions=8, app="tidemark-tests")
    # tests set their own shared folder only because none is configured here
    if not s.conf.get("spark.checkpoint.dir", None):
        d = str(tmp_path_factory.mktemp("ckpt"))
        s.sparkContext.setCheckpointDir(d)
        s.conf.set("spark.checkpoint.dir", d)
    yield s
    s.stop()


def rows(df, order=None):
    cols = order or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is not None, v) for v in t))
