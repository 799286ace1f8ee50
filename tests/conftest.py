from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from geoscribe.session import build_session  # noqa: E402

import fixtures  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="geoscribe-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("posts")
    (d / "posts.tsv").write_text("\n".join(fixtures.post_lines()) + "\n", encoding="utf-8")
    (d / "stop_words.txt").write_text("\n".join(fixtures.STOP_WORDS) + "\n", encoding="utf-8")
    return d


@pytest.fixture(scope="session")
def recs():
    return fixtures.parse(fixtures.post_lines())


@pytest.fixture(scope="session")
def posts(spark, data_dir):
    from geoscribe.sources import scan_delimited

    return scan_delimited(spark, str(data_dir / "posts.tsv"))
