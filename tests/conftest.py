import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ferry.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    # a new folder for each test; never cleared with rm
    return tempfile.mkdtemp(prefix="ferry-test-")


def write_lines(folder: str, name: str, lines: list[str]) -> str:
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines))
    return path
