"""The language-model queries that SQL can express, against DuckDB on the benchmark tables."""

import os
import sys
import zlib
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import connect, differences  # noqa: E402
from metropulse.llm import registry  # noqa: E402

SF_DIR = os.environ.get("METROPULSE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")


@pytest.mark.parametrize("key", sorted(registry.oracle_sql()))
def test_matches_sql(spark, key):
    df = registry.queries()[key](spark, SF_DIR)
    assert differences(df, connect(SF_DIR), registry.oracle_sql()[key]) == []


def test_checksum_of_the_sql():
    con = connect(SF_DIR)
    for n in (0, 7, 12345, 9876543210):
        sql = registry._CRC.format(s=f"'{n}'")
        assert con.execute(f"SELECT {sql}").fetchall()[0][0] == zlib.crc32(str(n).encode())
