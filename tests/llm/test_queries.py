from __future__ import annotations

import pytest

from derlem.llm.oracle import ORACLE
from derlem.llm.queries import QUERIES
from tests.helpers import same

COLUMNS = {
    "p1_found": ["kayit_no_a", "kayit_no_b"], "p2_found": ["kayit_no", "rol", "bicim"], "p3_found": ["sft_kayit_no", "eval_kayit_no"], "p4_found": ["kayit_no", "kusur"], "p5_found": ["ilk_kayit_no", "kayit_no"],
    "p6_found": ["kayit_no", "alan", "gurultu"], "p7_found": ["kayit_no", "rol"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id", "subject"],
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, data, duck, name):
    same(QUERIES[name](spark, data), duck, ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, data, name):
    df = QUERIES[name](spark, data)
    found = df.collect()
    if name in COLUMNS:
        assert df.columns == COLUMNS[name] and found
        if name != "p8_ids":
            assert len(set(found)) == len(found)
