import os

import pytest
from compare import DATA, differences

from strandline.llm.queries import R

FOLDER = f"{DATA}/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(R.sql))
def test_like_sql(spark, name):
    assert differences(spark, R.queries[name], R.sql[name], FOLDER) is None


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(set(R.queries) - set(R.sql)))
def test_runs(spark, name):
    df = R.queries[name](spark, FOLDER)
    rows = df.collect()
    assert rows and len({tuple(r) for r in rows}) == len(rows)
