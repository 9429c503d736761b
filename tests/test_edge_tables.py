import os

import pytest
from edge import SOURCE, empty_folder, null_folder

from strandline.plans.queries import R

pytestmark = pytest.mark.skipif(not os.path.isdir(SOURCE), reason="no test tables")


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("edge")
    return {"empty": empty_folder(spark, str(at / "empty")), "null": null_folder(spark, str(at / "null"))}


@pytest.mark.parametrize("kind", ["empty", "null"])
@pytest.mark.parametrize("name", sorted(R.queries))
def test_runs(spark, folders, name, kind):
    rows = R.queries[name](spark, folders[kind]).collect()
    if kind == "empty" and len(rows) > 1:  # a summary has one row, the rate card three
        assert name == "estimate_cost"
