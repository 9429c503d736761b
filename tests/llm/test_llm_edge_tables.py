import os

import pytest
from edge import SOURCE, empty_folder, null_folder

from strandline.llm.queries import R

pytestmark = pytest.mark.skipif(not os.path.isdir(SOURCE), reason="no test tables")


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("edge")
    out = {"empty": empty_folder(spark, str(at / "empty")), "null": null_folder(spark, str(at / "null"))}
    # the small reference tables are given; only what they are applied to is empty
    for t in ("container_sizes", "mix_targets", "canon_terms", "subjects"):
        for f in out.values():
            spark.read.parquet(f"{SOURCE}/{t}.parquet").write.mode("overwrite").parquet(f"{f}/{t}.parquet")
    return out


@pytest.mark.parametrize("kind", ["empty", "null"])
@pytest.mark.parametrize("name", sorted(R.queries))
def test_runs(spark, folders, name, kind):
    rows = R.queries[name](spark, folders[kind]).collect()
    if kind == "empty":
        assert not rows or name in ("p9_shares",)
