import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clickfeat.session import checkpoint_dir, get_session
    s = get_session("local[4]", app="clickfeat-tests", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="clickfeat-test-", dir="/tmp")


def ads_df(spark, rows):
    """rows: (ad_id, campaign_id, group, query, category, keywords, pos)."""
    return spark.createDataFrame(
        [(a, c, g, q, k, f"{q} title", kw, p) for a, c, g, q, k, kw, p in rows],
        "ad_id bigint, campaign_id string, query_group_id bigint, query string, category string, title string, "
        "keywords array<string>, pos bigint")
