import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from retailstream.session import local_session
    s = local_session("*", shuffle_partitions=8, app="retailstream-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def page_rows(spark, rows):
    """Page-log DataFrame from tuples (seq, ts_ms, mid, is_new, last_page_id[, page_id, item, item_type, dur])."""
    from retailstream.schemas import PAGE_LOG
    out = []
    for r in rows:
        seq, ts, mid, is_new, last = r[:5]
        page_id, item, item_type, dur = (list(r[5:]) + [None, None, None, 0])[:4] if len(r) > 5 else \
            ("home", None, None, 0)
        out.append(((mid, is_new, "v", "c", "a", None, None, None, None, None),
                    (page_id or "home", last, item, item_type, dur, None), None, ts, seq))
    return spark.createDataFrame(out, PAGE_LOG)
