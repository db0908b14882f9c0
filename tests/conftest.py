import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from coursepulse.session import get_spark

    s = get_spark("local[*]", shuffle_partitions=8)
    yield s


K3 = ["code_module", "code_presentation", "id_student"]


def clicks_df(spark, rows):
    """rows: (id_student, date, sum_click[, id_site]) in course AAA/2013J."""
    full = [("AAA", "2013J", r[0], r[3] if len(r) > 3 else 1, r[1], r[2]) for r in rows]
    return spark.createDataFrame(full, "code_module string, code_presentation string, id_student long, "
                                       "id_site long, date long, sum_click long")
