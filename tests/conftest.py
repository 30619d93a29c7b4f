import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from parcelstack.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="parcelstack-tests")
    yield s
    s.stop()


def rows_to_df(spark, schema, rows):
    """DataFrame from dicts; missing fields are null."""
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def make_feeds(spark, **tables):
    from parcelstack.sources import feeds as FD
    schemas = {"parcels_raw": FD.RAW_PARCEL, "tax": FD.TAX_CASE, "foreclosures": FD.FORECLOSURE,
               "estates": FD.ESTATE, "code_cases": FD.CODE_CASE, "code_demos": FD.CODE_CASE,
               "instruments": FD.INSTRUMENT}
    return FD.Feeds(**{k: rows_to_df(spark, s, tables.get(k, [])) for k, s in schemas.items()})
