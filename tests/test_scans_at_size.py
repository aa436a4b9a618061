"""Plans whose tasks must not grow with the tables."""

import io
from contextlib import redirect_stdout

import __spark_entry__ as entry


def test_mappings_are_dealt_once(spark):
    out = io.StringIO()
    with redirect_stdout(out):
        entry.queries()["scan_3dmodelrevisionmappings"](spark, "/root/testdata/sf0.001").explain("simple")
    assert out.getvalue().count("Exchange") == 1 and "REPARTITION_BY_NUM" in out.getvalue()
