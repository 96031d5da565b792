"""The numbered queries against SQL, over whole tables; and their separation from the rest."""

import subprocess
import sys

import pytest
from compare import assert_same
from conftest import MEDIUM, REPO

from torquelake.llm.oracles import ORACLES
from torquelake.llm.queries import registered_queries


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert_same(registered_queries()[name](spark, MEDIUM), ORACLES[name], MEDIUM)


def test_nothing_else_imports_this_package():
    code = "import sys, torquelake.queries, torquelake.__main__; assert not [m for m in sys.modules if 'torquelake.llm' in m]"
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)
