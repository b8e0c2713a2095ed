import os
import subprocess
import sys

import __spark_entry__ as entry

from martline.plans.cli import main as cli_main
from tests import sample_data as S
from tests.helpers import tmpdir, write


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"total_amount", "discount_amount", "final_amount", "product_product_name"} <= set(df.columns)


def test_registry_contract():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 70
    optional = [k for k in q if k == "pipeline" or k.startswith("op")]
    assert len(optional) in (0, 14)              # the training-data subpackage is there or not


def test_cli_runs_sample(spark):
    d = tmpdir()
    csv = write(d, "orders.csv", S.ORDERS_CSV)
    code = cli_main(["--orders", csv, "--customers", write(d, "c.json", S.CUSTOMERS_JSON),
                     "--products", write(d, "p.json", S.PRODUCTS_JSON), "--lake", f"{d}/lake",
                     "--warehouse", f"{d}/wh", "--no-validate"])
    assert code == 0


def test_entry_without_the_optional_subpackage():
    """With the subpackage and its pipeline gone, the entry imports and has the other queries."""
    code = ("import sys; sys.modules['martline.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
            "q = e.queries(); assert len(q) >= 70 and set(e.oracle_sql()) <= set(q); assert not [k for k in q if k == 'pipeline' or k.startswith('op')]")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
