"""Workers must be able to import the package wherever the driver was started."""

import os
import subprocess
import sys

import pandas as pd
from pyspark import cloudpickle

from mentionlake.operators import resolve
from mentionlake.session import bundle
from mentionlake.workload.queries import stub_scorer

#: A worker's view: the shipped zip is the only place that has the package.
CODE = """
import pickle, sys
sys.path[:] = [sys.argv[1], *(p for p in sys.path if p)]
ratio, scorer = (pickle.load(open(name, "rb")) for name in sys.argv[2:4])
import mentionlake
assert mentionlake.__file__.startswith(sys.argv[1]), mentionlake.__file__
import pandas as pd
print(list(ratio(pd.Series(["apple", "zzz"]), pd.Series(["aple", "aple"]))), len(list(scorer()(pd.DataFrame({"body": ["a body"], "comment_id": ["c1"]})))))
"""


def plain(env):
    return {k: v for k, v in env.items() if not k.startswith(("PYTHONPATH", "PYSPARK"))}


def test_functions_unpickle_where_only_the_zip_is(spark, tmp_path):
    ratio = resolve._blocks_ratio(0.5).func
    for name, value in (("ratio", ratio), ("scorer", stub_scorer)):
        (tmp_path / name).write_bytes(cloudpickle.dumps(value))
    out = subprocess.run(
        [sys.executable, "-c", CODE, bundle(), "ratio", "scorer"], cwd=tmp_path, env=plain(os.environ), capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-3000:]
    want = list(ratio(pd.Series(["apple", "zzz"]), pd.Series(["aple", "aple"])))
    assert out.stdout.split() == f"{want} 1".split()


def test_the_zip_holds_every_module():
    import zipfile

    root = os.path.dirname(os.path.dirname(os.path.abspath(resolve.__file__)))
    files = {os.path.relpath(os.path.join(f, n), os.path.dirname(root)) for f, _, names in os.walk(root) for n in names if n.endswith(".py")}
    assert set(zipfile.ZipFile(bundle()).namelist()) == files
