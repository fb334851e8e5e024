"""The entry module without the training-data part: whatever of it fails to import."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = """
import json, sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name in MISSING:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
print(json.dumps([sorted(entry.queries()), sorted(entry.oracle_sql())]))
"""


def asked(missing):
    out = subprocess.run([sys.executable, "-c", f"MISSING = {missing!r}\n{ASK}"], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return json.loads(out.stdout.strip().splitlines()[-1])


@pytest.mark.parametrize("missing", [["ladle.llm"], ["public_tokenizers"], ["tokenizers", "regex"], ["corpus_pipeline"]])
def test_the_rest_is_registered(missing):
    queries, oracles = asked(missing)
    own = [q for q in queries if not q.startswith("op") and q != "pipeline"]
    assert len(own) > 95 and set(oracles) <= set(queries) and "sink_typed_append" in oracles and "pipeline" not in queries
    if "ladle.llm" in missing or "public_tokenizers" in missing:
        assert own == queries
