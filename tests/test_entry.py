"""The entry works when the training-data package and the pipeline are taken out."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys

class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("quillspark.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert "index_upsert" in e.queries() and not [n for n in e.queries() if n.startswith("op") and n[2].isdigit()]
assert "pipeline" not in e.queries() and e.oracle_sql().keys() <= e.queries().keys()
"""


def test_entry_without_the_llm_package():
    subprocess.run([sys.executable, "-c", CODE], cwd=REPO, check=True, timeout=120)


def test_nothing_else_imports_the_llm_package():
    for folder, _, files in os.walk(os.path.join(REPO, "quillspark")):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f)) as text:
                    assert "quillspark.llm" not in text.read(), f
