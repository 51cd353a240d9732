"""The entry module without the corpus operators."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_corpus_folders(tmp_path):
    """With ``llm`` gone, with or without the pipeline module, the other queries are all there."""
    copy = tmp_path / "copy"
    copy.mkdir()
    for part in ("panelweave", "workload"):
        shutil.copytree(f"{REPO}/{part}", copy / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPO}/__spark_entry__.py", copy)
    (copy / "corpus_pipeline.py").write_text("from panelweave.llm import common\n")
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 80 and not any(k[:2] == 'op' or k == 'pipeline' for k in q)"
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120,
                              env={**os.environ, "PYTHONPATH": ""})
        assert done.returncode == 0, done.stderr
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
