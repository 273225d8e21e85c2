"""The entry point without the text operators, or without what they build on."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
blocked = sys.argv[1:]

class Blocked:
    def find_spec(self, name, path=None, target=None):
        if any(name == b or name.startswith(b + ".") for b in blocked):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
print(len(entry.queries()), sum(name.startswith("op") and name[2].isdigit() for name in entry.queries()))
"""


@pytest.mark.parametrize("blocked", [["reelframe.llm", "corpus_pipeline"], ["public_tokenizers"], ["regex", "zstandard"]])
def test_film_queries_stay(blocked):
    done = subprocess.run([sys.executable, "-c", SCRIPT, *blocked], cwd=ROOT, capture_output=True, text=True, timeout=60)
    assert done.returncode == 0, done.stderr
    films, texts = map(int, done.stdout.split())
    assert films >= 65 and texts == 0


def test_a_missing_film_module_is_an_error():
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, "reelframe.operators.joins"], cwd=ROOT, capture_output=True, text=True, timeout=60
    )
    assert done.returncode != 0 and "reelframe.operators.joins" in done.stderr
