"""The entry with and without the corpus queries and what they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in e.queries()))"


def counts(blocked):
    code = f"import sys; sys.modules.update(dict.fromkeys({blocked!r})); " + COUNT
    run = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    return tuple(map(int, run.stdout.split()))


@pytest.mark.parametrize("blocked", ["shardtally.llm", "corpus_pipeline", "xxhash", "tiktoken", "public_tokenizers", "regex"])
def test_event_queries_remain(blocked):
    every, checked, corpus = counts([blocked])
    assert corpus == 0 and every == checked > 100
