import json
import os
import subprocess
import sys

SCRIPT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "scripts", "retry_group.py")


def test_grouping_survives_task_retry():
    out = subprocess.run([sys.executable, SCRIPT], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    got = dict(json.loads(out.stdout.strip().splitlines()[-1]))
    hot = sorted(i % 500 for i in range(3000))
    assert got["hot"] == ", ".join(str(v) for v in hot)
    for j in range(7):
        assert got[f"c{j}"] == ", ".join(str(i) for i in range(300) if i % 7 == j)
