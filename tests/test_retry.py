from __future__ import annotations

import os
import subprocess
import sys


def test_copy_survives_lost_tasks(tmp_path):
    os.makedirs(tmp_path / "in")
    os.makedirs(tmp_path / "out")
    contents = {f"o{n}": os.urandom(n * 700) for n in range(12)}
    for name, content in contents.items():
        (tmp_path / "in" / name).write_bytes(content)
    script = os.path.join(os.path.dirname(__file__), "retry_script.py")
    done = subprocess.run(
        [sys.executable, script, str(tmp_path)], capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert {"measure", "copy", "finish"} <= set(os.listdir(tmp_path))
    copies = tmp_path / "out" / "copy"
    assert {name: (copies / name).read_bytes() for name in os.listdir(copies)} == contents
