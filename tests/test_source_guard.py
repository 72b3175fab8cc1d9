"""Operators stay distributed: no driver round trips on the data path."""

import pathlib
import re

PKG = pathlib.Path(__file__).resolve().parents[1] / "gaugeworks"
BANNED = [r"\.collect\(", r"\.toPandas\(", r"\.count\(\)", r"localCheckpoint"]


def test_no_collect_in_operators():
    for sub in ("operators", "functions", "sources", "streaming", "plans"):
        for path in (PKG / sub).rglob("*.py"):
            text = path.read_text()
            for pat in BANNED:
                assert not re.search(pat, text), f"{path.name}: {pat}"
