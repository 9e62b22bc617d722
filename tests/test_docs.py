"""README's coverage table and the registered queries stay in sync."""

import os
import re

from chunkwise.plans import QUERIES

from conftest import ROOT


def test_readme_coverage_lists_every_key():
    text = open(os.path.join(ROOT, "README.md")).read()
    section = text.split("## Coverage of the operator inventory")[1].split("\n## ")[0]
    keys = set()
    for row in section.splitlines():
        if row.startswith("|") and not row.startswith("|---"):
            last = row.rstrip("|").split("|")[-1]
            keys |= set(re.findall(r"`([a-z0-9_]+)`", last))
    assert keys - set(QUERIES) == set()
    assert set(QUERIES) - keys == set()
