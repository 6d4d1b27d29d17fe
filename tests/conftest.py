from __future__ import annotations

import datetime as dt
import os
import sys
import textwrap

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from phenolith.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="phenolith-tests")
    yield s


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def write_definition(folder, name: str, body: str, meta: str = "") -> None:
    text = textwrap.dedent(f"""\
    metadata:
      phenotype: {name}
      group: Test
      is_cancer: '0'
      is_adult: '1'
      variable_name: {name}
      gender: [male, female]
      authors: test
      uuid: {name}-uuid
      priority: 1
      ontologies: {{}}
      short_desc: test
      long_desc: null
    """) + textwrap.indent(textwrap.dedent(meta), "  ") + "definitions:\n" + textwrap.indent(textwrap.dedent(body), "  ")
    (folder / f"{name}.yaml").write_text(text)
