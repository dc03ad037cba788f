"""JSON text: secrets at any depth, numbers as they are, and a worker that knows nothing of the package."""

import json
import os
import subprocess
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opsignals.functions import pii
from opsignals.operators.privacy import sensitive_key_redact

CASES = {
    '{"a": 1.10, "b": 1e999, "a": -0.0}': '{"a":1.10,"b":1e999,"a":-0.0}',
    '{"request": "{\\"password\\":\\"hunter2\\",\\"n\\":[1]}"}': '{"request":"{\\"password\\":\\"[FILTERED]\\",\\"n\\":[1]}"}',
    '{"Api-Key": {"deep": [1, {"x": "y"}]}, "pwd": null, "pwd": 3}': '{"Api-Key":"[FILTERED]","pwd":null,"pwd":"[FILTERED]"}',
    '{"tokens": [1, {"a": 2}], "note": "mail a@b.org"}': '{"tokens":"[FILTERED]","note":"mail [EMAIL FILTERED]"}',
    ' [ "123-45-6789" , true, {} , [] ] ': '["[SSN FILTERED]",true,{},[]]',
    "not json a@b.org": "not json [EMAIL FILTERED]",
    '{"a": 1,}': '{"a": 1,}',
    '{"password": "x"': '{"password": "x"',
    "1 2": "1 2",
    "": "",
}


@pytest.mark.parametrize("text", CASES)
def test_json_text(text):
    assert pii.redact_json_text(text) == CASES[text]


def test_depth_costs_no_recursion(spark):
    deep = "[" * 100_000 + '"a@b.org"' + "]" * 100_000
    hidden = '{"a":' * 50_000 + '{"token":' + "[" * 50_000 + "]" * 50_000 + "}" + "}" * 50_000
    df = spark.createDataFrame([(1, deep), (2, hidden), (3, None)], "i int, t string")
    got = {r.i: r.t for r in sensitive_key_redact(df, "t", json_text=True).collect()}
    assert got[1] == deep.replace("a@b.org", "[EMAIL FILTERED]") and got[3] is None
    assert got[2] == '{"a":' * 50_000 + '{"token":"[FILTERED]"}' + "}" * 50_000


VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-5, 5) | st.text("ab{[\"\\é", max_size=4),
    lambda v: st.lists(v, max_size=3) | st.dictionaries(st.text("xyz", max_size=2), v, max_size=3),
    max_leaves=12,
)


@settings(max_examples=200, deadline=None)
@given(VALUES)
def test_plain_values_come_back(value):
    assert json.loads(pii.redact_json_text(json.dumps(value))) == value


def test_the_function_travels(tmp_path):
    """Workers start in a folder, and with a path, that doesn't hold the package."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from opsignals.session import local_session
from opsignals.operators.privacy import sensitive_key_redact
df = local_session("away", cores="2").createDataFrame([('{{"pwd": 1}}',)], "t string")
print(sensitive_key_redact(df, "t", json_text=True).first().t)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith('{"pwd":"[FILTERED]"}'), out.stderr[-2000:]
