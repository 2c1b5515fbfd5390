"""Rendered messages: hand-written ones, and properties of any others."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rowtide.functions.records import OP_LABELS
from rowtide.plans.monitor import messages

TOPIC = "dbserver1.public.albumy"
RULE = "-" * 80

text = st.text(st.characters(codec="utf-8", min_codepoint=32, exclude_categories=("Cs", "Cc", "Cn", "Zl", "Zp")), max_size=8)
number = st.integers(-(2**70), 2**70) | st.decimals(-(10**6), 10**6, places=3).map(float)
scalar = st.none() | st.booleans() | text | number
names = st.text("abcąż_ '\"\\", min_size=1, max_size=4).filter(lambda n: not n.startswith("__"))
change = st.tuples(st.dictionaries(names, scalar, max_size=5), st.sampled_from([*OP_LABELS, "t"]))

FIXTURES = [
    (
        ('{"idAlbumu":3}', '{"idAlbumu":3,"tytul":"Żółw","__op":"u","__table":"albumy","__deleted":"false"}'),
        "\n[albumy] UPDATE\n  key   : {'idAlbumu': 3}\n  record: {\n    \"idAlbumu\": 3,\n    \"tytul\": \"Żółw\"\n}\n" + RULE,
    ),
    (('{"idAlbumu":3}', None), f"\n[{TOPIC}] TOMBSTONE | key={{'idAlbumu': 3}}\n{RULE}"),
    ((None, '{"__op":"r"}'), "\n[albumy] READ (snapshot)\n  key   : None\n  record: {}\n" + RULE),
]


def test_written_messages(records):
    log = records(*[record for record, _ in FIXTURES])
    shown = [r.message for r in messages(log, [TOPIC], stamp=False).orderBy("offset").collect()]
    assert shown == [message for _, message in FIXTURES]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(change, min_size=1, max_size=25))
def test_any_message(records, changes):
    """The label first, then every field on a line of its own, and the record reads back as it was."""
    log = records(*[(None, json.dumps(fields | {"__op": op, "__x": 1}, ensure_ascii=False)) for fields, op in changes])
    shown = {r.offset: r.message for r in messages(log, [TOPIC], stamp=False).collect()}
    for i, (fields, op) in enumerate(changes):
        head, body = shown[i].split("  record: ")
        assert head.splitlines()[1] == f"[albumy] {OP_LABELS.get(op, 'UNKNOWN (t)')}"
        block = body.removesuffix("\n" + RULE)
        back = json.loads(block)
        assert back == fields and list(back) == list(fields)
        assert "__x" not in block and "__op" not in block
        assert len(block.splitlines()) == (len(fields) + 2 if fields else 1)


def test_keys_of_any_kind(records):
    keys = ["5", '"abc"', "[1]", "true", "null", "1e20", "1.50", '{"a":[1,{"b":null}]}', "", None]
    expected = ["5", "abc", "[1]", "True", "None", "1e+20", "1.5", "{'a': [1, {'b': None}]}", "None", "None"]
    log = records(*[(k, None) for k in keys])
    shown = [r.message for r in messages(log, [TOPIC], stamp=False).orderBy("offset").collect()]
    assert shown == [f"\n[{TOPIC}] TOMBSTONE | key={e}\n{RULE}" for e in expected]


def test_a_broken_key_or_value_is_malformed(records):
    log = records(("{cut", '{"a":1}'), (b"\xff", None), ('{"a":1}', "[1]"), ("1", b'{"a":"\xff"}'), ("2", "{" * 100_000), ("3", '{"a":1} x'))
    shown = [r.message for r in messages(log, [TOPIC], stamp=False).orderBy("offset").collect()]
    assert all("] MALFORMED | key=" in m for m in shown)
    assert [m.split("key=")[1].split(" value=")[0] for m in shown] == ["{cut", "�", "{'a': 1}", "1", "2", "3"]


def test_nested_records_and_numbers(records):
    value = (
        '{"__op":"c","z":{"b":[1,{"y":1.0,"x":[]}],"a":"\\u017c\\/"},"big":1e20,"small":1.5e-7,"whole":1E5,'
        '"long":123456789012345678901234567890,"same":1,"same":2,"half":"\\ud800","line":"a\\nb"}'
    )
    shown = messages(records((None, value)), [TOPIC], stamp=False).first().message
    assert shown.split("  record: ")[1] == (
        '{\n    "z": {\n        "b": [\n            1,\n            {\n                "y": 1.0,\n                "x": []\n'
        '            }\n        ],\n        "a": "ż/"\n    },\n    "big": 1e+20,\n    "small": 1.5e-07,\n    "whole": 100000.0,\n'
        '    "long": 123456789012345678901234567890,\n    "same": 2,\n    "half": "?",\n    "line": "a\\nb"\n}\n' + RULE
    )


def test_operations_and_tables_of_other_types(records):
    log = records((None, '{"__op":5,"__table":7}'), (None, '{"__op":null,"__table":null}'), (None, "{}"))
    heads = [r.message.splitlines()[1] for r in messages(log, [TOPIC], stamp=False).orderBy("offset").collect()]
    assert heads == ["[7] UNKNOWN (5)", "[albumy] UNKNOWN (?)", "[albumy] UNKNOWN (?)"]


def test_tasks_need_no_copy_of_the_library(tmp_path):
    """Workers get the code with the task: it runs where the library cannot be imported."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from rowtide.functions import render

    (tmp_path / "task").write_bytes(cloudpickle.dumps(render.shown))
    code = "import pickle; print(pickle.load(open('task', 'rb'))(b'[1]', b'{\"a\": 1}'))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={}, capture_output=True, text=True)
    assert done.stdout.startswith("('change', '[1]', '{\\n"), done.stderr
