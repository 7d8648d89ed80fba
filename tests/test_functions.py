"""Column functions against plain Python on small inputs."""

import json
import unicodedata
import zlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from taxaflow.functions.hierarchy import nonredundant
from taxaflow.functions.json_text import json_string, python_spacing, strict_json, unpaired_surrogate, variant_type
from taxaflow.functions.metadata import canonical_strings, with_canonical_metadata
from taxaflow.functions.scores import all_finite, argmax, sigmoid
from taxaflow.functions.text import hashed_token_ids, is_nonblank, reread_metadata, token_ids_sha256, words
from taxaflow.operators.scoring import prepare_inputs, with_model_input
from taxaflow.session import configure


def apply(spark, values, function, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r["r"] for r in frame.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()]


def test_blank_is_what_python_strips(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    others = ["​", "᠎", "a", "\x00", "\x1b", "é"]
    assert len(spaces) == 29
    assert apply(spark, spaces + others, is_nonblank) == [False] * len(spaces) + [True] * len(others)


def test_json_string_prints_like_python(spark):
    texts = ["".join(map(chr, range(0x30))), 'a"b\\c\n\\u001F é \x7f  ', "", "😀", "\\\\n"]
    assert apply(spark, texts, json_string) == [json.dumps(t, ensure_ascii=False) for t in texts]
    assert apply(spark, [None], json_string) == [None]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(st.characters(exclude_categories=["Cs"])), min_size=30, max_size=60))
def test_json_string_on_any_text(spark, texts):
    assert apply(spark, texts, json_string) == [json.dumps(t, ensure_ascii=False) for t in texts]


def test_python_spacing_leaves_strings_alone(spark):
    values = [{"a": 1, "b": [1, 2, {"c": "x,y:z"}], "d": 'q"\\,:'}, [], {}, "a,b", ["" , ","], {"k": {"l": ":"}}, "x" * 9000 + ","]
    compact = [json.dumps(v, separators=(",", ":"), ensure_ascii=False) for v in values]
    assert apply(spark, compact, python_spacing) == [json.dumps(v, ensure_ascii=False) for v in values]


@pytest.mark.parametrize("text, kind", [
    ('{"a":1}', "OBJECT<a: BIGINT>"), (' {"a":1} ', "OBJECT<a: BIGINT>"), ('{"a":1,"a":"x"}', "OBJECT<a: STRING>"),
    ('{"a":NaN}', "OBJECT<a: DOUBLE>"), ("[1]", "ARRAY<BIGINT>"), ("5", "BIGINT"), ("null", "VOID"), ('"s"', "STRING"),
    ('{"a":1} x', None), ('{"a":1}{"b":2}', None), ('{"a":1},{"b":2}', None), ('{"a":1}],[{"b":2}', None),
    ('{"a":1', None), ("{'a':1}", None), ('{"a":01}', None), ('{"a":1,}', None), ('{"a":"\t"}', None), ("", None),
    ('{"a":1}}', None), ('{"a":1}]', None),
])
def test_strict_json(spark, text, kind):
    configure(spark)
    assert apply(spark, [text], lambda v: variant_type(strict_json(v))) == [kind]


def test_java_escapes_become_lower_case(spark):
    value = {"a\x1f,": ["\x0b\x0e:", "\\u001F", "\\\\u001A\x1a"]}
    frame = spark.createDataFrame([(json.dumps({"v": value}),)], "line string")
    compact = F.get_json_object("line", "$.v")
    assert frame.select(python_spacing(compact)).first()[0] == json.dumps(value)


def test_unpaired_surrogates(spark):
    texts = [r"😀", r"\ud83d", r"x\ude00", r"\\ud83d", r"\\\ud83d", "plain", r"😀 \ud800x"]
    assert apply(spark, texts, unpaired_surrogate) == [False, True, True, False, True, False, True]


def metadata_of(spark, values):
    configure(spark)
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, m string")
    done = with_canonical_metadata(frame.withColumn("m", strict_json(F.col("m"))), "m")
    return [(r["metadata_compact"], r["metadata_inexact"]) for r in done.orderBy("i").collect()]


def test_metadata_cases(spark):
    cases = {
        None: "", "{}": "{}", '"[1]"': "", '"bad"': "", "bad": "", '{"title":""}': "{}", "[1]": "", "5": "",
        '{"title":"a","metadata_subset":{"title":"b"}}': '{"title": "b"}',
        '{"title":"a","metadata_subset":{"title":""}}': '{"title": "a"}',
        '{"title":"a","metadata_subset":"x"}': '{"title": "a"}',
        '{"title":true,"date":0,"language":false,"publisher":2024,"format_family":null}': '{"publisher": 2024, "title": true}',
        '{"title":[],"date":{},"other":"x"}': "{}",
        '"{\\"language\\": \\"ko\\", \\"title\\": \\"T\\"}"': '{"language": "ko", "title": "T"}',
    }
    assert metadata_of(spark, list(cases)) == [(v, False) for v in cases.values()]
    marked = ['{"title":1.5}', '{"title":[null]}', '{"date":{"a":1}}', '{"date":12345678901234567890}']
    assert [m for _, m in metadata_of(spark, marked)] == [True] * 4


def test_metadata_clip_then_reread(spark):
    long = json.dumps({"title": "é" * 2000})
    ((stored, _),) = metadata_of(spark, [long])
    assert stored == json.dumps({"title": "é" * 2000}, ensure_ascii=False)[:1200] and len(stored) == 1200
    exact = json.dumps({"title": "x" * (1200 - len('{"title": ""}'))})
    assert len(exact) == 1200
    assert apply(spark, [stored, exact, '{"title": "a"}', "", None], reread_metadata) == ["", exact, '{"title": "a"}', "", ""]


def test_metadata_from_string_columns(spark):
    frame = spark.createDataFrame([("T\n", "", None)], "title string, language string, date string")
    text = canonical_strings({c: F.col(c) for c in frame.columns})
    assert frame.select(text).first()[0] == '{"title": "T\\n"}'


def test_greedy_selection_follows_the_order(spark):
    lists = [["A.B.C", "A.B", "A.B.D", "A", "E"], ["A.BC", "A.B"], ["A", "A.B"], [], ["A.B", "A.B"]]
    assert apply(spark, lists, nonredundant, "array<string>") == [
        ["A.B.C", "A.B.D", "E"], ["A.BC", "A.B"], ["A"], [], ["A.B", "A.B"],
    ]


def test_scores(spark):
    assert apply(spark, [[1.0, 3.0, 3.0], [2.0, 2.0]], argmax, "array<float>") == [1, 0]
    values = [[0.0, 1.0], [float("nan"), 0.0], [float("-inf"), 0.0], [1.0], None]
    assert apply(spark, values, lambda v: all_finite(v, 2), "array<float>") == [True, False, False, False, False]
    (half,) = apply(spark, [0.0], sigmoid, "float")
    assert half == 0.5


def test_words_and_token_ids(spark):
    texts = ["  one\ttwo\n\nthree ", "", " \n", "a b c", "x " * 1000]
    got = apply(spark, texts, words)
    ascii_space = " \t\n\r\f\x0b"
    for text, found in zip(texts, got):
        want, word = [], ""
        for char in text + " ":
            if char in ascii_space:
                want += [word] if word else []
                word = ""
            else:
                word += char
        assert found == want
    ids = apply(spark, texts, lambda v: hashed_token_ids(words(v)))
    assert ids == [[zlib.crc32(w.encode()) for w in found[:768]] for found in got]
    hashes = apply(spark, texts, lambda v: token_ids_sha256(hashed_token_ids(words(v))))
    import hashlib
    assert hashes == [hashlib.sha256(json.dumps(i, separators=(",", ":")).encode()).hexdigest() for i in ids]


def test_nothing_but_text_and_metadata_reaches_the_model(spark):
    row = ("id-1", "body", '{"title": "t"}', "family", '"secret locator"', True)
    schema = "sample_id string, text_window string, metadata_compact string, source_family string, source_locator string, raw_windowed boolean"
    made = with_model_input(spark.createDataFrame([row], schema)).first()
    assert made["model_input"] == '[DOCUMENT METADATA]\n{"title": "t"}\n\n[DOCUMENT]\nbody'
    assert (made["input_tokens"], made["visible_tokens"], made["truncated"]) == (6, 6, False)


def test_prepare_inputs(spark):
    configure(spark)
    frame = spark.createDataFrame([("body", '{"title":"t","x":1}'), ("other", None)], "text string, metadata string")
    got = [r["model_input"] for r in prepare_inputs(frame).orderBy("text").collect()]
    assert got == ['[DOCUMENT METADATA]\n{"title": "t"}\n\n[DOCUMENT]\nbody', "[DOCUMENT METADATA]\n\n\n[DOCUMENT]\nother"]
    nested = spark.createDataFrame([("b", '{"title":{"z":1.50,"a":[]}}')], "text string, metadata string")
    assert prepare_inputs(nested).first()["model_input"] == '[DOCUMENT METADATA]\n{"title": {"a": [], "z": 1.5}}\n\n[DOCUMENT]\nb'
    with pytest.raises(Exception, match="not blank"):
        prepare_inputs(spark.createDataFrame([(" 　", None)], "text string, metadata string")).collect()


def test_space_table_is_current():
    assert unicodedata.unidata_version >= "13"
